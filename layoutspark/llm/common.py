"""What the operators of this subpackage share: shared scratch tables, checked broadcasts, word views of Arrow batches."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these; the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a side is broadcast; each has a few numbers or a short key.
BROADCAST_ROWS = 20_000
#: Spark ends an Arrow batch after 10,000 rows, whatever their size; here after about so many bytes too (one row at least).
BATCH_BYTES = 2 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Where that is unset, a temporary one in local mode, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='layoutspark-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/layoutspark/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, so a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove tables (paths as `inputFiles` or materialize name them) that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; to be called once its results are written."""
    discard(spark, scratch_dir(spark))


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, to be sent to Python in batches of BATCH_BYTES: memory of executors and workers then doesn't follow the length of texts.

    Frames are run later than they are made, so this is set for their session, and stays; a bound that the session has is kept.
    """
    conf = df.sparkSession.conf
    if _BATCH_BYTES not in conf.getAll:
        conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    return df


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows (counted here); beyond, Spark picks a shuffled join."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


# --- sums over partitions ---------------------------------------------------------------------------

#: Groups that the first of two levels of sums is dealt to.
SUM_FAN = 1024


def packed(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def block_sums(rows: DataFrame, dtype: str = "<f8") -> dict[int, np.ndarray]:
    """Sum per i of v, packed arrays of one length: rows (i int, v binary) have one for each partition and i.

    Partitions are summed in SUM_FAN groups first, so that no task holds a row of every partition.
    """

    def add(table: pa.Table) -> pa.Table:
        total = None
        for x in table.column("v"):
            v = np.frombuffer(zlib.decompress(x.as_py()), dtype)
            total = v.copy() if total is None else total + v
        return pa.table({"i": table.column("i").slice(0, 1), "v": pa.array([packed(total)], pa.binary())})

    some = rows.select("i", "v", (F.spark_partition_id() % SUM_FAN).alias("p")).groupBy("i", "p").applyInArrow(add, "i int, v binary")
    found = some.groupBy("i").applyInArrow(add, "i int, v binary").collect()
    return {r["i"]: np.frombuffer(zlib.decompress(bytes(r["v"])), dtype) for r in found}


# --- words of a batch, without a Python object per word -----------------------------------------

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WORD_KEY = np.uint64(0x6C62272E07BB0142)
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Words of more bytes are hashed by a cryptographic hash, one by one.
LONG_WORD = 512
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        m = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", _INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _powers[key] = np.cumprod(a, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Words:
    """The words of all texts of a batch: bytes, text bounds, word bounds and the text that each word is in."""

    data: np.ndarray
    text_start: np.ndarray
    text_end: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return self.first[1:] - self.first[:-1]

    def eights(self, lower: bool = False) -> np.ndarray:
        """The eight bytes from each place of the data on, as one number; zeros behind the end."""
        data = lowered(self.data) if lower else self.data
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))

    def block(self, eights: np.ndarray, which: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of the words, without what is behind their ends."""
        at = self.start[which] + 8 * k
        return eights[at] & _MASKS[np.minimum(self.end[which] - at, 8)]

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A keyed 64-bit hash per word; equal for equal bytes wherever they stand."""
        size = self.end - self.start
        h = mix(size.astype(np.uint64) * _BASE + _WORD_KEY)
        eights, k = self.eights(lower), 0
        left = np.flatnonzero(size <= LONG_WORD)
        while len(left):
            h[left] = mix((h[left] ^ self.block(eights, left, k)) * _MIX[0] + _WORD_KEY)
            k += 1
            left = left[size[left] > 8 * k]
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self.bytes_of(i, lower), digest_size=8).digest(), "little")
        return h

    def bytes_of(self, i: int, lower: bool = False) -> bytes:
        found = self.data[self.start[i] : self.end[i]]
        return (lowered(found) if lower else found).tobytes()

    def ids(self, hashes: np.ndarray, lower: bool = False) -> np.ndarray:
        """A small number per word, the same just for words of the same bytes: words of one hash are compared with the first of them."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        _, first, out = np.unique(hashes, return_index=True, return_inverse=True)
        like = first[out]
        size = self.end - self.start
        wrong = size != size[like]
        eights, k = self.eights(lower), 0
        left = np.flatnonzero((like != np.arange(len(like))) & ~wrong)
        whole = left[size[left] > LONG_WORD]
        left = left[size[left] <= LONG_WORD]
        while len(left):
            wrong[left] |= self.block(eights, left, k) != self.block(eights, like[left], k)
            k += 1
            left = left[size[left] > 8 * k]
        for i in whole.tolist():
            wrong[i] = self.bytes_of(i, lower) != self.bytes_of(like[i], lower)
        if wrong.any():  # two words of one hash: those unlike the first get numbers of their own
            own: dict[tuple[int, bytes], int] = {}
            for i in np.flatnonzero(wrong).tolist():
                out[i] = own.setdefault((int(out[i]), self.bytes_of(i, lower)), len(first) + len(own))
        return out.astype(np.int64)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of a string column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    return data, off[:-1], off[1:]


def words(texts: pa.Array | pa.ChunkedArray) -> Words:
    data, text_start, text_end = buffers(texts)
    n = len(data)
    inside = np.ones(n + 1, bool)
    inside[:n] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    inside[n] = False
    edge = np.zeros(n + 1, bool)  # a text begins or ends here
    edge[text_start] = True
    edge[n] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    full = np.flatnonzero(text_end > text_start)
    text = full[np.searchsorted(text_start[full], start, side="right") - 1] if len(start) else np.zeros(0, np.int64)
    first = np.searchsorted(text, np.arange(len(text_start) + 1), side="left")
    return Words(data, text_start, text_end, start, end, text, first)


def char_counts(data: np.ndarray) -> np.ndarray:
    """Running count of UTF-8 code points: [i] is how many begin before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """batch in pieces of about so many bytes of text (one row at least), so that memory doesn't follow the batch size."""
    col = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    sizes = np.diff(np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]) if len(col) else np.zeros(0, np.int64)
    at = 0
    sums = np.cumsum(sizes)
    while at < len(sizes):
        done = sums[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sums, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
