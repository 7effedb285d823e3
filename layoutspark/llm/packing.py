"""Lexical retrieval packing: documents that share rare tokens are packed into the same training sequences.

Each task takes its rows in shards of at most SHARD_TOKENS tokens (one document at least) and builds a BM25
inverted index of the shard over token ids. The first unused document is a seed: all its tokens query the
index, however common, and the unused neighbours follow it, best first, until the window is full; what the last one has left
begins the next window and is the next seed. So the windows of a shard are full but for its last, which is cut
into sequences of falling powers of two: nothing is padded. No row is shuffled and memory is that of a shard, so
a lost executor costs its tasks only. Shards follow the input's partitions: a rerun over the same splits gives
the same sequences.

A null text is empty: its one id is the end id. Repeated rows are packed as often as they come. Ties of score go to
the earlier row. A text longer than a window goes on in the next ones; one longer than a shard is a shard. An empty
table gives no rows. Only the id and the text are read, so other columns may have any name. Ids come from the rank file
of the vocabulary, word by word with a bounded cache, after the added tokens of its tokenizers file are cut out as that
file says: they equal what tokenizers makes of it (tests compare them).
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices

VOCABULARY = "byte_bpe_50k.json"
WINDOW, END_ID, SHARD_TOKENS = 2048, 1, 2 << 20
K1, B = 1.2, 0.75
CACHE_WORDS, CACHE_CHARS = 200_000, 40
#: Neighbours that are ranked at first; ranking more changes nothing but time.
FIRST_LOOK = 32
_white_pair = re.compile(r"\s\s")


class Words(dict):
    """Ids (as bytes) of a word behind a space, or with its line break before it; kept for short words up to a bound."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word if word[:1] == "\n" else " " + word)).tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


def added_tokens(path: str) -> dict[str, int]:
    """The strings that a tokenizers file cuts out of a text before anything else, with their ids."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file).get("added_tokens") or []
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in found):
        raise ValueError("added tokens that take in white space or need word bounds aren't known")
    return {x["content"]: x["id"] for x in found}


@lru_cache(2)
def tokenizer(vocabulary: str = VOCABULARY):
    """text -> its ids as little-endian 32-bit bytes. vocabulary: a tokenizers file of the public ones, or a path of one; its rank file lies beside it."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = getattr(own, "_core_bpe", own).encode_ordinary  # without a wrapper for texts that UTF-8 can't hold
    cached = Words(encode)
    added = {k: array("I", [v]).tobytes() for k, v in added_tokens(path).items()}
    apart = re.compile("|".join(re.escape(x) for x in sorted(added, key=len, reverse=True))) if added else None

    def plain(text: str) -> bytes:
        # No token spans the place before a space or a line break that no white space is next to, so words can be encoded one by one.
        if _white_pair.search(text):
            return array("I", encode(text)).tobytes()
        first, *rest = text.replace("\n", " \n").split(" ")
        return array("I", encode(first)).tobytes() + b"".join(map(cached.__getitem__, rest))

    def run(text: str) -> bytes:
        if apart is None or not apart.search(text):
            return plain(text)
        out, at = [], 0
        for m in apart.finditer(text):
            out += [plain(text[at : m.start()]), added[m[0]]]
            at = m.end()
        return b"".join([*out, plain(text[at:])])

    return run


class Index:
    """BM25 over the token ids of a shard. All tokens of a document query for it, however common they are."""

    def __init__(self, ids: list[np.ndarray]):
        n = self.n = len(ids)
        key = np.concatenate(ids).astype(np.int64)  # the largest array of a shard: made once
        key *= n
        key += np.repeat(np.arange(n), [len(x) for x in ids])
        key, tf = np.unique(key, return_counts=True)
        token, self.docs = np.divmod(key, n)
        first, df = np.unique(token, return_index=True, return_counts=True)[1:]
        lengths = np.array([len(x) for x in ids], float)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        place = np.repeat(np.arange(len(df)), df)
        self.weights = idf[place] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.docs] / max(lengths.mean(), 1)))
        self.first = np.append(first, len(key))  # of each token's postings
        shared = np.flatnonzero(df[place] > 1)
        of = self.docs[shared].astype(np.uint16 if n <= 1 << 16 else np.int64)  # short numbers are sorted by digits
        shared = shared[np.argsort(of, kind="stable")]
        self.own, self.begin = place[shared], np.append(0, np.cumsum(np.bincount(of, minlength=n)))  # each document's tokens
        self.live = n

    def neighbours(self, doc: int, used: np.ndarray, most: int) -> np.ndarray:
        """The best unused documents that share a token, best first, the earlier ones at ties."""
        tokens = self.own[self.begin[doc] : self.begin[doc + 1]]
        spans = [slice(a, b) for a, b in zip(self.first[tokens].tolist(), self.first[tokens + 1].tolist())]
        if not spans:
            return np.zeros(0, np.int64)
        score = np.bincount(np.concatenate([self.docs[x] for x in spans]), np.concatenate([self.weights[x] for x in spans]), self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > most:
            least = np.partition(score[found], len(found) - most)[len(found) - most]
            above, equal = found[score[found] > least], found[score[found] == least]
            found = np.sort(np.concatenate([above, equal[: most - len(above)]]))
        return found[np.argsort(-score[found], kind="stable")]

    def forget(self, used: np.ndarray, free: int) -> None:
        """Postings of used documents go once these are half of those kept: free is how many are unused."""
        if 2 * free > self.live:
            return
        keep = ~used[self.docs]
        self.first = np.append(0, np.cumsum(keep))[self.first]
        self.docs, self.weights, self.live = self.docs[keep], self.weights[keep], free


def order_of(ids: list[np.ndarray], window: int = WINDOW, terms: list[np.ndarray] | None = None) -> list[int]:
    """The order in which a shard's documents fill its windows. terms: what they are alike by, their ids if not given."""
    index, used, order = Index(ids if terms is None else terms), np.zeros(len(ids), bool), []
    filled = free = 0
    seed, ranked = -1, iter(())

    def near(doc: int):
        index.forget(used, len(ids) - len(order))
        for most in (FIRST_LOOK, window):  # a few as a rule, else as many as fill the window: no document is empty
            found = index.neighbours(doc, used, most).tolist()
            yield from found
            if len(found) < most:
                return

    while len(order) < len(ids):
        if seed < 0:
            while used[free]:
                free += 1
            seed = free
            used[seed] = True
            order.append(seed)
            filled += len(ids[seed])
            ranked = iter(()) if filled % window == 0 else near(seed)
            if filled % window == 0:
                seed = -1
            continue
        nearest = next((x for x in ranked if not used[x]), -1)
        if nearest < 0:
            seed = -1
            continue
        used[nearest] = True
        order.append(nearest)
        before, filled = filled, filled + len(ids[nearest])
        if filled // window > before // window:  # it ends the window; its rest is the next seed
            seed = nearest if filled % window else -1
            ranked = near(nearest) if seed >= 0 else iter(())
    return order


def cuts(total: int, window: int = WINDOW) -> np.ndarray:
    """Where sequences end in a stream of so many ids: full windows, then falling powers of two."""
    ends = list(range(window, total + 1, window))
    at, rest = total - total % window, total % window
    while rest:
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
        ends.append(at)
    return np.array(ends, np.int64)


def pack(docs: list[tuple[int | None, bytes]], first_sequence: int, window: int = WINDOW) -> tuple[pa.RecordBatch, int]:
    """The pieces of a shard and how many sequences they make."""
    ids = [np.frombuffer(b, "<u4") for _, b in docs]
    order = np.array(order_of(ids, window, [x[:-1] for x in ids]))  # the end id is in all
    lengths = np.array([len(ids[i]) for i in order], np.int64)
    end = np.cumsum(lengths)
    begin = end - lengths
    ends = cuts(int(end[-1]), window)
    points = np.unique(np.concatenate([begin, ends[:-1]]))
    stops = np.append(points[1:], end[-1])
    which = np.searchsorted(begin, points, side="right") - 1
    seq = np.searchsorted(ends, points, side="right")
    seq_begin = np.append(0, ends[:-1])[seq]
    start = points - begin[which]
    size = stops - points
    crc = [zlib.crc32(memoryview(docs[order[w]][1])[4 * s : 4 * (s + k)]) for w, s, k in zip(which.tolist(), start.tolist(), size.tolist())]
    doc_ids = [docs[order[w]][0] for w in which.tolist()]
    arrays = [pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(lengths[which]), pa.array(seq + first_sequence), pa.array(points - seq_begin)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]), len(ends)


def packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row per piece."""
    end = array("I", [end_id]).tobytes()

    def run(batches):
        encode = tokenizer(vocabulary)
        sequence = TaskContext.get().partitionId() << 33
        shard, size = [], 0
        parts = (part for batch in batches for part in slices(batch, "t"))  # few texts are Python strings at a time
        rows = chain.from_iterable(zip(p.column("doc_id").to_pylist(), p.column("t").to_pylist()) for p in parts)
        for doc_id, text in rows:
            ids = encode(text) + end
            if shard and size + len(ids) // 4 > shard_tokens:
                out, n = pack(shard, sequence, window)
                sequence += n
                yield out
                shard, size = [], 0
            shard.append((doc_id, ids))
            size += len(ids) // 4
        if shard:
            yield pack(shard, sequence, window)[0]

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return bounded_batches(texts).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
