"""Removal of repeated substrings by a distributed merge sort of suffixes that never compares a known prefix again.

Asked is which bytes lie in a string of LENGTH bytes that also starts earlier. Not every suffix has to be sorted for
that: of each window of LENGTH bytes the K-byte string with the smallest hash (the leftmost of equals) is its anchor.
Windows that are equal choose equal anchors at the same place, so suffixes at anchors, about one in 38, show all.

1. Anchors. Each task gives its anchors; those whose K bytes it has seen twice are known to matter, and one of each
   stands for the task in the count over all tasks, so a hot string sends a row per task, not per document.
2. Runs. Around each anchor that matters a task takes the LENGTH bytes from it on (the suffix) and the LENGTH - K
   bytes before it, sorts them, and gives a run for each part: suffixes front-coded (what they share with the one
   before is a number), equal neighbours with equal context only once; the later ones are repeats already.
3. Merge. A part holds the suffixes of which the first K bytes have one hash. Its runs are merged by a loser tree
   whose players carry the length that they share with the last winner: a longer shared prefix wins without looking
   at a byte, and equal ones are compared only behind it. Out comes the suffix array of the part with its lengths of
   common prefixes. For each offset of the anchor in a window, these lengths cut the array into classes of equal
   right parts; the contexts sorted likewise give the left parts. In each class of equal windows all but the
   earliest are repeats.
4. Each document gets its repeated ranges, whose union is taken away.

Matches are exact: bytes are compared, hashes only choose anchors and parts. An anchor depends on its window alone,
whatever stands around it. Null texts are empty. Documents are ordered by doc_id, a null one first; rows that share a
doc_id are ordered by a hash of their text, and if the text is equal too, they are one document (no row of it is a
repeat of the other). Ties of places can't be: a place is one. An empty table gives no rows; only id and text are read,
so other columns may have any name. Long texts are read in blocks; memory is that of a text, of a run or of a part, and
the parts grow in number with the places to look at. A part's suffixes of one K-byte string are held together, once per
task and different context.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import buffers, materialize, mix, slices

LENGTH, K = 100, 24
RUN_ROWS, COUNT_ROWS, PART_FACTOR, PART_ROWS = 200_000, 400_000, 4, 100_000
#: Bytes of data that anchors are looked for in at once, and anchors that are cut out at once.
BLOCK, CUT_ROWS = 1 << 21, 20_000
_rng = np.random.default_rng(5)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = _rng.integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
META = np.dtype([("did", "<i8"), ("th", "<i8"), ("pos", "<i4"), ("right", "u1"), ("left", "u1")])
SPAN = np.dtype([("did", "<i8"), ("th", "<i8"), ("lo", "<i4"), ("hi", "<i4")])
#: Stands for a null doc_id, before all others.
NULL_ID = -(2**63)


def rolled(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each place on, by doubling."""
    one = _TABLE[data]
    power, size = one, 1
    out = None
    done = 0
    rest, i = k, 0
    while rest:
        if rest & 1:
            if out is None:
                out, done = power, size
            else:
                n = max(0, len(data) - done - size + 1)
                out = out[:n] * _ODD[32 + i] + power[done : done + n]
                done += size
        rest >>= 1
        if rest:
            n = max(0, len(data) - 2 * size + 1)
            power = power[:n] * _ODD[i] + power[size : size + n]
            size *= 2
        i += 1
    return mix(out)


def _leftmost_least(h: np.ndarray, w: int) -> np.ndarray:
    """Of each w neighbours the place of the smallest, the leftmost of equals."""
    least, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < w:
        step = min(span, w - span)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        span += step
    return at


def anchors(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int = LENGTH, k: int = K, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) and hashes of the anchors of all windows that lie within a text."""
    mark = np.zeros(len(data) + 1, np.int8)  # texts don't overlap: where a window may begin is 1
    long = end - start >= length
    mark[start[long]] += 1
    mark[end[long] - length + 1] -= 1
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    inside = np.cumsum(mark, dtype=np.int8)
    for at in range(0, len(data) - length + 1, block):
        piece = data[at : at + block + length - 1]
        h = rolled(piece, k)
        least = _leftmost_least(h, length - k + 1)
        chosen = np.unique(least[inside[at : at + len(least)] > 0])
        places.append(chosen.astype(np.int64) + at), hashes.append(h[chosen])
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    places, first = np.unique(places, return_index=True)  # neighbouring blocks may choose the same
    return places, hashes[first]


def _count_rows(h, did, th, pos):
    """Rows (key, did, th, pos, known) of a task's anchors: repeats within the task are known, one of each kind asks for others."""
    order = np.argsort(h, kind="stable")
    h, did, th, pos = h[order], did[order], th[order], pos[order]
    head = np.append(True, h[1:] != h[:-1])
    twice = ~head | np.append(~head[1:], False)
    # a known row needs no company: it is dealt by its own place, not by the hot hash
    key = np.concatenate([h[head], mix((did[twice] ^ th[twice]).astype(np.uint64) * np.uint64(3) + pos[twice].astype(np.uint64))])
    known = np.concatenate([np.zeros(head.sum(), bool), np.ones(twice.sum(), bool)])
    both = lambda x: pa.array(np.concatenate([x[head], x[twice]]))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), both(did), both(th), both(pos.astype(np.int32)), pa.array(known)], ["key", "did", "th", "pos", "known"])


def _anchor_rows(length: int, k: int):
    def run(batches):
        kept, size = [], 0
        for batch in batches:
            for part in slices(batch, "t"):
                data, start, end = buffers(part.column("t"))
                at, h = anchors(data, start, end, length, k)
                full = np.flatnonzero(end > start)
                text = full[np.searchsorted(start[full], at, side="right") - 1] if len(at) else at
                kept.append((h, part.column("did").to_numpy()[text], part.column("th").to_numpy()[text], at - start[text]))
                size += len(at)
                if size >= COUNT_ROWS:
                    yield _count_rows(*map(np.concatenate, zip(*kept)))
                    kept, size = [], 0
        if size:
            yield _count_rows(*map(np.concatenate, zip(*kept)))

    return run


def shared_prefix(rows: np.ndarray) -> np.ndarray:
    """Of each row of a byte matrix how many bytes it shares with the row before; -1 for the first."""
    out = np.full(len(rows), -1, np.int64)
    if len(rows) > 1:
        other = rows[1:] != rows[:-1]
        out[1:] = np.where(other.any(1), other.argmax(1), rows.shape[1])
    return out


def _as_keys(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _spans(meta: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> np.ndarray:
    """The ranges of windows with the anchor at offsets least..most (they overlap, so it's one range)."""
    out = np.zeros(len(meta), SPAN)
    out["did"], out["th"], out["lo"], out["hi"] = meta["did"], meta["th"], meta["pos"] - most, meta["pos"] - least + length
    return out


def _offsets(meta: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest offset of the anchor in windows that lie within the text."""
    return length - meta["right"].astype(np.int64), meta["left"].astype(np.int64)


def encode_runs(right: np.ndarray, left: np.ndarray, meta: np.ndarray, parts: int, length: int = LENGTH, k: int = K):
    """(part, suffixes, contexts, meta, spans) of each part of a run."""
    part = np.zeros(len(meta), np.uint64)
    for j in range(k):
        part = part * _ODD[0] + _TABLE[right[:, j]]
    part = (mix(part) % np.uint64(parts)).astype(np.int64)
    first = np.lexsort((meta["pos"], meta["th"], meta["did"]))
    order = first[np.argsort(_as_keys(np.hstack([right, left])[first]), kind="stable")]
    order = order[np.argsort(part[order], kind="stable")]
    right, left, meta, part = right[order], left[order], meta[order], part[order]
    new = np.append(True, part[1:] != part[:-1])
    same = ~new & (shared_prefix(right) == right.shape[1]) & (shared_prefix(left) == left.shape[1]) & np.append(False, (meta["right"][1:] == meta["right"][:-1]) & (meta["left"][1:] == meta["left"][:-1]))
    # of a chain of equals the first stays; the others repeat it (unless they are the very same place)
    base = np.maximum.accumulate(np.where(same, 0, np.arange(len(meta))))
    again = same & ((meta["did"] != meta["did"][base]) | (meta["th"] != meta["th"][base]) | (meta["pos"] != meta["pos"][base]))
    least, most = _offsets(meta, length)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for a, b in zip(starts := np.flatnonzero(new), np.append(starts[1:], len(meta))):
        keep = np.flatnonzero(~same[a:b]) + a
        gone = np.flatnonzero(again[a:b] & (least[a:b] <= most[a:b])) + a
        lcp = np.maximum(shared_prefix(right[keep]), 0).astype(np.uint8)
        tails = right[keep][np.arange(length) >= lcp[:, None]]
        yield int(part[a]), squeeze(lcp.tobytes() + tails.tobytes()), squeeze(left[keep].tobytes()), squeeze(meta[keep].tobytes()), squeeze(_spans(meta[gone], least[gone], most[gone], length).tobytes())


def _run_rows(parts: int, length: int, k: int):
    width = length - k

    def flush(kept):
        rows = list(encode_runs(*(np.concatenate(x) for x in zip(*kept)), parts, length, k))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5))], ["part", "suffixes", "contexts", "meta", "spans"])

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            for piece in slices(batch, "t"):
                data, start, end = buffers(piece.column("t"))
                lists = piece.column("ps")
                text = np.repeat(np.arange(len(start)), np.diff(lists.offsets.to_numpy()))
                pos = lists.flatten().to_numpy().astype(np.int64)
                ids, hashes = piece.column("did").to_numpy(), piece.column("th").to_numpy()
                for a in range(0, len(pos), CUT_ROWS):
                    of, place = text[a : a + CUT_ROWS], pos[a : a + CUT_ROWS]
                    p, lo, hi = place + start[of], start[of], end[of]
                    to = p[:, None] + np.arange(length)
                    right = np.where(to < hi[:, None], data[np.minimum(to, len(data) - 1)], 0).astype(np.uint8)
                    back = p[:, None] - 1 - np.arange(width)
                    left = np.where(back >= lo[:, None], data[np.maximum(back, 0)], 0).astype(np.uint8)
                    meta = np.zeros(len(of), META)
                    meta["did"], meta["th"], meta["pos"] = ids[of], hashes[of], place
                    meta["right"], meta["left"] = np.minimum(hi - p, length), np.minimum(place, width)
                    kept.append((right, left, meta))
                    size += len(of)
                    if size >= RUN_ROWS:
                        yield flush(kept)
                        kept, size = [], 0
        if size:
            yield flush(kept)

    return run


class LoserTree:
    """Merges sorted runs of byte strings. A player is the place of its run; `shared[p]` is what its string shares with the last winner."""

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.at = [0] * len(runs)
        self.head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (self.size - len(runs))
        self.shared = [0] * self.size
        self.losers = [0] * self.size
        self.winner = self._first(1)

    def _first(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._first(2 * node), self._first(2 * node + 1)
        win, lose = self._play(a, b)
        self.losers[node] = lose
        return win

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        s, t = self.shared[a], self.shared[b]
        if s != t:  # both compared with the last winner: who shares more is smaller, and the other's length holds for it too
            return (a, b) if s > t else (b, a)
        n = min(len(x), len(y))
        while s < n and x[s] == y[s]:
            s += 1
        if s == n or x[s] < y[s]:
            self.shared[b] = s
            return a, b
        self.shared[a] = s
        return b, a

    def merged(self):
        """(run, place in the run, bytes shared with the one before; 0 for the first) in sorted order."""
        head, shared, losers, size, at, runs, play = self.head, self.shared, self.losers, self.size, self.at, self.runs, self._play
        w = self.winner
        while head[w] is not None:
            strings, lcps = runs[w]
            i = at[w]
            yield w, i, shared[w]
            i += 1
            at[w] = i
            if i < len(strings):
                head[w], shared[w] = strings[i], lcps[i]
            else:
                head[w] = None
            node = (w + size) >> 1
            while node:
                l = losers[node]
                y = head[l]
                if y is not None:
                    x = head[w]
                    if x is None or shared[l] > shared[w]:
                        losers[node], w = w, l
                    elif shared[l] == shared[w]:
                        win, lose = play(w, l)
                        losers[node], w = lose, win
                node >>= 1


def decode(suffixes: bytes, n: int, length: int) -> tuple[list[bytes], list[int]]:
    raw = zstandard.ZstdDecompressor().decompress(suffixes)
    lcps = list(raw[:n])
    strings, at, last = [], n, b""
    for l in lcps:
        to = at + length - l
        last = last[:l] + raw[at:to]
        strings.append(last)
        at = to
    return strings, lcps


def repeats(lcp: np.ndarray, left: np.ndarray, meta: np.ndarray, length: int = LENGTH, k: int = K) -> np.ndarray:
    """The repeated ranges at the suffixes of a sorted part: lcp of each with the one before, its context (nearest byte first) and place."""
    near = np.append(lcp[1:] >= k, False)
    near[1:] |= lcp[1:] >= k
    if not near.any():
        return np.zeros(0, SPAN)
    # alone among its first k bytes, a suffix can't repeat; the one after it shares less than k with what is before
    lcp, left, meta = lcp[near].copy(), left[near], meta[near]
    lcp[0] = -1
    rank = np.lexsort((meta["pos"], meta["th"], meta["did"]))
    by_left = np.argsort(_as_keys(left), kind="stable")
    left_lcp = shared_prefix(left[by_left])
    least, most = _offsets(meta, length)
    n = len(meta)
    lo, hi = np.full(n, length), np.full(n, -1)
    left_class = np.zeros(n, np.int64)
    for a in range(length - k + 1):
        valid = rank[(least[rank] <= a) & (most[rank] >= a)]
        if len(valid) < 2:
            continue
        right_class = np.cumsum(lcp < length - a)
        left_class[by_left] = np.cumsum(left_lcp < a)
        key = right_class[valid] * (n + 1) + left_class[valid]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        base = valid[first][which]  # the earliest of the class
        again = valid[(meta["did"][valid] != meta["did"][base]) | (meta["th"][valid] != meta["th"][base]) | (meta["pos"][valid] != meta["pos"][base])]
        lo[again] = np.minimum(lo[again], a)
        hi[again] = a
    found = np.flatnonzero(hi >= 0)
    return _spans(meta[found], lo[found], hi[found], length)


def _merge(length: int, k: int):
    width = length - k

    def run(table: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        metas, lefts, runs, spans = [], [], [], []
        for s, c, m, g in zip(*(table.column(x).to_pylist() for x in ("suffixes", "contexts", "meta", "spans"))):
            meta = np.frombuffer(open_.decompress(m), META)
            metas.append(meta)
            lefts.append(np.frombuffer(open_.decompress(c), np.uint8).reshape(len(meta), width))
            spans.append(np.frombuffer(open_.decompress(g), SPAN))
            runs.append(decode(s, len(meta), length))
        base = np.append(0, np.cumsum([len(m) for m in metas]))
        order, lcp = np.zeros(base[-1], np.int64), np.zeros(base[-1], np.int64)
        for j, (r, i, l) in enumerate(LoserTree(runs).merged()):
            order[j], lcp[j] = base[r] + i, l
        found = np.concatenate([*spans, repeats(lcp, np.concatenate(lefts)[order], np.concatenate(metas)[order], length, k)])
        return pa.table({c: pa.array(np.ascontiguousarray(found[c])) for c in ("did", "th", "lo", "hi")})

    return run


def _removed(batches):
    for batch in batches:
        for part in slices(batch, "t"):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            data, start, end = buffers(part.column("t"))
            raw = data.tobytes()
            for a, b, spans in zip(start.tolist(), end.tolist(), part.column("spans").to_pylist()):
                text, out, at, removed, runs = raw[a:b], [], 0, 0, 0
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    if lo > at or (lo == at == 0):
                        runs += 1
                        out.append(text[at:lo])
                        removed += hi - lo
                    elif hi > at:
                        removed += hi - at
                    at = max(at, hi)
                out.append(text[at:])
                n_bytes.append(len(text)), n_removed.append(removed), n_spans.append(runs)
                kept.append(hashlib.sha256(b"".join(out)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("did"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.string())], ["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_ranges(texts: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """(did, th, lo, hi): ranges of bytes of the text (did, th) to take away; they may overlap."""
    spark = texts.sparkSession
    rows = texts.mapInArrow(_anchor_rows(length, k), "key long, did long, th long, pos int, known boolean")
    # at most a row per task and hash, so no window grows with a hot string
    asked = rows.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key"))).where("known or n > 1")
    places = materialize(asked.groupBy("did", "th").agg(F.collect_set("pos").alias("ps")).select(F.col("did").alias("pd"), F.col("th").alias("pt"), "ps"), "anchor-places")
    total = places.agg(F.sum(F.size("ps"))).first()[0] or 0
    parts = max(PART_FACTOR * int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_ROWS + 1)
    runs = texts.join(places, (F.col("did") == F.col("pd")) & (F.col("th") == F.col("pt"))).select("did", "th", "t", "ps").mapInArrow(_run_rows(parts, length, k), "part int, suffixes binary, contexts binary, meta binary, spans binary")
    return runs.groupBy("part").applyInArrow(_merge(length, k), "did long, th long, lo int, hi int")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row per row of docs."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    texts = texts.select("did", F.xxhash64("t").alias("th"), "t")
    found = repeated_ranges(texts, length, k).groupBy("did", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).select(F.col("did").alias("sd"), F.col("th").alias("st"), "spans")
    out = texts.join(found, (F.col("did") == F.col("sd")) & (F.col("th") == F.col("st")), "left").select("did", "t", "spans").mapInArrow(_removed, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("did") != NULL_ID, F.col("did")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
