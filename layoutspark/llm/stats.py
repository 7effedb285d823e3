"""Statistics of whole texts, made batch by batch with numpy over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bounded_batches, char_counts, mix, slices, words

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: The statistics that models see, in this order; each is a ratio, a mean or a logarithm, so that scales are alike.
FEATURES = (
    "log_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_word_share", "upper_share", "digit_share", "punct_share",
    "wide_share", "distinct_share", "top_word_share", "log_line_words", "short_line_share", "symbol_end_share", "capital_share", "url_share",
)
_K = np.uint64(0xA24BAED4963EE407)


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[end] - c[start]


def repeated_words(w: Words, ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, its words in windows of so many words that the text has twice or more (the first one too).

    ids: a number per word, the same just for equal words. Windows of one hash are compared word by word.
    """
    n = len(ids)
    covered = np.zeros(n + 1, np.int64)
    if n >= window:
        key = np.zeros(n - window + 1, np.uint64)
        for j in range(window):
            key = mix(key * _K + ids[j : n - window + 1 + j].astype(np.uint64))
        key ^= mix(w.text[: len(key)].astype(np.uint64) + np.uint64(1))  # windows of different texts don't meet
        fits = np.flatnonzero(w.text[: len(key)] == w.text[window - 1 :])
        key = key[fits]
        order = np.argsort(key, kind="stable")
        near = np.flatnonzero(key[order][1:] == key[order][:-1])
        a, b = fits[order[near]], fits[order[near + 1]]
        if all(np.array_equal(ids[a + j], ids[b + j]) for j in range(window)) and np.array_equal(w.text[a], w.text[b]):
            at = np.unique(np.concatenate([a, b]))
        else:  # two windows of one hash aren't equal
            seen: dict[tuple, list[int]] = {}
            for i in fits.tolist():
                seen.setdefault((int(w.text[i]), *ids[i : i + window].tolist()), []).append(i)
            at = np.array(sorted(i for places in seen.values() if len(places) > 1 for i in places), np.int64)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    inside = np.cumsum(covered[:n]) > 0
    return _sums(inside, w.first[:-1], w.first[1:])


def text_stats(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The exact counts by name, and a row of FEATURES per text."""
    w = words(texts)
    n = w.counts()
    chars = char_counts(w.data)
    word_chars = _sums(chars[w.end] - chars[w.start], w.first[:-1], w.first[1:])
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    a, b = w.text_start, w.text_end
    n_symbols = _sums(table[w.data], a, b)
    ids = w.ids(w.hashes())
    n_repeat = repeated_words(w, ids)
    n_texts = len(a)
    n_dup, n_lines, short = np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    raw = w.data.tobytes()
    for i, (s, e) in enumerate(zip(a.tolist(), b.tolist())):
        seen = set()
        dup = full = few = 0
        for line in raw[s:e].split(b"\n"):
            if line in seen:
                dup += not line.isspace() and line != b""
            else:
                seen.add(line)
            if line and not line.isspace():
                full += 1
                few += len(line) < 30
        n_dup[i], n_lines[i], short[i] = dup, full, few
    distinct, top = np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    if len(ids):
        key = w.text * (int(ids.max()) + 1) + ids
        order = np.argsort(key)
        sk, st = key[order], w.text[order]
        head = np.flatnonzero(np.concatenate([[True], sk[1:] != sk[:-1]]))
        runs = np.diff(np.append(head, len(sk)))
        distinct = np.bincount(st[head], minlength=n_texts)
        np.maximum.at(top, st[head], runs)
    d = w.data
    upper, digit, wide = (d >= 65) & (d <= 90), (d >= 48) & (d <= 57), d >= 128
    letter = upper | ((d >= 97) & (d <= 122))
    punct = (d > 32) & (d < 127) & ~letter & ~digit
    total = np.maximum(1, n)
    per_char = np.maximum(1, word_chars)
    ends = d[np.maximum(w.end - 1, 0)] if len(w.end) else np.zeros(0, np.uint8)
    first = d[w.start] if len(w.start) else np.zeros(0, np.uint8)
    colon = (d[:-2] == 58) & (d[1:-1] == 47) & (d[2:] == 47) if len(d) > 2 else np.zeros(0, bool)
    colon = np.concatenate([colon, np.zeros(len(d) - len(colon), bool)])
    by_word = lambda flags: _sums(flags, w.first[:-1], w.first[1:]) / total
    cols = [
        np.log1p(n), word_chars / total, n_symbols / per_char, n_dup / np.maximum(1, n_lines), n_repeat / total, _sums(upper, a, b) / per_char, _sums(digit, a, b) / per_char, _sums(punct, a, b) / per_char,
        _sums(wide, a, b) / per_char, distinct / total, top / total, np.log1p(n / np.maximum(1, n_lines)), short / np.maximum(1, n_lines), by_word(table[ends] | (ends == 33)), by_word((first >= 65) & (first <= 90)), _sums(colon, a, b) / total,
    ]
    counts = {"n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat}
    return {k: v.astype(np.int64) for k, v in counts.items()}, np.column_stack(cols).astype(np.float64)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _run(batches):
    for batch in batches:
        for part in slices(batch, "t"):
            counts, x = text_stats(part.column("t"))
            offsets = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(counts[c]) for c in COUNTS), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["doc_id", *COUNTS, "x"])


def stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, x array<double> of FEATURES) of every row; null texts count as empty."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return bounded_batches(texts).mapInArrow(_run, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, x array<double>")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(label_id, y): a label per doc_id; where rows disagree, 1 if half of them or more say so; null labels don't count."""
    y = F.avg(F.col(column).cast("double"))
    return labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((y >= 0.5).cast("int").alias("y"))


def bounded_sample(labelled: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """The rows with the smallest hashes of their key, so many at most; the same ones whatever the partitioning.

    They are counted first, so that each task sends on only rows that can be among them.
    """
    n = labelled.count()
    if n > 2 * rows:
        labelled = labelled.where(F.xxhash64(key) <= F.lit(int(-(2**63) + 2**64 * 2 * rows / n)))
    return labelled.orderBy(F.xxhash64(key), key).limit(rows)
