"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A text's features are the hashed, lower-cased words that it has (2 ** BITS of them; a word is split from its outer
punctuation). A bounded sample (SAMPLE labelled rows) trains it, a fifth of it calibrates only. First, words are tried
by their log-odds between toxic and other rows, counted on the executors; the WORDS words that stand out most (in
LEAST_ROWS toxic rows or more) are the model's. The labels only say toxic or not, so a toxic row's grade, 1 to
GRADES - 1, is made up: how many occurrences of words that stand out strongly it has. The regression learns that scale;
nothing validates it as a scale of harm. It has one weight per word, shared by all thresholds, and GRADES - 1 ordered
thresholds: P(grade > k) = sigmoid(w.x - b_k), fitted by gradient steps with a ridge penalty. The output is the
expected grade, the sum of P(grade > k); a text is called toxic where P(grade > 0) reaches a threshold that gives the
best F1 on the part of the sample that isn't fitted.

Null and empty texts have no feature, and so the base rate's grade. Repeated rows and ties get the same one. Without
labels, or with labels of one kind only, the expected severity is that of the base rate and nothing is called toxic.
Long texts are used whole, one at a time if need be; an empty table gives no rows. Only the id and the text of
documents are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, checked_broadcast, lowered, materialize, mix, powers, slices, words
from .stats import bounded_sample, one_label

BITS, SAMPLE, WORDS, GRADES, STEPS, RIDGE, LEAST_ROWS, SEED = 22, 20_000, 4096, 4, 300, 2.0, 3, 1


def word_features(w: Words, bits: int = BITS) -> np.ndarray:
    """A hashed id of each word without ASCII punctuation at its ends, in lower case; -1 where nothing is left."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    d = lowered(w.data)
    inner = (d >= 128) | ((d >= 97) & (d <= 122)) | ((d >= 48) & (d <= 57))
    at = np.arange(len(d) + 1)
    after = np.minimum.accumulate(np.where(np.append(inner, True), at, len(d))[::-1])[::-1]  # the next inner byte from here
    before = np.maximum.accumulate(np.where(np.append(inner, False), at, -1))  # the last inner byte up to here
    start, end = after[w.start], before[w.end - 1] + 1
    some = start < np.minimum(end, w.end)
    up, down = powers(len(d) + 1)
    sums = np.zeros(len(d) + 1, np.uint64)
    np.cumsum((d.astype(np.uint64) + np.uint64(1)) * up[: len(d)], out=sums[1:])
    s, e = np.where(some, start, 0), np.where(some, end, 0)
    h = mix((sums[e] - sums[s]) * down[s]) >> np.uint64(64 - bits)
    return np.where(some, h.astype(np.int64), -1)


@dataclass
class Severity:
    """The fitted model. `slot` maps a feature to its place among the weights, or to -1."""

    slot: np.ndarray | None = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bounds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, 30.0))
    cut: float = 2.0

    def above(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(raw[:, None] - self.bounds, -40, 40)))

    def raw(self, w: Words) -> np.ndarray:
        """w.x per text, each word once."""
        n = len(w.text_start)
        if self.slot is None or not len(w.start):
            return np.zeros(n)
        f = word_features(w)
        k = np.where(f >= 0, self.slot[f], -1)
        hit = np.flatnonzero(k >= 0)
        pair = np.unique(w.text[hit] * len(self.weights) + k[hit])
        return np.bincount(pair // max(1, len(self.weights)), self.weights[pair % max(1, len(self.weights))], minlength=n)


def _features(batches):
    for batch in batches:
        for part in slices(batch, "t"):
            w = words(part.column("t"))
            f = word_features(w)
            rows = [np.unique(f[a:b][f[a:b] >= 0], return_counts=True) for a, b in zip(w.first[:-1], w.first[1:])]
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("doc_id"), pa.array([x.astype(np.int32) for x, _ in rows], pa.list_(pa.int32())), pa.array([c.astype(np.int32) for _, c in rows], pa.list_(pa.int32()))], ["y", "doc_id", "f", "c"])


def standing_out(sampled: DataFrame, t1: int, t0: int) -> list:
    """(f, n1, n0, z) of the words that the model sees, best first; z is the log-odds, as sure as the rows are many."""
    counts = sampled.where("fitted").select("y", F.explode("f").alias("f")).groupBy("f").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))
    p1, p0 = (F.col("n1") + 0.05) / (t1 + 0.1), (F.col("n0") + 0.5) / (t0 + 1)
    rated = counts.where(F.col("n1") >= LEAST_ROWS).withColumn("z", (F.log(p1) - F.log(p0)) * F.sqrt("n1"))
    return rated.where("z > 3").orderBy(F.col("z").desc(), "f").limit(WORDS).collect()


def fit(sampled: DataFrame) -> Severity:
    """From (doc_id, y, fitted, f, c): the driver sees the counts of the words that stand out, and where these stand."""
    totals = {(r["y"], r["fitted"]): r["n"] for r in sampled.groupBy("y", "fitted").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, all_rows = sum(n for (y, _), n in totals.items() if y), sum(totals.values())
    if not ones or ones == all_rows:
        p = float(np.clip(ones / all_rows if all_rows else 0.0, 1e-6, 1 - 1e-6))
        return Severity(bounds=np.full(GRADES - 1, -np.log(p / (1 - p))))
    t1, t0 = max(1, totals.get((1, True), 0)), max(1, totals.get((0, True), 0))
    words_ = standing_out(sampled, t1, t0)
    slot = np.full(1 << BITS, -1, np.int32)
    slot[[r["f"] for r in words_]] = np.arange(len(words_))
    n1, n0, z = (np.array([r[x] for r in words_], float) for x in ("n1", "n0", "z"))
    strong = (z > 6) & ((n1 + 0.05) / (t1 + 0.1) > 8 * (n0 + 0.5) / (t0 + 1))
    seen = sampled.sparkSession.sparkContext.broadcast(slot)

    def places(batches):
        for batch in batches:
            f, c = batch.column("f"), batch.column("c")
            text = np.repeat(np.arange(len(f)), np.diff(f.offsets.to_numpy()))
            k = seen.value[f.flatten().to_numpy()]
            here = k >= 0
            ends = np.append(0, np.cumsum(np.bincount(text[here], minlength=len(f)))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[here].astype(np.int32))) for x in (k, c.flatten().to_numpy())]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("doc_id", "y", "fitted")), *lists], ["doc_id", "y", "fitted", "k", "c"])

    rows = sampled.mapInArrow(places, "doc_id long, y int, fitted boolean, k array<int>, c array<int>").toArrow().sort_by("doc_id").combine_chunks()
    y, fitted = rows.column("y").to_numpy().astype(np.int64), rows.column("fitted").to_numpy().astype(bool)
    lists = [rows.column(x).combine_chunks() for x in "kc"]
    cols, count = (x.flatten().to_numpy() for x in lists)
    rows_ = np.repeat(np.arange(len(y)), np.diff(lists[0].offsets.to_numpy()))
    occurrences = np.bincount(rows_, strong[cols] * count, minlength=len(y))
    grade = np.where(y == 1, np.clip(occurrences, 1, GRADES - 1), 0).astype(np.int64)
    model = Severity(slot, np.zeros(len(words_)), np.linspace(1.0, 3.0, GRADES - 1))
    for _ in descend(model, rows_, cols, grade, fitted):
        pass
    p = model.above(np.bincount(rows_, model.weights[cols], minlength=len(y)))[:, 0]
    check = ~fitted if y[~fitted].any() else np.ones(len(y), bool)
    model.cut = best_cut(p[check], y[check])
    return model


def slopes(model: Severity, rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    """The gradient of the penalised negative log-likelihood by weights and thresholds, per fitted row."""
    target = (grade[:, None] > np.arange(GRADES - 1)).astype(float)
    error = (model.above(np.bincount(rows, model.weights[cols], minlength=len(grade))) - target) * fitted[:, None]
    return np.concatenate([np.bincount(cols, error.sum(1)[rows], minlength=len(model.weights)) + RIDGE * model.weights, -error.sum(0)]) / max(1, int(fitted.sum()))


def descend(model: Severity, rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, fitted: np.ndarray, steps: int = STEPS):
    """Gradient steps on the model, which is changed; the thresholds stay in order."""
    n = len(model.weights)
    m, v = np.zeros(n + GRADES - 1), np.zeros(n + GRADES - 1)
    for step in range(1, steps + 1):
        slope = slopes(model, rows, cols, grade, fitted)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        model.weights -= move[:n]
        model.bounds = np.maximum.accumulate(model.bounds - move[n:])
        yield step


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the thresholds with the best F1."""
    cuts = np.unique(np.round(p, 3))
    cuts = np.concatenate([cuts, (cuts[1:] + cuts[:-1]) / 2])
    f1 = np.array([2 * ((p >= c) & (y == 1)).sum() / max(1, (p >= c).sum() + (y == 1).sum()) for c in cuts])
    return float(np.median(cuts[f1 >= f1.max() - 1e-12]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, expected_severity, toxic_probability, grade, toxic), a row per row of docs."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    chosen = bounded_sample(one_label(labels, "toxic"), sample, "label_id")
    fitted = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(5)) != 0).alias("fitted")
    sampled = texts.join(checked_broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("y", "doc_id", "t").mapInArrow(_features, "y int, doc_id long, f array<int>, c array<int>")
    model = docs.sparkSession.sparkContext.broadcast(fit(materialize(sampled.select("doc_id", "y", fitted, "f", "c"), "toxicity-sample")))

    def run(batches):
        found = model.value
        for batch in batches:
            for part in slices(batch, "t"):
                above = found.above(found.raw(words(part.column("t"))))
                grade = (above >= 0.5).sum(1)
                toxic = above[:, 0] >= found.cut
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(np.where(toxic, np.maximum(grade, 1), 0).astype(np.int32)), pa.array(toxic)], ["doc_id", "expected_severity", "toxic_probability", "grade", "toxic"])

    return texts.mapInArrow(run, "doc_id long, expected_severity double, toxic_probability double, grade int, toxic boolean")
