"""Quality rules with an isolation forest over the rule statistics.

The base rules are exact: a text fails with fewer than MIN_WORDS words, or if over MAX_REPEAT_PERCENT of its words
lie in eight-word windows that it repeats. For the others a forest of random splits over the rule statistics
(RULES; those of repeats are left to the base rules) decides: a text that few splits set apart has a short mean
path and so a high anomaly score. All labelled rows grow the forest: each row goes to one tree or more, so that a tree
has about PER_TREE rows or its share of all, and trees grow where their rows meet. The threshold comes from the labels of
all these rows, counted by score in steps of 1 / LEVELS: a lost share of the rows labelled good weighs GOOD_COST times a
caught share of the rows labelled bad. Without labels, or with labels of one kind, only the base rules reject.

Null and empty texts have no words and fail the base rules. Repeated rows and ties of score get the same verdict.
Long texts are used whole, one at a time if need be; windows are compared word by word. An empty table gives no rows.
Only the id and the text of documents are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, slices
from .stats import COUNTS, FEATURES, matrix, one_label, stats, text_stats

MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
TREES, PER_TREE, DEPTH, SEED = 200, 256, 10, 11
#: Steps of the score that the threshold is one of; times a power of two is exact.
LEVELS = 1 << 16
GOOD_COST = 20.0
RULES = ("symbol_share", "punct_share", "symbol_end_share", "upper_share", "top_word_share", "distinct_share", "mean_word_chars", "capital_share", "log_words")
_columns = [FEATURES.index(f) for f in RULES]


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), cut, child of the lower side (the upper one is next), path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    length: np.ndarray
    norm: float  # the expected path, in the mean of the trees

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            f, cut, low = self.feature[t], self.cut[t], self.low[t]
            for _ in range(DEPTH):
                inner = f[at] >= 0
                if not inner.any():
                    break
                up = x[rows, np.maximum(f[at], 0)] >= cut[at]
                at = np.where(inner, low[at] + up, at)
            total += self.length[t][at]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def expected_path(n: float) -> float:
    """Of an unsuccessful search in a random binary tree of n keys."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """feature, cut, low and length of a tree of all rows of x."""
    size = 2 ** (DEPTH + 1)
    feature, cut, low, length = np.full(size, -1), np.zeros(size), np.zeros(size, np.int64), np.zeros(size)
    used = 1
    todo = [(0, x, 0)]
    while todo:
        node, rows, depth = todo.pop()
        span = rows.max(0) - rows.min(0)
        if depth == DEPTH or len(rows) < 2 or not (span > 0).any():
            length[node] = depth + expected_path(len(rows))
            continue
        f = rng.choice(np.flatnonzero(span > 0))
        c = rows[:, f].min() + span[f] * rng.uniform()
        above = rows[:, f] >= c
        if above.all():  # the cut fell on the minimum itself
            c = np.nextafter(rows[:, f].min(), np.inf)
            above = rows[:, f] >= c
        feature[node], cut[node], low[node] = f, c, used
        todo += [(used, rows[~above], depth + 1), (used + 1, rows[above], depth + 1)]
        used += 2
    return feature, cut, low, length


def forest_of(grown: list[tuple], sizes: list[int]) -> Forest:
    """The trees together, cut behind the nodes that the largest has; sizes: how many rows each has."""
    nodes = max(2 * int((feature >= 0).sum()) + 1 for feature, *_ in grown)
    return Forest(*(np.stack([x[:nodes] for x in part]) for part in zip(*grown)), max(float(np.mean([expected_path(n) for n in sizes])), 1e-9))


def grow(x: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = SEED) -> Forest:
    """A forest of rows at hand, each tree of some drawn at random."""
    rng = np.random.default_rng(seed)
    n = min(per_tree, len(x))
    return forest_of([grow_tree(x[rng.choice(len(x), n, replace=False)], rng) for _ in range(trees)], [n] * trees)


def grow_all(rows: DataFrame, n: int, trees: int = TREES, per_tree: int = PER_TREE, seed: int = SEED) -> Forest:
    """A forest of all n rows (doc_id, x array<double>): each is dealt by its hash to as many trees as per_tree rows a tree take, one at least."""
    times = min(trees, max(1, -(-trees * per_tree // n)))
    first = F.pmod(F.xxhash64("doc_id", "x", F.lit(seed)), F.lit(trees))
    step = trees // times  # the trees of one row differ
    dealt = rows.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(times - 1)), lambda i: F.pmod(first + i * step, F.lit(trees)))).alias("tree"), "doc_id", "x")

    def one(key, table):
        x = matrix(table.column("x"), len(FEATURES))[:, _columns]
        x = x[np.lexsort((*x.T, table.column("doc_id").to_numpy()))]  # in any order of arrival the same
        tree = grow_tree(x, np.random.default_rng([seed, key[0].as_py()]))
        return pa.table({"tree": [key[0].as_py()], "n": [len(x)], **{name: pa.array([part.tolist()], pa.list_(t)) for name, part, t in zip(("feature", "cut", "low", "length"), tree, (pa.int64(), pa.float64(), pa.int64(), pa.float64()))}})

    found = dealt.groupBy("tree").applyInArrow(one, "tree long, n long, feature array<long>, cut array<double>, low array<long>, length array<double>").toPandas().sort_values("tree")
    return forest_of([tuple(np.array(r[c]) for c in ("feature", "cut", "low", "length")) for r in found.to_dict("records")], found["n"].tolist())


def calibrate(scores: np.ndarray, good: np.ndarray, good_cost: float = GOOD_COST) -> float:
    """The threshold, above which a text is rejected, with the best share of bad rows less good_cost times that of good rows."""
    steps, at = np.unique(scores, return_inverse=True)
    return calibrate_counts(steps, np.bincount(at, ~good, len(steps)), np.bincount(at, good, len(steps)), good_cost)


def calibrate_counts(scores: np.ndarray, bad: np.ndarray, good: np.ndarray, good_cost: float = GOOD_COST) -> float:
    """The same from the numbers of bad and good rows of each distinct score; rows of one score are rejected together."""
    if not good.sum() or not bad.sum():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s = scores[order]
    gain = np.cumsum(bad[order]) / bad.sum() - good_cost * np.cumsum(good[order]) / good.sum()
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return float("inf")
    return float((s[best] + s[best + 1]) / 2) if best + 1 < len(s) else float(np.nextafter(s[best], -np.inf))


@dataclass
class Rules:
    """The base rules and the fitted forest."""

    forest: Forest | None
    threshold: float
    n_rows: int = 0  # that the forest and the threshold come from

    def __call__(self, counts, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the base rules fail, the anomaly score and the verdict of each text."""
        failed = base_failed(counts)
        score = self.forest.score(x[:, _columns]) if self.forest else np.zeros(len(failed))
        return failed, score, ~failed & (score <= self.threshold)


def base_failed(c) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def fit(table: DataFrame, labels: DataFrame) -> Rules:
    """From the statistics (`stats`) of all labelled documents; the texts stay where they are."""
    known = one_label(labels, "quality")
    # base failures are decided already; the forest learns what else is odd
    rows = table.where(f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words").select("doc_id", "x")
    rows = materialize(rows.join(known, F.col("doc_id") == F.col("label_id")).select("doc_id", "x", "y"), "labelled-stats")
    n = rows.count()
    if not n:
        return Rules(None, float("inf"))
    forest = grow_all(rows, n)
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def levels(batches):
        for batch in batches:
            score = shared.value.score(matrix(batch.column("x"), len(FEATURES))[:, _columns])
            yield pa.RecordBatch.from_arrays([pa.array(np.ceil(score * LEVELS).astype(np.int64)), batch.column("y")], ["level", "y"])

    counts = rows.select("x", "y").mapInArrow(levels, "level long, y int").groupBy("level").agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")).toPandas().sort_values("level")
    # a step k holds the scores over (k - 1) / LEVELS, up to k / LEVELS; the threshold is one of these bounds
    threshold = calibrate_counts(counts["level"].to_numpy(float), counts["bad"].to_numpy(float), counts["good"].to_numpy(float))
    return Rules(forest, float(np.floor(threshold)) / LEVELS, n)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, base_failed, anomaly_score, kept), a row per row of docs; texts are read once and not shuffled."""
    table = materialize(stats(docs, id_col, text_col), "rule-stats")
    rules = docs.sparkSession.sparkContext.broadcast(fit(table, labels))

    def run(batches):
        for batch in batches:
            counts = {c: batch.column(c).to_numpy() for c in COUNTS}
            failed, score, kept = rules.value(counts, matrix(batch.column("x"), len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *COUNTS)), pa.array(failed), pa.array(score), pa.array(kept)], ["doc_id", *COUNTS, "base_failed", "anomaly_score", "kept"])

    return table.mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, anomaly_score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that quality_rules rejects; all columns as they were, and no shuffle of texts, which are read twice."""
    rules = docs.sparkSession.sparkContext.broadcast(fit(materialize(stats(docs, id_col, text_col), "rule-stats"), labels))
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            named = batch.rename_columns([str(i) for i in range(batch.num_columns)])
            for part in slices(named, str(place)):
                yield part.filter(pa.array(rules.value(*text_stats(part.column(place).fill_null("")))[2])).rename_columns(batch.schema.names)

    return bounded_batches(docs).mapInArrow(run, docs.schema)
