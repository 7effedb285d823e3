"""Quality scores by ridge regression on random Fourier features of document statistics, then isotonic calibration.

The statistics (`stats.FEATURES`) are scaled by the training rows' mean and spread. FEATURES_OUT cosines of random
projections approximate a Gaussian kernel over them. Each partition sums its part of the normal equations, the
parts are added block by block on the executors, and the driver solves the one system that is left, of a fixed
size. Scores of the training rows are then made monotone in the label rate by pool-adjacent-violators over
BINS quantile bins (counts per bin, summed likewise), which gives a score between 0 and 1.

Labels are learnt only from ids whose crc32 modulo 5 isn't 0. Neither labels, lang, source nor ids enter a score.
Statistics further than CLIP spreads from the mean count as that far. Null and empty texts have statistics of 0 and
are scored like others. Without training rows all scores are 0.5; with one kind of label, that label's rate. Repeated
rows and ties of statistics get the same score; an empty table gives no rows. Long texts are used whole, one at a time
if need be. Only the id and the text of documents are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_sums, materialize, packed
from .stats import FEATURES, matrix, one_label, stats

FEATURES_OUT, RIDGE, GAMMA, SEED, BINS, CUT, CLIP = 384, 1.0, 0.06, 23, 64, 0.3, 8.0
FOLDS = 5
#: Pieces that a matrix is summed in, each by tasks of its own.
BLOCKS = 16


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


class Fourier:
    """Scaled statistics to cosines and sines; drawn from the seed alone."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, n: int = FEATURES_OUT, gamma: float = GAMMA, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.w = rng.normal(scale=np.sqrt(2 * gamma), size=(len(mean), n))
        self.phase = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -CLIP, CLIP)
        out = np.cos(z @ self.w + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([np.ones((len(x), 1)), out])


def _summed(rows: DataFrame, part, width: int, height: int) -> np.ndarray | None:
    """The sum of part(batch), a matrix of height x width, over all batches: per partition, then on the executors in two levels."""
    pieces = min(height, BLOCKS)

    def partition(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                m = part(batch)
                total = m if total is None else total + m
        if total is not None:
            for i, piece in enumerate(np.array_split(total, pieces)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(piece)], pa.binary())], ["i", "v"])

    found = block_sums(rows.mapInArrow(partition, "i int, v binary"))
    return np.concatenate([found[i] for i in range(pieces)]).reshape(height, width) if found else None


def isotonic(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The rates by bin, made non-decreasing by pooling neighbours; an empty bin takes the rate before it."""
    pools: list[list[float]] = []
    for n, y in zip(total, ones):
        pools.append([n, y, 1])
        while len(pools) > 1 and pools[-2][1] * max(pools[-1][0], 1e-12) >= pools[-1][1] * max(pools[-2][0], 1e-12):
            n, y, k = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + y, pools[-1][2] + k]
    return np.concatenate([np.full(k, y / n if n else 0.5) for n, y, k in pools])


@dataclass
class Model:
    """Statistics to scores; of a fixed size."""

    fourier: Fourier | None = None
    weights: np.ndarray | None = None
    edges: np.ndarray | None = None
    rates: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), 0.5)
        return np.clip(self.rates[np.searchsorted(self.edges, self.fourier(x) @ self.weights)], 0, 1)


def fit(train: DataFrame) -> Model:
    """train has x and y."""
    d = len(FEATURES)

    def moments(batch):
        x = matrix(batch.column("x"), d)
        return np.vstack([np.full(d, len(x)), x.sum(0), (x * x).sum(0)])

    m = _summed(train, moments, d, 3)
    if m is None:
        return Model()
    mean = m[1] / m[0]
    fourier = Fourier(mean, np.sqrt(np.maximum(m[2] / m[0] - mean**2, 1e-6)))

    def normal(batch):
        z, y = fourier(matrix(batch.column("x"), d)), batch.column("y").to_numpy().astype(float)
        return np.vstack([z.T @ z, z.T @ y])

    size = FEATURES_OUT + 1
    g = _summed(train, normal, size, size + 1)
    weights = np.linalg.solve(g[:size] + RIDGE * np.eye(size), g[size])
    edges = np.linspace(-0.5, 1.5, BINS * 8 + 1)[1:-1]

    def binned(batch):
        s, y = fourier(matrix(batch.column("x"), d)) @ weights, batch.column("y").to_numpy().astype(float)
        k = np.searchsorted(edges, s)
        return np.vstack([np.bincount(k, minlength=len(edges) + 1), np.bincount(k, y, minlength=len(edges) + 1)]).astype(float)

    counts = _summed(train, binned, len(edges) + 1, 2)
    # fine bins are joined to about BINS of equal counts, so that no rate hangs on a few rows
    group = np.minimum((np.cumsum(counts[0]) - counts[0]) / max(counts[0].sum() / BINS, 1), BINS - 1).astype(int)
    rates = isotonic(np.bincount(group, counts[0], minlength=BINS), np.bincount(group, counts[1], minlength=BINS))[group]
    return Model(fourier, weights, edges, rates)


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per row of docs."""
    each = materialize(stats(docs, id_col, text_col).select("doc_id", "x"), "document-statistics")
    train = materialize(each.join(one_label(labels, "quality"), F.col("doc_id") == F.col("label_id")).where(~held_out()).select("x", "y"), "training-rows")
    model = docs.sparkSession.sparkContext.broadcast(fit(train))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                s = model.value(matrix(batch.column("x"), len(FEATURES)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    return each.mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held_out().alias("held_out"), "score", "predicted")
