"""op1's forest and threshold come from every labelled row."""

import numpy as np
import pytest

from layoutspark.llm import quality_rules
from layoutspark.llm.stats import FEATURES, stats


def rows_of(spark, n):
    docs = spark.range(n).selectExpr("id as doc_id", "if(id % 50 = 0, repeat(concat('#', id, ' & * '), 30), concat_ws(' ', transform(sequence(1, 20 + id % 9), i -> concat('w', (id * 7 + i * i) % 977)))) as text")
    return docs, spark.range(n).selectExpr("id as doc_id", "int(id % 50 <> 0) as quality")


def test_all_labelled_rows_are_fitted(spark):
    docs, labels = rows_of(spark, 10_300)
    table = stats(docs).cache()
    rules = quality_rules.fit(table, labels)
    x = np.stack(table.where("n_words >= 20 and 100 * n_repeat_words <= 30 * n_words").toPandas().sort_values("doc_id")["x"].to_numpy())
    assert rules.n_rows == len(x) > 10_000
    again = quality_rules.fit(table.repartition(7), labels)
    assert again.threshold == rules.threshold and all(np.array_equal(getattr(again.forest, k), getattr(rules.forest, k)) for k in ("feature", "cut", "low", "length"))


@pytest.mark.parametrize("n, trees, per_tree", [(1, 5, 8), (30, 7, 16), (64, 8, 8), (300, 8, 8)])
def test_every_row_is_in_a_tree(spark, n, trees, per_tree, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality_rules, "forest_of", lambda grown, of: sizes.extend(of))
    rows = spark.range(n).selectExpr("id as doc_id", f"array_repeat(rand(1), {len(FEATURES)}) as x")
    quality_rules.grow_all(rows, n, trees, per_tree)
    times = min(trees, max(1, -(-trees * per_tree // n)))
    assert sum(sizes) == n * times and len(sizes) <= trees


def test_the_threshold_of_counts_is_that_of_rows():
    r = np.random.default_rng(2)
    for _ in range(20):
        score, good = r.integers(0, 30, 400) / 8, r.random(400) < 0.7
        score[~good] += r.integers(0, 12, (~good).sum()) / 8
        steps = np.unique(score)
        gain = lambda t: (score[~good] > t).mean() - 3 * (score[good] > t).mean()
        cut = quality_rules.calibrate_counts(steps, *(np.array([(score[w] == s).sum() for s in steps]) for w in (~good, good)), 3)
        assert cut == quality_rules.calibrate(score, good, 3) and np.isclose(max(0, gain(cut)), max(0, *map(gain, [*steps, -1])))
