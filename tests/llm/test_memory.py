"""What executors and their workers hold at a time: it doesn't follow the length of texts or the deepest tree possible."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layoutspark.llm import ngram_join, packing, quality_rules, stats

ROW = 1 << 16


def largest_batch(docs) -> int:
    """Bytes of the largest Arrow batch that docs is sent to Python in."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def long_texts(session):
    return session.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")), ROW // 5).alias("text"))


@pytest.mark.parametrize("operator", [stats.stats, packing.packing, ngram_join.ngram_join, lambda docs: quality_rules.keep_good(docs, docs.select("doc_id", F.lit(1).alias("quality")).limit(0))])
def test_batches_of_long_texts_are_small(spark, operator):
    session = spark.newSession()
    docs = long_texts(session)
    assert largest_batch(docs) > 8 << 20
    operator(docs if operator is not ngram_join.ngram_join else docs.limit(4))
    assert largest_batch(docs) < 4 << 20


def test_a_bound_of_the_session_stays(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "512k")
    packing.packing(long_texts(session))
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "512k"
    assert largest_batch(long_texts(session)) < 1 << 20


def test_forest_keeps_the_nodes_it_has():
    x = np.random.default_rng(1).normal(size=(400, 3))
    grown = [quality_rules.grow_tree(x[i::8], np.random.default_rng(i)) for i in range(8)]
    forest = quality_rules.forest_of(grown, [50] * 8)
    whole = quality_rules.Forest(*(np.stack(part) for part in zip(*grown)), forest.norm)
    assert forest.feature.shape[1] < 100 < whole.feature.shape[1]
    assert np.array_equal(forest.score(x), whole.score(x))
    one = quality_rules.forest_of([quality_rules.grow_tree(x[:1], np.random.default_rng(0))], [1])
    assert one.feature.shape == (1, 1) and len(one.score(x)) == 400
