"""Mixing sources to target weights, in DataFrame functions only.

Words are counted per document and summed per source. The sources in code-point order, null last, weigh 1, 2, 3,
repeating, and share the sum of all sizes; a target stops at CAP times its source's size, and what is above is
shared again by weight until no target is above. That fixpoint is a water level: with the sources sorted by
cap / weight, those up to some point stop at their cap and the others get weight times one level.

A document is emitted floor(rate) times, rate being target / source size, and once more if the uniform number that
its id and the seed hash to lies below the fraction of the rate. So a rerun gives the same rows, and no document
comes more than CAP times. Null and wordless texts have size 0 and take nothing whatever the rate; if no text has
a word, all targets are 0. Repeated rows are rows like others and share the draw of their id; a null id draws as
the word null. Ties of the level go by the order of the sources. Long texts are counted whole, an empty table gives
no rows. Only id, text and source are read, so other columns may have any name. The windows that find the level see a
row per source in one task: MOST_SOURCES rows are allowed there, more are an error (a source isn't meant to be a host).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, checked_broadcast, materialize

CAP = 3
SEED = "mix-1"
MOST_SOURCES = 1_000_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size) as a table in the shared folder: texts are read once."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")), "sizes")


def targets(sized: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of each source. Windows are over sources alone, a row each."""
    per = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    if len(per.limit(MOST_SOURCES + 1).select(F.lit(1)).offset(MOST_SOURCES).take(1)):
        raise ValueError(f"over {MOST_SOURCES} sources")
    by_name, by_level = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("level", "rank")
    rest, every = by_level.rowsBetween(W.currentRow, W.unboundedFollowing), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = per.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    ranked = ranked.withColumn("level", F.lit(cap) * F.col("source_size") / F.col("weight"))
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumn("left", F.sum("source_size").over(every) - F.coalesce(cap * F.sum("source_size").over(before), F.lit(0))).withColumn("share", F.col("left") / F.sum("weight").over(rest))
    # The level is the share at the first source that its share doesn't lift above its cap.
    level = F.min(F.when(F.col("share") <= F.col("level"), F.struct("level", "rank", "share"))).over(every)["share"]
    return ranked.select("source", "source_size", F.least((F.col("source_size") * cap).cast("double"), F.col("weight") * level).alias("target"))


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies) of every row."""
    sized = sizes(docs, id_col, text_col, source_col)
    rates = checked_broadcast(materialize(targets(sized), "targets").withColumnRenamed("source", "of"))
    found = sized.join(rates, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    n = F.floor(rate) + (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return found.select("doc_id", "size", "source", "source_size", "target", n.alias("copies"))


def mix(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row."""
    return copies(docs, **columns).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """docs with each row as often as the mix takes it; texts are not shuffled."""
    sized = sizes(docs, id_col, text_col, source_col)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = checked_broadcast(materialize(targets(sized).select(F.col("source").alias("mix_of"), rate.alias("mix_rate")), "rates"))
    n = F.floor(rates["mix_rate"]) + (draw(docs[id_col], seed) < rates["mix_rate"] - F.floor(rates["mix_rate"])).cast("long")
    times = F.array_repeat(F.lit(1), n.cast("int"))  # none: the row goes
    found = docs.join(rates, docs[source_col].eqNullSafe(rates["mix_of"]))
    return found.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.explode(times).alias("copy")).select("row.*")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM p),
w AS (SELECT *, (rank - 1) % 3 + 1 AS weight, (3 * source_size)::DOUBLE / ((rank - 1) % 3 + 1) AS level FROM r),
s AS (SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER (ORDER BY level, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share FROM w),
l AS (SELECT share FROM s WHERE share <= level ORDER BY level, rank LIMIT 1),
t AS (SELECT s.source, source_size, least((3 * source_size)::DOUBLE, weight * l.share) AS target FROM s, l),
u AS (SELECT d.doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM u)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""
