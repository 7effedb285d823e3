"""Layout tables made from the general tables by integer formulas, the same ones as in the DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Page sizes (width, height) of the adapted lines and boxes.
LINE_PAGE, BOX_PAGE = (1200, 1600), (1400, 1600)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ocr_lines(docs: DataFrame) -> DataFrame:
    """(page_id, line_no, text, confidence, x1, y1, x2, y2): the non-blank lines of a text, set in two columns."""
    lines = docs.select(F.col("doc_id").alias("page_id"), F.filter(F.split("text", "\n"), lambda t: F.trim(t) != "").alias("ts"))
    rows = lines.select("page_id", F.size("ts").cast("long").alias("n"), F.posexplode("ts").alias("line_no", "text")).withColumn("line_no", F.col("line_no").cast("long"))
    rows = rows.withColumn("half", F.floor((F.col("n") + 1) / 2)).withColumn("col", F.floor(F.col("line_no") / F.col("half"))).withColumn("row", F.col("line_no") % F.col("half"))
    x1, y1 = 60 + 520 * F.col("col"), 80 + 40 * F.col("row") + 60 * F.floor(F.col("row") / 7)
    h = F.when(F.col("line_no") == 0, F.lit(48)).otherwise(24 + (F.col("page_id") + F.col("line_no")) % 5)
    confidence = (45 + (F.col("page_id") * 7 + F.col("line_no") * 13) % 55) / 100.0
    return rows.select("page_id", "line_no", "text", confidence.alias("confidence"), x1.alias("x1"), y1.alias("y1"), (x1 + F.least(F.lit(500), 40 + 6 * F.length("text"))).alias("x2"), (y1 + h).cast("long").alias("y2"))


LINES_SQL = """ls AS (SELECT doc_id AS page_id, list_filter(string_split(text, chr(10)), lambda t: trim(t) <> '') AS ts FROM documents WHERE text IS NOT NULL),
le AS (SELECT page_id, len(ts) AS n, unnest(range(len(ts))) AS line_no, unnest(ts) AS text FROM ls),
lp AS (SELECT *, line_no // ((n + 1) // 2) AS col, line_no % ((n + 1) // 2) AS row FROM le),
lines AS (SELECT page_id, line_no, text, (45 + (page_id * 7 + line_no * 13) % 55) / 100.0::DOUBLE AS confidence, 60 + 520 * col AS x1, 80 + 40 * row + 60 * (row // 7) AS y1,
  60 + 520 * col + least(500, 40 + 6 * length(text)) AS x2, 80 + 40 * row + 60 * (row // 7) + CASE WHEN line_no = 0 THEN 48 ELSE 24 + (page_id + line_no) % 5 END AS y2 FROM lp)"""


def candidates(lineitem: DataFrame) -> DataFrame:
    """(page_id, rk, box, score and seven metrics): distinct boxes of a page, ranked by score."""
    i = lambda c: F.col(c).cast("long")
    x1, y1 = i("l_partkey") * 37 % 900, i("l_suppkey") * 53 % 1200
    rows = lineitem.select(
        i("l_orderkey").alias("page_id"), x1.alias("x1"), y1.alias("y1"), (x1 + 20 + F.floor("l_quantity") * 9).alias("x2"), (y1 + 20 + i("l_linenumber") * 61 % 400).alias("y2"), F.col("l_discount").alias("score"),
        F.col("l_tax").alias("edge_density"), (F.col("l_discount") * 10).alias("fill_ratio"), (i("l_partkey") % 50 / 100.0).alias("text_overlap_ratio"), (i("l_suppkey") % 80 / 10.0).alias("entropy"),
    ).distinct()
    w, h = BOX_PAGE
    rows = rows.withColumn("bw", F.col("x2") - F.col("x1")).withColumn("bh", F.col("y2") - F.col("y1"))
    rows = rows.withColumn("area_ratio", F.col("bw") * F.col("bh") / float(w * h)).withColumn("short_side_ratio", F.least("bw", "bh") / float(min(w, h))).withColumn("aspect_ratio", F.greatest("bw", "bh") / F.greatest(F.lit(1), F.least("bw", "bh")).cast("double"))
    order = W.partitionBy("page_id").orderBy(F.col("score").desc(), "x1", "y1", "x2", "y2", "edge_density", "fill_ratio", "text_overlap_ratio", "entropy")
    return rows.drop("bw", "bh").withColumn("rk", F.row_number().over(order))


BOXES_SQL = """b0 AS (SELECT DISTINCT l_orderkey AS page_id, (l_partkey * 37) % 900 AS x1, (l_suppkey * 53) % 1200 AS y1, (l_partkey * 37) % 900 + 20 + floor(l_quantity)::BIGINT * 9 AS x2,
  (l_suppkey * 53) % 1200 + 20 + (l_linenumber * 61) % 400 AS y2, l_discount AS score, l_tax AS edge_density, l_discount * 10 AS fill_ratio, (l_partkey % 50) / 100.0::DOUBLE AS text_overlap_ratio, (l_suppkey % 80) / 10.0::DOUBLE AS entropy FROM lineitem),
boxes AS (SELECT *, (x2 - x1) * (y2 - y1) / 2240000.0::DOUBLE AS area_ratio, least(x2 - x1, y2 - y1) / 1400.0::DOUBLE AS short_side_ratio, greatest(x2 - x1, y2 - y1) / greatest(1, least(x2 - x1, y2 - y1))::DOUBLE AS aspect_ratio,
  row_number() OVER (PARTITION BY page_id ORDER BY score DESC, x1, y1, x2, y2, edge_density, fill_ratio, text_overlap_ratio, entropy) AS rk FROM b0)"""


def pixels(part: DataFrame, side: int = 16) -> DataFrame:
    """(page_id, y, x, v): a small gray plane per part.

    The pages are dealt out before they grow to pixels: then all tasks share the work, and a join or group by page moves no pixel.
    """
    at = F.sequence(F.lit(0), F.lit(side - 1))
    pages = part.select(F.col("p_partkey").cast("long").alias("page_id")).repartition("page_id")
    rows = pages.select("page_id", F.explode(at).alias("y")).select("page_id", "y", F.explode(at).alias("x"))
    return rows.withColumn("v", ((F.col("page_id") * 31 + F.col("x") * 7 + F.col("y") * 13) % 256).cast("int"))


PIXELS_SQL = """px AS (SELECT p_partkey AS page_id, y, x, ((p_partkey * 31 + x * 7 + y * 13) % 256)::INTEGER AS v FROM part, (SELECT unnest(range(16)) AS y), (SELECT unnest(range(16)) AS x))"""
