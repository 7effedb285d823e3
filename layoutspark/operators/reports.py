"""Reports over pages: run times and the quality of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import whole

#: The stages of a run.
STAGES = ("read_sec", "ocr_sec", "prep_sec", "text_group_classify_sec", "mask_sec", "visual_extract_sec", "crop_save_sec", "json_write_sec", "debug_sec")


def benchmark_summary(profiles: DataFrame, total: str = "total_sec", by: list[str] = []) -> DataFrame:
    """Pages, total, mean, median, 95th percentile by nearest rank, and pages a minute; one row of zeros without rows."""
    x = F.coalesce(F.col(total).cast("double"), F.lit(0.0))
    # the rank is found by exact counts of values, so no list of all pages is gathered
    values = profiles.select(*by, x.alias("v")).groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window as W

    keys = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    ranked = values.withColumn("upto", F.sum("n").over(keys.orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("all", F.sum("n").over(keys))
    rank = whole(0.95 * (F.col("all") - 1)) + 1
    low, high = F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1
    at = lambda r: F.min(F.when(F.col("upto") >= r, F.col("v")))
    out = ranked.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pages"), F.coalesce(F.sum(F.col("v") * F.col("n")), F.lit(0.0)).alias("t"), at(low).alias("m1"), at(high).alias("m2"), at(rank).alias("p95")
    )
    pages = F.greatest(F.lit(1), F.col("pages"))
    cell = lambda c, n=4: F.bround(F.coalesce(c, F.lit(0.0)), n)
    per_minute = F.when(F.col("pages") > 0, F.bround(F.col("pages") * 60.0 / F.greatest(F.col("t"), F.lit(1e-9)), 3)).otherwise(0.0)
    return out.select(*by, "pages", cell(F.col("t")).alias("total_sec"), cell(F.col("t") / pages).alias("avg_sec_per_page"), cell((F.col("m1") + F.col("m2")) / 2).alias("median_sec_per_page"), cell(F.col("p95")).alias("p95_sec_per_page"), per_minute.alias("throughput_pages_per_min"))


def stage_totals(profiles: DataFrame) -> DataFrame:
    """(stage, total_sec) over the stage columns that profiles have."""
    have = [s for s in STAGES if s in profiles.columns]
    sums = profiles.agg(*[F.bround(F.coalesce(F.sum(F.col(s).cast("double")), F.lit(0.0)), 4).alias(s) for s in have])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("total_sec")) for s in have])).alias("s")).select("s.*")


def visual_report(regions: DataFrame) -> DataFrame:
    """One row: pages with regions, regions, median area, tiny and huge ones. regions has page_id and area_ratio."""
    return regions.agg(F.countDistinct("page_id").alias("pages"), F.count(F.lit(1)).alias("total"), F.bround(F.coalesce(F.median("area_ratio"), F.lit(0.0)), 4).alias("median_area_ratio"), F.count_if(F.col("area_ratio") < 0.03).alias("tiny"), F.count_if(F.col("area_ratio") > 0.65).alias("huge"))


def role_report(blocks: DataFrame) -> DataFrame:
    """(page_id, headline, content, other, dialogue_as_headline) per page; *_group roles count as their plain ones."""
    role = F.regexp_replace("role", "_group$", "")
    return blocks.groupBy("page_id").agg(
        F.count_if(role == "headline").alias("headline"), F.count_if(role == "content").alias("content"), F.count_if(~role.isin("headline", "content")).alias("other"),
        F.count_if((role == "headline") & F.trim("text").rlike("^[-–—]")).alias("dialogue_as_headline"),
    )


def first_examples(rows: DataFrame, order: list[str], most: int = 10) -> DataFrame:
    return rows.orderBy(*order).limit(most)


def page_budget(sources: DataFrame, most: int, start: int = 1) -> DataFrame:
    """The first pages of a run: images before PDFs, by name and number; PDFs from page `start` on."""
    kept = sources.where((F.col("kind") == "image") | (F.col("page_no") >= start))
    return kept.orderBy(F.when(F.col("kind") == "image", 0).otherwise(1), F.lower("name"), "name", "page_no").limit(most)
