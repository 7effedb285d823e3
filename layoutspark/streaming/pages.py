"""Pages that arrive as files: micro-batches through the same operators, faults kept apart, reports as they grow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import reports


def arriving(spark: SparkSession, folder: str, schema: str, per_batch: int = 1, kind: str = "parquet") -> DataFrame:
    """Rows of files as they arrive, so many files a micro-batch."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch).load(folder)


def process(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, failed: str | None = None) -> StreamingQuery:
    """Each micro-batch through `work` to Parquet. With `failed`, a batch that fails is halved by pages until the pages that fail are found.

    Results and failures of an epoch are written under its number and overwritten if it is run again, so they come
    once. A batch of n pages with k bad ones costs some 2 k log n jobs more, not n.
    """

    def attempt(rows: DataFrame, target: str, part: str, pages: list | None) -> list[tuple]:
        some = rows if pages is None else rows.where(F.col("page_id").isin(pages))
        try:
            work(some).write.mode("overwrite").parquet(f"{target}/part={part}")
            return []
        except Exception as error:
            if failed is None:
                raise
            if pages is None:
                pages = sorted(r["page_id"] for r in rows.select("page_id").distinct().collect())  # of one micro-batch
            if len(pages) <= 1:
                return [(page, str(error)) for page in pages]
            half = len(pages) // 2
            return attempt(rows, target, part + "0", pages[:half]) + attempt(rows, target, part + "1", pages[half:])

    def batch(rows: DataFrame, epoch: int) -> None:
        spark, target = rows.sparkSession, f"{out}/epoch={epoch}"
        at = spark._jvm.org.apache.hadoop.fs.Path(target)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)  # parts of an earlier run of the epoch
        bad = attempt(rows, target, "0", None)
        if failed is not None:
            spark.createDataFrame(bad, "page_id long, error string").write.mode("overwrite").parquet(f"{failed}/epoch={epoch}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def report(stream: DataFrame, profiles: str, show: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Page profiles appended per micro-batch, and the summary over all of them made again."""

    def batch(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{profiles}/epoch={epoch}")
        show(reports.benchmark_summary(rows.sparkSession.read.parquet(profiles)))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """(start, event_type, n, total) per window of event time, with a watermark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, key: Column, gap: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n) of runs of events no further apart than the gap."""
    return events.withWatermark("ts", late).groupBy(key.alias("key"), F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("key", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
