"""Pixel operators over long-form planes (page_id, y, x, v) and masks: aggregates, windows and range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def by_page():
    return W.partitionBy("page_id")


def entropy(pixels: DataFrame, keys: list[str] = ["page_id"], value: str = "v") -> DataFrame:
    """(keys, entropy): of the values' histogram, in bits."""
    hist = pixels.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")).withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy(*keys)))
    return hist.groupBy(*keys).agg(F.sum(-F.col("p") * F.log2("p")).alias("entropy"))


def mask_ratio(pixels: DataFrame, boxes: DataFrame, inside: Column) -> DataFrame:
    """boxes with the share of their pixels for which `inside` holds; 0 where a box has none.

    The boxes are hashed and the pixels pass by them. Left to itself, Spark takes exploded pixels for a small table and broadcasts them.
    """
    p, b = pixels.alias("p"), boxes.hint("shuffle_hash").alias("b")
    on = (F.col("p.page_id") == F.col("b.page_id")) & (F.col("p.x") >= F.col("b.x1")) & (F.col("p.x") < F.col("b.x2")) & (F.col("p.y") >= F.col("b.y1")) & (F.col("p.y") < F.col("b.y2"))
    keys = [F.col(f"b.{c}") for c in boxes.columns]
    return b.join(p, on, "left").groupBy(*keys).agg(F.coalesce(F.avg(F.when(F.col("p.v").isNotNull(), inside.cast("double"))), F.lit(0.0)).alias("ratio"))


def page_stats(pixels: DataFrame, white: int = 242) -> DataFrame:
    """(page_id, white_ratio, mean, entropy)."""
    return pixels.groupBy("page_id").agg(F.avg((F.col("v") >= white).cast("int")).alias("white_ratio"), F.avg("v").alias("mean")).join(entropy(pixels), "page_id")


def row_profile(pixels: DataFrame, inside: Column, axis: str = "y") -> DataFrame:
    return pixels.groupBy("page_id", axis).agg(F.avg(inside.cast("int")).alias("fill"))


def profile_runs(profile: DataFrame, active: Column, least: int, axis: str = "y") -> DataFrame:
    """(page_id, lo, hi): runs of at least so many active rows; hi is exclusive."""
    on = profile.where(active).withColumn("island", F.col(axis) - F.row_number().over(by_page().orderBy(axis)))
    return on.groupBy("page_id", "island").agg(F.min(axis).alias("lo"), (F.max(axis) + 1).alias("hi")).where(F.col("hi") - F.col("lo") >= least).drop("island")


def gaussian(size: int) -> list[float]:
    """A normalised kernel with the spread that goes with its size."""
    import math

    spread = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    raw = [math.exp(-((i - size // 2) ** 2) / (2 * spread**2)) for i in range(size)]
    return [x / sum(raw) for x in raw]


def smoothed(profile: DataFrame, value: str, size: int = 31, axis: str = "y") -> DataFrame:
    """profile with `value` smoothed along the axis; borders are mirrored without repeating the edge."""
    half = size // 2
    kernel = gaussian(size)
    lists = profile.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(axis, value))), lambda s: s[value]).alias("vs")).withColumn("n", F.size("vs"))
    period = F.greatest(F.lit(1), 2 * (F.col("n") - 1))

    def at(i: Column) -> Column:
        k = F.pmod(i, period)
        return F.element_at("vs", (F.when(k < F.col("n"), k).otherwise(period - k) + 1).cast("int"))

    out = F.transform("vs", lambda v, i: sum((F.lit(w) * at(i + (d - half)) for d, w in enumerate(kernel)), F.lit(0.0)))
    return lists.select("page_id", F.posexplode(out).alias(axis, value))


def split_row(profile: DataFrame, value: str, height: int, lo: float = 0.55, hi: float = 0.84) -> DataFrame:
    """(page_id, split): the first row of least value in the lower middle of a page."""
    a, b = max(0, min(height - 1, round(height * lo))), 0
    b = max(a + 1, min(height, round(height * hi)))
    if b - a <= 2:
        return profile.select("page_id").distinct().withColumn("split", F.lit(round(height * 0.62)))
    return profile.where((F.col("y") >= a) & (F.col("y") < b)).groupBy("page_id").agg(F.min(F.struct(value, "y"))["y"].alias("split"))


def quadrants(pixels: DataFrame, w: int, h: int, edge: Column, ink: Column, text: Column) -> DataFrame:
    """(page_id, qx, qy, shares) of the quadrants with enough edges and ink and not too much text."""
    q = pixels.withColumn("qx", (F.col("x") >= w // 2).cast("int")).withColumn("qy", (F.col("y") >= h // 2).cast("int"))
    shares = q.groupBy("page_id", "qx", "qy").agg(F.avg(edge.cast("int")).alias("edges"), F.avg(ink.cast("int")).alias("ink"), F.avg(text.cast("int")).alias("text"))
    return shares.where((F.col("edges") >= 0.018) & (F.col("ink") >= 0.16) & (F.col("text") <= 0.72))


def tight_box(pixels: DataFrame, feature: Column) -> DataFrame:
    """(page_id, box) around the pixels with the feature."""
    return pixels.where(feature).groupBy("page_id").agg(F.min("x").alias("x1"), F.min("y").alias("y1"), (F.max("x") + 1).alias("x2"), (F.max("y") + 1).alias("y2"))


def sobel(pixels: DataFrame) -> DataFrame:
    """pixels with gx and gy of the inner pixels: differences of neighbours, weighted 1, 2, 1 across."""
    row, col = W.partitionBy("page_id", "y").orderBy("x"), W.partitionBy("page_id", "x").orderBy("y")
    d = pixels.withColumn("dx", F.lead("v").over(row) - F.lag("v").over(row)).withColumn("sx", F.lag("v").over(row) + 2 * F.col("v") + F.lead("v").over(row))
    out = d.withColumn("gx", F.lag("dx").over(col) + 2 * F.col("dx") + F.lead("dx").over(col)).withColumn("gy", F.lead("sx").over(col) - F.lag("sx").over(col))
    return out.where("gx is not null and gy is not null").drop("dx", "sx")


def grid_score(pixels: DataFrame) -> DataFrame:
    """(page_id, grid_score): how much the strongest gradients stand out, on either axis."""
    part = lambda g: F.expr(f"percentile(abs({g}), 0.92)") / F.greatest(F.lit(1e-3), F.avg(F.abs(g)))
    return sobel(pixels).groupBy("page_id").agg(((part("gx") + part("gy")) / 2.0).alias("grid_score"))


def dilated(mask: DataFrame, radius: int, w: int, h: int) -> DataFrame:
    """(page_id, y, x) of the pixels within an ellipse of the radius around one of the mask."""
    offsets = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]
    spots = F.array(*[F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy, dx in offsets])
    return mask.select("page_id", F.explode(spots).alias("s")).select("page_id", "s.y", "s.x").where((F.col("y") >= 0) & (F.col("y") < h) & (F.col("x") >= 0) & (F.col("x") < w)).distinct()


def eroded(mask: DataFrame, radius: int, w: int, h: int) -> DataFrame:
    """(page_id, y, x) of the pixels whose whole ellipse (within the page) lies in the mask."""
    offsets = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]
    spots = F.array(*[F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy, dx in offsets])
    votes = mask.select("page_id", F.explode(spots).alias("s")).select("page_id", "s.y", "s.x").groupBy("page_id", "y", "x").agg(F.count(F.lit(1)).alias("n"))
    inside = sum((((F.col("y") + dy).between(0, h - 1)) & ((F.col("x") + dx).between(0, w - 1))).cast("int") for dy, dx in offsets)
    return votes.where((F.col("n") == inside) & F.col("y").between(0, h - 1) & F.col("x").between(0, w - 1)).select("page_id", "y", "x")


def filled_boxes(boxes: DataFrame, w: int, h: int) -> DataFrame:
    """(page_id, y, x) of the pixels in boxes, whose far corners count in."""
    ys, xs = F.sequence(F.greatest(F.lit(0), F.col("y1").cast("int")), F.least(F.lit(h - 1), F.col("y2").cast("int"))), F.sequence(F.greatest(F.lit(0), F.col("x1").cast("int")), F.least(F.lit(w - 1), F.col("x2").cast("int")))
    rows = boxes.where((F.col("x1") < w) & (F.col("y1") < h) & (F.col("x2") >= 0) & (F.col("y2") >= 0)).select("page_id", F.explode(ys).alias("y"), "x1", "x2")
    return rows.select("page_id", "y", F.explode(xs).alias("x")).distinct()
