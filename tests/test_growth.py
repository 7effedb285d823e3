"""Queries on pages whose tables grow: what is dealt out, and what is never broadcast or made twice."""

import json
from collections import Counter
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from layoutspark.config import Settings, Visual
from layoutspark.operators import pixels as px
from layoutspark.operators import planes
from layoutspark.operators import visuals as vi
from layoutspark.plans import catalog
from layoutspark.plans import pages as whole_pages
from layoutspark.sources import adapters as ad
from layoutspark.sources import files


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pixels_pass_by_the_boxes_they_are_measured_in(spark):
    part = spark.range(1, 41).withColumnRenamed("id", "p_partkey")
    boxes = part.select(F.col("p_partkey").alias("page_id"), F.lit(2).alias("x1"), F.lit(3).alias("y1"), F.lit(12).alias("x2"), F.lit(9).alias("y2"))
    boxes = boxes.union(spark.createDataFrame([(7, 0, 0, 3, 1), (99, 0, 0, 4, 4)], "page_id long, x1 int, y1 int, x2 int, y2 int"))
    found = px.mask_ratio(ad.pixels(part), boxes, F.col("p.v") > 128)
    value = lambda p, x, y: (p * 31 + x * 7 + y * 13) % 256
    expected = {}
    for p, x1, y1, x2, y2 in [(p, 2, 3, 12, 9) for p in range(1, 41)] + [(7, 0, 0, 3, 1)]:
        inside = [value(p, x, y) > 128 for x in range(x1, x2) for y in range(y1, y2)]
        expected[p, x1] = sum(inside) / len(inside)
    expected[99, 0] = 0.0
    assert {(r.page_id, r.x1): round(r.ratio, 9) for r in found.collect()} == {k: round(v, 9) for k, v in expected.items()}
    assert "Broadcast" not in plan(found)  # of 256 rows a part, taken for one
    assert plan(ad.pixels(part)).count("Exchange") == 1 and plan(ad.pixels(part).groupBy("page_id").count()).count("Exchange") == 1


def _suppliers(spark, folder, n):
    spark.range(1, n + 1).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_pages_of_one_small_file_are_dealt_out(spark, tmp_path):
    images = catalog._images(spark, _suppliers(spark, tmp_path, 2_100))
    assert images.rdd.getNumPartitions() == 2_100 // catalog.PAGES_A_TASK + 1
    assert images.select("page_id").distinct().count() == 2_100


def test_a_whole_page_is_looked_at_once(spark, tmp_path):
    images = catalog._images(spark, _suppliers(spark, tmp_path, 12))
    lines = spark.createDataFrame([(p, n, f"Line {n} of page {p}.", 0.9, 5, 90 + 9 * n, 60, 97 + 9 * n) for p in range(1, 7) for n in range(3)], files.LINE_SCHEMA)
    small = replace(Settings(), visual=Visual(min_visual_width_px=12, min_visual_height_px=12))
    found = whole_pages.process(spark, images, lines, small, 128)
    assert plan(found).count("text_boxes#") and sum("MapInArrow" in x and "text_boxes#" in x for x in plan(found).splitlines()) == 1
    rows = {r.page_id: json.loads(r.json) for r in found.collect()}
    facts = {r.page_id: r for r in vi.page_features(images, lines, small).collect()}
    boxes = Counter((r.page_id, r.x1, r.y1, r.x2, r.y2) for r in vi.visual_blocks(images, lines, small).collect() if r.source == "decision")
    assert rows.keys() == facts.keys() and boxes and Counter((p, b["x1"], b["y1"], b["x2"], b["y2"]) for p, r in rows.items() for b in r["visual_blocks"]) == boxes
    for p, r in rows.items():
        assert [b["block_no"] for b in r["visual_blocks"]] == list(range(1, len(r["visual_blocks"]) + 1)) and r["archetype"] == facts[p].archetype
        assert bool(r["text_blocks"]) == (p < 7)


def test_blurs_are_the_sums_over_the_kernel():
    r = np.random.default_rng(3)
    for h, w, sigma, size in ((5, 300, 2.0, 0), (140, 131, 15.0, 0), (1, 1, 3.0, 0), (260, 7, 8.0, 51)):
        plane = r.integers(0, 256, (h, w)).astype(float)
        k = planes.gaussian(sigma, size)
        wide = np.pad(plane, ((len(k) // 2,) * 2, (0, 0)), "reflect") if h > 1 else np.repeat(plane, len(k), 0)
        rows = sum(x * wide[i : i + h] for i, x in enumerate(k))
        wide = np.pad(rows, ((0, 0), (len(k) // 2,) * 2), "reflect") if w > 1 else np.repeat(rows, len(k), 1)
        assert np.allclose(planes.blurred(plane, sigma, size), sum(x * wide[:, i : i + w] for i, x in enumerate(k)), atol=1e-9)
