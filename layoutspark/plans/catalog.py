"""Queries over the driver's tables, each with its DuckDB oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Settings, Visual
from ..functions import correction, geometry
from ..functions import text as t
from ..functions.geometry import Box
from ..operators import boxes as bx
from ..operators import headlines as hl
from ..operators import pixels as px
from ..operators import reports
from ..operators import text_blocks as tb
from ..operators import visuals as vi
from ..sources import adapters as ad
from . import pages as whole_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BW, BH = ad.BOX_PAGE
LW, LH = ad.LINE_PAGE


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle.strip()
        return f

    return add


def _lines(spark, d):
    return ad.ocr_lines(ad.read(spark, d, "documents"))


def _cands(spark, d):
    return ad.candidates(ad.read(spark, d, "lineitem"))


def _pixels(spark, d):
    return ad.pixels(ad.read(spark, d, "part"))


_keys = ["page_id", "rk"]

# --- geometry ------------------------------------------------------------------------------------------


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, rk, greatest(0, least(x1 - 40, 999)) AS x1, greatest(0, least(y1 - 40, 999)) AS y1, greatest(greatest(0, least(x1 - 40, 999)) + 1, least(x2, 1000)) AS x2, greatest(greatest(0, least(y1 - 40, 999)) + 1, least(y2, 1000)) AS y2 FROM boxes")
def clip_boxes(spark, d):
    b = Box.of()
    return _cands(spark, d).select(*_keys, *Box(b.x1 - 40, b.y1 - 40, b.x2, b.y2).clip(1000, 1000).columns())


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, rk, " + ", ".join(f"round_even({c} / {s}.0::DOUBLE * 1000, 0)::BIGINT AS {c}" for c, s in (("x1", BW), ("y1", BH), ("x2", BW), ("y2", BH))) + " FROM boxes")
def normalize_bbox(spark, d):
    return _cands(spark, d).select(*_keys, *Box.of().per_mille(BW, BH).columns())


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n FROM boxes GROUP BY page_id")
def page_extent(spark, d):
    return _cands(spark, d).groupBy("page_id").agg(*geometry.union_of(), F.count(F.lit(1)).alias("n"))


_INTER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_AREA = "(({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1))"
_IOU = f"CASE WHEN {_INTER} = 0 THEN 0.0 ELSE ({_INTER}) / ({_AREA.format('a')} + {_AREA.format('b')} - ({_INTER}))::DOUBLE END"


@query(f"WITH {ad.BOXES_SQL}, p AS (SELECT a.page_id, a.rk AS rk_a, b.rk AS rk_b, {_IOU} AS iou FROM boxes a JOIN boxes b ON a.page_id = b.page_id AND a.rk < b.rk) SELECT * FROM p WHERE iou > 0.25")
def iou_pairs(spark, d):
    c = _cands(spark, d)
    overlap = Box.of("a").iou(Box.of("b"))
    joined = c.alias("a").join(c.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.rk") < F.col("b.rk")) & (overlap > 0.25))
    return joined.select(F.col("a.page_id").alias("page_id"), F.col("a.rk").alias("rk_a"), F.col("b.rk").alias("rk_b"), overlap.alias("iou"))


_WR, _HR = f"(greatest(1, x2 - x1) / {BW}.0::DOUBLE)", f"(greatest(1, y2 - y1) / {BH}.0::DOUBLE)"
_AR = f"((x2 - x1) * (y2 - y1) / {BW * BH}.0::DOUBLE)"


@query(
    f"""WITH {ad.BOXES_SQL} SELECT page_id, rk, (({_WR} >= 0.9 AND {_HR} <= 0.45) OR ({_HR} >= 0.9 AND {_WR} <= 0.45)) AND {_AR} >= 0.18 AS full_width, (({_WR} >= 0.92 AND {_HR} <= 0.42) OR ({_HR} >= 0.92 AND {_WR} <= 0.42)) AND {_AR} >= 0.15 AS band,
    ({_WR} > 0.9 AND {_HR} < 0.38) OR ({_HR} > 0.9 AND {_WR} < 0.38) AS strip, {_WR} >= 0.97 AND {_HR} >= 0.97 AS full_page, (x1 <= 2)::INT + (y1 <= 2)::INT + (x2 >= {BW - 2})::INT + (y2 >= {BH - 2})::INT AS touches,
    CASE WHEN (x1 + x2) / 2.0::DOUBLE <= {BW / 2} THEN 'left' ELSE 'right' END AS side, (x2 - x1) * (y2 - y1) / {BW / 2 * BH}::DOUBLE AS coverage FROM boxes"""
)
def box_shapes(spark, d):
    b = Box.of()
    return _cands(spark, d).select(*_keys, b.is_full_width_band(BW, BH).alias("full_width"), b.is_band_like(BW, BH).alias("band"), b.is_strip(BW, BH).alias("strip"), b.is_full_page(BW, BH).alias("full_page"), b.edge_touches(BW, BH).alias("touches"), b.side(BW).alias("side"), b.side_coverage(BW, BH).alias("coverage"))


@query(
    f"""WITH {ad.BOXES_SQL}, g AS (SELECT page_id, rk, r, c, x1 + c * ((x2 - x1) // 2) - 7 AS gx1, y1 + r * ((y2 - y1) // 2) - 7 AS gy1, CASE WHEN c = 0 THEN x1 + (x2 - x1) // 2 ELSE x2 END + 7 AS gx2,
    CASE WHEN r = 0 THEN y1 + (y2 - y1) // 2 ELSE y2 END + 7 AS gy2 FROM boxes, (SELECT unnest([0, 1]) AS r), (SELECT unnest([0, 1]) AS c)),
    k AS (SELECT *, greatest(0, least(gx1, {BW - 1})) AS x1, greatest(0, least(gy1, {BH - 1})) AS y1 FROM g) SELECT page_id, rk, r, c, x1, y1, greatest(x1 + 1, least(gx2, {BW})) AS x2, greatest(y1 + 1, least(gy2, {BH})) AS y2 FROM k"""
)
def grid_cells(spark, d):
    return _cands(spark, d).select(*_keys, F.explode(geometry.grid_cells(Box.of(), BW, BH)).alias("g")).select(*_keys, "g.r", "g.c", "g.box.*")


@query(
    f"""WITH {ad.BOXES_SQL}, p AS (SELECT *, greatest(6, round_even(least(x2 - x1, y2 - y1) * 0.01, 0)::BIGINT) AS pad FROM boxes), k AS (SELECT page_id, rk, greatest(0, least(x1 - pad, {BW - 1})) AS x1, greatest(0, least(y1 - pad, {BH - 1})) AS y1, x2 + pad AS ex, y2 + pad AS ey FROM p)
    SELECT page_id, rk, x1, y1, greatest(x1 + 1, least(ex, {BW})) AS x2, greatest(y1 + 1, least(ey, {BH})) AS y2 FROM k"""
)
def crop_boxes(spark, d):
    return _cands(spark, d).select(*_keys, *Box.of().padded(BW, BH, 0.01, 6).columns())


# --- filters, scores and selections ---------------------------------------------------------------------

_TOUCH = f"((x1 <= 2)::INT + (y1 <= 2)::INT + (x2 >= {BW - 2})::INT + (y2 >= {BH - 2})::INT)"
REASON_SQL = f"""CASE WHEN x2 - x1 < 48 OR y2 - y1 < 48 THEN 'too_small_abs' WHEN area_ratio < 0.0125 THEN 'too_small_ratio' WHEN area_ratio > 0.65 THEN 'too_large_ratio' WHEN short_side_ratio < 0.05 THEN 'too_thin_relative'
 WHEN aspect_ratio > 12 THEN 'too_long_strip' WHEN {_WR} >= 0.97 AND {_HR} >= 0.97 THEN 'full_page_like'
 WHEN (({_WR} > 0.9 AND {_HR} < 0.38) OR ({_HR} > 0.9 AND {_WR} < 0.38)) AND NOT (area_ratio >= 0.08 AND area_ratio <= 0.45 AND edge_density >= 0.008 AND entropy >= 3.4 AND fill_ratio >= 0.18) THEN 'too_canvas_strip'
 WHEN {_TOUCH} >= 3 AND area_ratio > 0.42 AND NOT (edge_density >= 0.01 AND entropy >= 3.3 AND area_ratio <= 0.35) THEN 'edge_touch_large'
 WHEN text_overlap_ratio > 0.22 AND NOT (area_ratio >= 0.012 AND edge_density >= 0.012 AND entropy >= 3.4) THEN 'text_heavy_region' WHEN edge_density < 0.006 THEN 'low_edge_density'
 WHEN area_ratio < 0.015 AND edge_density < 0.01 THEN 'small_low_edge' WHEN area_ratio < 0.015 AND entropy < 3 THEN 'small_low_entropy' WHEN fill_ratio < 0.09 THEN 'low_fill_ratio' WHEN entropy < 2 THEN 'low_entropy' ELSE 'ok' END"""
CLASS_SQL = f"""CASE WHEN area_ratio >= 0.45 THEN 'full_compositions' WHEN fill_ratio >= 0.43 AND area_ratio >= 0.02 AND area_ratio <= 0.2 AND aspect_ratio <= 2.2 THEN 'collage_cards'
 WHEN fill_ratio >= 0.35 AND aspect_ratio <= 4 AND text_overlap_ratio <= 0.6 THEN CASE WHEN text_overlap_ratio >= 0.1 AND {_WR} >= 0.22 AND {_HR} >= 0.12 THEN 'comic_panels' ELSE 'framed_rectangular' END
 WHEN edge_density >= 0.012 OR entropy >= 3.8 THEN 'freeform_illustrations' ELSE 'ambiguous_review' END"""
_STRIP = f"(({_WR} > 0.92 AND {_HR} < 0.33) OR ({_HR} > 0.92 AND {_WR} < 0.33))"
SIMPLE_SQL = f"""2.0::DOUBLE * least(1.0::DOUBLE, edge_density / 0.03::DOUBLE) + 1.8::DOUBLE * least(1.0::DOUBLE, entropy / 5.2::DOUBLE) + 0.9::DOUBLE * least(1.0::DOUBLE, fill_ratio / 0.45::DOUBLE) - 1.2::DOUBLE * least(1.0::DOUBLE, text_overlap_ratio / 0.55::DOUBLE)
 + CASE WHEN area_ratio >= 0.03 AND area_ratio <= 0.45 THEN 0.6::DOUBLE WHEN area_ratio > 0.62 THEN -1.5::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {_STRIP} THEN -1.2::DOUBLE ELSE 0.0::DOUBLE END"""
DECISIONS_SQL = f"""kept AS (SELECT *, {CLASS_SQL} AS base FROM boxes WHERE {REASON_SQL} = 'ok'),
 rev AS (SELECT *, list_filter([CASE WHEN base <> 'full_compositions' AND (x1 <= 1 OR y1 <= 1 OR x2 >= {BW - 1} OR y2 >= {BH - 1}) THEN 'touches_page_edge' END, CASE WHEN text_overlap_ratio > 0.6 AND edge_density < 0.02 THEN 'text_heavy' END,
  CASE WHEN area_ratio < 0.01 AND entropy < 3.2 THEN 'tiny_or_weak' END], lambda r: r IS NOT NULL) AS reasons FROM kept),
 dec AS (SELECT *, len(reasons) > 0 AS needs_review, CASE WHEN len(reasons) > 0 THEN 'ambiguous_review' ELSE base END AS visual_class,
  2.0::DOUBLE * least(1.0::DOUBLE, edge_density / 0.03::DOUBLE) + 1.8::DOUBLE * least(1.0::DOUBLE, entropy / 5.2::DOUBLE) + 0.7::DOUBLE * least(1.0::DOUBLE, fill_ratio / 0.45::DOUBLE) - 1.6::DOUBLE * least(1.0::DOUBLE, text_overlap_ratio / 0.55::DOUBLE)
  + CASE WHEN area_ratio > 0.72 THEN -2.4::DOUBLE WHEN area_ratio > 0.55 THEN -1.3::DOUBLE WHEN area_ratio >= 0.02 AND area_ratio <= 0.5 THEN 0.55::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {_STRIP} THEN -1.8::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN len(reasons) > 0 THEN -0.6::DOUBLE ELSE 0.0::DOUBLE END AS quality FROM rev)"""


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, rk, {REASON_SQL} AS reason FROM boxes")
def keep_reason(spark, d):
    return _cands(spark, d).select(*_keys, bx.keep_reason(BW, BH).alias("reason"))


@query(f"WITH {ad.BOXES_SQL} SELECT reason, count(*) AS n, max(area_ratio) AS area FROM (SELECT *, {REASON_SQL} AS reason FROM boxes) GROUP BY reason")
def reject_report(spark, d):
    return _cands(spark, d).withColumn("reason", bx.keep_reason(BW, BH)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.max("area_ratio").alias("area"))


@query(
    f"""WITH {ad.BOXES_SQL}, s AS (SELECT *, {REASON_SQL} AS base FROM boxes) SELECT page_id, rk, CASE WHEN base <> 'ok' THEN base WHEN {_WR} >= 0.97 AND {_HR} >= 0.97 THEN 'full_page_like_simple'
    WHEN ({_WR} > 0.9 AND {_HR} < 0.38) OR ({_HR} > 0.9 AND {_WR} < 0.38) THEN 'strip_like_simple' WHEN area_ratio > 0.7 THEN 'too_large_simple' WHEN fill_ratio / 2 < 0.1 THEN 'low_non_text_fill'
    WHEN text_overlap_ratio > 0.42 AND edge_density < 0.012 THEN 'text_overlap_simple' ELSE 'ok' END AS reason, {SIMPLE_SQL} AS score FROM s"""
)
def simple_mode(spark, d):
    return _cands(spark, d).select(*_keys, bx.simple_reason(BW, BH, F.col("fill_ratio") / 2).alias("reason"), bx.simple_score(BW, BH).alias("score"))


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, rk, {CLASS_SQL} AS visual_class FROM boxes")
def classify_visual(spark, d):
    return _cands(spark, d).select(*_keys, bx.visual_class(BW, BH).alias("visual_class"))


@query(f"WITH {ad.BOXES_SQL}, {DECISIONS_SQL} SELECT page_id, rk, visual_class, needs_review, array_to_string(reasons, ',') AS reasons, quality FROM dec")
def visual_decisions(spark, d):
    return bx.decisions(_cands(spark, d), BW, BH).select(*_keys, "visual_class", "needs_review", F.array_join("review_reasons", ",").alias("reasons"), "quality")


_ARCHETYPES = ("full_photo_page", "collage_card_page", "comic_panel_page", "text_heavy_editorial_page", "mixed_page")


@query(
    f"""WITH {ad.BOXES_SQL}, {DECISIONS_SQL}, a AS (SELECT *, [{', '.join(f"'{x}'" for x in _ARCHETYPES)}][page_id % 5 + 1] AS archetype FROM dec),
    f AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY quality DESC, rk) AS place FROM a WHERE area_ratio >= CASE archetype WHEN 'full_photo_page' THEN 0.04 WHEN 'collage_card_page' THEN 0.02 WHEN 'text_heavy_editorial_page' THEN 0.03 ELSE 0 END)
    SELECT page_id, rk, archetype, place FROM f WHERE place <= CASE archetype WHEN 'full_photo_page' THEN 3 WHEN 'collage_card_page' THEN 6 WHEN 'comic_panel_page' THEN 8 WHEN 'text_heavy_editorial_page' THEN 3 ELSE 1000000 END"""
)
def decision_score_topk(spark, d):
    archetype = F.element_at(F.array(*[F.lit(x) for x in _ARCHETYPES]), (F.col("page_id") % 5 + 1).cast("int"))
    return bx.route(bx.decisions(_cands(spark, d), BW, BH), archetype).select(*_keys, "archetype", "place")


@query(f"WITH {ad.BOXES_SQL} SELECT page_id, rk FROM boxes a WHERE NOT EXISTS (SELECT 1 FROM boxes b WHERE a.page_id = b.page_id AND a.rk <> b.rk AND ({_INTER}) / greatest(1, {_AREA.format('a')})::DOUBLE >= 0.92 AND {_AREA.format('b')} >= {_AREA.format('a')})")
def contained_anti(spark, d):
    return bx.drop_contained(_cands(spark, d)).select(*_keys)


_NEXT_INTER = "greatest(0, least(k.x2, l[i + 1].x2) - greatest(k.x1, l[i + 1].x1)) * greatest(0, least(k.y2, l[i + 1].y2) - greatest(k.y1, l[i + 1].y1))"
_NEXT_IOU = f"(CASE WHEN ({_NEXT_INTER}) = 0 THEN 0.0::DOUBLE ELSE ({_NEXT_INTER}) / ({_AREA.format('k')} + {_AREA.format('l[i + 1]')} - ({_NEXT_INTER}))::DOUBLE END)"


def _nms_sql(source: str, order: str, threshold: float, most: int | None = None, columns: tuple[str, ...] = (), clash: str = "", stop: str = "", name: str = "nms") -> str:
    """Greedy suppression as a recursion over each page's ordered list; clash(k, l[i + 1]) may replace the overlap rule, stop skips a box besides."""
    clash = clash or f"{_NEXT_IOU} > {threshold}"
    stop = stop or (f"len(kept) >= {most}" if most else "FALSE")
    fields = ", ".join(f"'{c}': {c}" for c in ("rk", "x1", "y1", "x2", "y2", *columns))
    return f"""{name}_ord AS (SELECT page_id, list({{{fields}}} ORDER BY {order}) AS l FROM {source} GROUP BY page_id),
 {name}_g AS (SELECT page_id, 0::BIGINT AS i, l, l[1:0] AS kept FROM {name}_ord UNION ALL SELECT page_id, i + 1, l, CASE WHEN len(list_filter(kept, lambda k: {clash})) > 0 OR {stop} THEN kept ELSE list_append(kept, l[i + 1]) END FROM {name}_g WHERE i < len(l)),
 {name} AS (SELECT page_id, u.rk AS rk FROM (SELECT page_id, unnest(kept) AS u FROM {name}_g WHERE i = len(l)))"""


@query(f"WITH RECURSIVE {ad.BOXES_SQL}, {_nms_sql('boxes', 'rk', 0.25)} SELECT page_id, rk FROM nms")
def greedy_nms(spark, d):
    return bx.greedy(_cands(spark, d).select("page_id", "rk", "x1", "y1", "x2", "y2"), [F.col("rk")], 0.25).select(*_keys)


_FIT = f"{_AR} >= 0.05 AND NOT ((({_WR} >= 0.92 AND {_HR} <= 0.42) OR ({_HR} >= 0.92 AND {_WR} <= 0.42)) AND {_AR} >= 0.15)"


@query(
    f"""WITH RECURSIVE {ad.BOXES_SQL}, fit AS (SELECT *, {_AR} + CASE WHEN {_WR} BETWEEN 0.18 AND 0.82 AND {_HR} BETWEEN 0.18 AND 0.95 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS ps FROM boxes WHERE {_FIT}), {_nms_sql('fit', 'ps DESC, rk', 0.7, 2)},
    typed AS (SELECT n.page_id, n.rk, x1, y1, x2, y2, ['comic_panel_page', 'puzzle_page', 'framed_photo_page', 'mixed_page'][n.page_id % 4 + 1] AS pt FROM nms n JOIN fit f ON n.page_id = f.page_id AND n.rk = f.rk)
    SELECT page_id, rk, CASE pt WHEN 'comic_panel_page' THEN 'comic_panel_page' WHEN 'puzzle_page' THEN 'puzzle_page' WHEN 'framed_photo_page' THEN 'framed_photo' ELSE CASE WHEN {_AR} >= 0.45 THEN 'background_photo_page' WHEN {_AR} >= 0.12 THEN 'framed_photo' ELSE 'corner_illustration' END END AS visual_class,
    row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, x2, y2, rk) AS panel_index FROM typed"""
)
def layout_plans(spark, d):
    types = F.element_at(F.array(*[F.lit(x) for x in ("comic_panel_page", "puzzle_page", "framed_photo_page", "mixed_page")]), (F.col("page_id") % 4 + 1).cast("int"))
    return bx.plans(bx.rank_boxes(_cands(spark, d), BW, BH), BW, BH, types, F.lit(0.7)).select(*_keys, "visual_class", F.col("panel_index").cast("long"))


_PW, _PH = 2000, 1400
_PWR, _PHR, _PAR = (x.replace(f"{BW}.0", f"{_PW}.0").replace(f"{BH}.0", f"{_PH}.0").replace(f"{BW * BH}.0", f"{_PW * _PH}.0") for x in (_WR, _HR, _AR))


@query(
    f"""WITH RECURSIVE {ad.BOXES_SQL}, fit AS (SELECT *, (x2 - x1) * (y2 - y1) AS area, (x1 + x2) / 2.0::DOUBLE > {_PW / 2} AS r, (y1 + y2) / 2.0::DOUBLE > {_PH / 2} AS w FROM boxes WHERE {_PAR} >= 0.045 AND NOT ((({_PWR} >= 0.92 AND {_PHR} <= 0.42) OR ({_PHR} >= 0.92 AND {_PWR} <= 0.42)) AND {_PAR} >= 0.15)),
    rn AS (SELECT *, row_number() OVER (PARTITION BY page_id, r ORDER BY area DESC, rk) AS h, row_number() OVER (PARTITION BY page_id, r, w ORDER BY area DESC, rk) AS q FROM fit), tiers AS (SELECT *, CASE WHEN h = 1 THEN r::INT WHEN q = 1 THEN 2 ELSE 3 END AS tier FROM rn),
    {_nms_sql('tiers', 'tier, area DESC, rk', 0.68, 4, ('tier',), clash=f"CASE WHEN l[i + 1].tier = 1 THEN {_NEXT_IOU} >= 0.7 ELSE {_NEXT_IOU} > 0.68 END")} SELECT n.page_id, n.rk, tier FROM nms n JOIN tiers t ON n.page_id = t.page_id AND n.rk = t.rk"""
)
def puzzle_boxes(spark, d):
    return bx.select_puzzle_boxes(_cands(spark, d), _PW, _PH).select(*_keys, "tier")


_BAND84 = f"(({_WR} >= 0.84 AND {_HR} <= 0.3) OR ({_HR} >= 0.84 AND {_WR} <= 0.3))"
_PLAN = f"1.6::DOUBLE * edge_density + 0.9::DOUBLE * least(1.0::DOUBLE, greatest(0.0::DOUBLE, (entropy - 2.0::DOUBLE) / 4.0::DOUBLE)) + 0.9::DOUBLE * (1.0::DOUBLE - text_overlap_ratio) - CASE WHEN {_BAND84} THEN 0.45::DOUBLE ELSE 0.0::DOUBLE END"


@query(
    f"""WITH RECURSIVE {ad.BOXES_SQL}, fit AS (SELECT *, {_AR} + CASE WHEN {_WR} BETWEEN 0.18 AND 0.82 AND {_HR} BETWEEN 0.18 AND 0.95 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS ps FROM boxes WHERE {_FIT}), {_nms_sql('fit', 'ps DESC, rk', 0.7, 4, name='top')},
    pl AS (SELECT f.*, CASE WHEN {_AR} >= 0.45 THEN 'background_photo_page' WHEN {_AR} >= 0.12 THEN 'framed_photo' ELSE 'corner_illustration' END AS visual_class, {_PLAN} AS plan_score FROM top n JOIN fit f ON n.page_id = f.page_id AND n.rk = f.rk),
    rj AS (SELECT *, visual_class <> 'background_photo_page' AND (({_BAND84} AND text_overlap_ratio >= 0.26) OR (text_overlap_ratio >= 0.58 AND edge_density < 0.018 AND entropy < 3.1) OR (plan_score < 0.44 AND text_overlap_ratio >= 0.34)) AS rejected FROM pl),
    {_nms_sql('rj', 'rejected, plan_score DESC, rk', 0.72, columns=('rejected',), stop='(l[i + 1].rejected AND len(kept) >= 1)', name='fin')}
    SELECT r.page_id, r.rk, visual_class, plan_score, rejected, plan_score < 0.52 OR text_overlap_ratio > 0.42 AS needs_review, row_number() OVER (PARTITION BY r.page_id ORDER BY y1, x1, r.rk) AS panel_index FROM fin n JOIN rj r ON n.page_id = r.page_id AND n.rk = r.rk"""
)
def refined_plans(spark, d):
    planned = bx.plans(bx.rank_boxes(_cands(spark, d), BW, BH, 4), BW, BH, F.lit("mixed_page"), F.lit(0.5))
    return bx.refine(planned, BW, BH, F.lit("mixed_page")).select(*_keys, "visual_class", "plan_score", "rejected", "needs_review", F.col("panel_index").cast("long").alias("panel_index"))


@query(
    f"""WITH RECURSIVE {ad.BOXES_SQL}, {DECISIONS_SQL}, {_nms_sql('dec', 'quality DESC, rk', 0.72)}, sel AS (SELECT d.*, count(*) OVER w AS n, sum((area_ratio <= 0.08)::INT) OVER w AS small, sum(area_ratio) OVER w AS covered, row_number() OVER (PARTITION BY d.page_id ORDER BY quality DESC, d.rk) AS place FROM nms k JOIN dec d ON k.page_id = d.page_id AND k.rk = d.rk WINDOW w AS (PARTITION BY d.page_id)),
    alt AS (SELECT b.page_id, b.rk, b.visual_class, b.quality FROM dec b JOIN sel a ON a.page_id = b.page_id AND a.rk <> b.rk WHERE a.n = 1 AND a.area_ratio > 0.7 AND b.area_ratio >= 0.05 AND {_IOU} < 0.55 QUALIFY row_number() OVER (PARTITION BY b.page_id ORDER BY b.quality DESC, b.rk) <= 2)
    SELECT page_id, rk, visual_class, quality FROM sel WHERE NOT (n > 5 AND small >= 4 AND covered <= 0.7) OR place <= 5 UNION ALL SELECT * FROM alt"""
)
def selected_decisions(spark, d):
    return bx.select_set(bx.decisions(_cands(spark, d), BW, BH)).select(*_keys, "visual_class", "quality")


_SW, _SH = 900, 1300  # so small a page that its boxes are large enough


@query(
    f"""WITH {ad.BOXES_SQL}, f AS (SELECT *, (x1 + x2) / 2.0::DOUBLE AS cx FROM boxes WHERE (x2 - x1) * (y2 - y1) / {_SW * _SH}.0::DOUBLE BETWEEN 0.08 AND 0.34), p AS (SELECT a.page_id, a.rk AS rk_a, b.rk AS rk_b, CASE WHEN a.cx <= {_SW / 2} THEN 'left' ELSE 'right' END AS side,
    greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) / least(a.x2 - a.x1, b.x2 - b.x1)::DOUBLE AS xo, abs(a.y1 - b.y1) / {_SH}.0::DOUBLE AS dy, abs(a.cx - b.cx) / {_SW}.0::DOUBLE AS dx, ({_AREA.format('a')} + {_AREA.format('b')}) / {_SW * _SH}.0::DOUBLE AS total, {_IOU} AS iou
    FROM f a JOIN f b ON a.page_id = b.page_id AND a.rk < b.rk AND (a.cx <= {_SW / 2}) = (b.cx <= {_SW / 2})), s AS (SELECT *, xo * 1.5::DOUBLE + least(1.0::DOUBLE, dy / 0.45::DOUBLE) + total AS pair_score FROM p WHERE iou <= 0.22 AND dy >= 0.16 AND (xo >= 0.42 OR dx <= 0.12) AND total >= 0.22)
    SELECT page_id, side, rk_a, rk_b, pair_score FROM s QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pair_score DESC, rk_a, rk_b) = 1"""
)
def stacked_pairs(spark, d):
    return bx.stacked_pairs(_cands(spark, d), _SW, _SH)


@query()
def merged_overlaps(spark, d):
    return bx.merge_overlaps(_cands(spark, d))


@query()
def merged_panels(spark, d):
    return bx.merge_panels(_cands(spark, d))


@query()
def merged_fragments(spark, d):
    return bx.merge_fragments(_cands(spark, d), BW, BH)


@query()
def merged_parents(spark, d):
    return bx.merge_parents(_cands(spark, d), BW, BH)


_FEATURES = "(p_partkey % 50) / 100.0::DOUBLE AS tr, (p_partkey * 7 % 90) / 100.0::DOUBLE AS nt, (p_partkey * 3 % 40) / 1000.0::DOUBLE AS ed, p_partkey * 11 % 12 AS n"


def _features(spark, d):
    i = F.col("p_partkey").cast("long")
    return ad.read(spark, d, "part").select(i.alias("page_id"), (i % 50 / 100.0).alias("tr"), (i * 7 % 90 / 100.0).alias("nt"), (i * 3 % 40 / 1000.0).alias("ed"), (i * 11 % 12).alias("n"))


@query(f"WITH f AS (SELECT p_partkey AS page_id, {_FEATURES} FROM part) SELECT page_id, CASE WHEN tr <= 0.14 AND ed >= 0.02 AND nt >= 0.5 THEN 'full_photo_page' WHEN tr >= 0.4 AND nt <= 0.45 THEN 'text_heavy_editorial_page' WHEN n >= 7 AND tr BETWEEN 0.12 AND 0.38 THEN 'collage_card_page' WHEN n BETWEEN 3 AND 8 AND tr BETWEEN 0.12 AND 0.35 THEN 'comic_panel_page' ELSE 'mixed_page' END AS archetype FROM f")
def page_archetype(spark, d):
    return _features(spark, d).select("page_id", bx.page_archetype(F.col("tr"), F.col("nt"), F.col("ed"), F.col("n")).alias("archetype"))


@query(
    f"""WITH f AS (SELECT p_partkey AS page_id, {_FEATURES}, (p_partkey % 4) AS rc, (p_partkey * 5 % 80) / 10.0::DOUBLE AS gs, p_partkey % 3 AS kw, p_partkey % 20 AS nl FROM part)
    SELECT page_id, CASE WHEN nt >= 0.72 AND tr <= 0.32 AND rc <= 2 AND ed >= 0.02 THEN 'background_photo_page' WHEN (gs >= 5.4 OR kw >= 2) AND tr >= 0.08 THEN 'puzzle_page' WHEN rc >= 3 AND nl >= 12 THEN 'comic_panel_page' WHEN rc >= 2 AND tr >= 0.12 THEN 'activity_page'
    WHEN rc >= 1 AND tr <= 0.2 THEN 'framed_photo_page' ELSE 'mixed_page' END AS page_type, CASE WHEN nt >= 0.72 AND tr <= 0.32 AND rc <= 2 AND ed >= 0.02 THEN 0.8 WHEN (gs >= 5.4 OR kw >= 2) AND tr >= 0.08 THEN CASE WHEN kw >= 2 THEN 0.82 ELSE 0.74 END WHEN rc >= 3 AND nl >= 12 THEN 0.72
    WHEN rc >= 2 AND tr >= 0.12 THEN 0.66 WHEN rc >= 1 AND tr <= 0.2 THEN 0.62 ELSE 0.5 END::DOUBLE AS confidence FROM f"""
)
def page_layout(spark, d):
    f = _features(spark, d)
    i = F.col("page_id")
    return f.select("page_id", bx.page_layout(F.col("tr"), F.col("nt"), F.col("ed"), i % 4, i * 5 % 80 / 10.0, i % 20, i % 3).alias("l")).select("page_id", "l.page_type", F.col("l.confidence").cast("double").alias("confidence"))


# --- lines and blocks -------------------------------------------------------------------------------------

_MED = "med AS (SELECT page_id, greatest(1.0, median(y2 - y1))::DOUBLE AS m FROM lines GROUP BY page_id)"
_PAIRS = """pr AS (SELECT a.page_id, a.line_no AS i, b.line_no AS j FROM lines a JOIN lines b ON a.page_id = b.page_id AND a.line_no < b.line_no JOIN med ON med.page_id = a.page_id
 WHERE greatest(a.y2 - a.y1, b.y2 - b.y1) / greatest(1.0, least(a.y2 - a.y1, b.y2 - b.y1))::DOUBLE <= 1.9 AND greatest(0, b.y1 - a.y2, a.y1 - b.y2) / m <= 1.6
 AND (greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) / greatest(1, least(a.x2 - a.x1, b.x2 - b.x1))::DOUBLE >= 0.08 OR abs(a.x1 - b.x1) / m <= 1.8 OR abs((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE) / m <= 1.8)
 AND abs((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE) / m <= 7)"""
_ROOTS = """bo AS (SELECT page_id, i, j FROM pr UNION ALL SELECT page_id, j, i FROM pr), reach AS (SELECT page_id, line_no AS a, line_no AS b FROM lines UNION SELECT r.page_id, r.a, e.j FROM reach r JOIN bo e ON e.page_id = r.page_id AND e.i = r.b),
 roots AS (SELECT page_id, a AS line_no, min(b) AS root FROM reach GROUP BY page_id, a)"""


@query(f"WITH RECURSIVE {ad.LINES_SQL}, {_MED}, {_PAIRS}, {_ROOTS} SELECT page_id, line_no, root FROM roots")
def line_components(spark, d):
    return tb.line_components(_lines(spark, d)).select("page_id", "line_no", "root")


@query(
    f"""WITH RECURSIVE {ad.LINES_SQL}, {_MED}, {_PAIRS}, {_ROOTS} SELECT l.page_id, root, count(*) AS line_count, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, string_agg(text, ' ' ORDER BY y1, x1, l.line_no) AS text
    FROM lines l JOIN roots r ON l.page_id = r.page_id AND l.line_no = r.line_no GROUP BY l.page_id, root"""
)
def text_blocks(spark, d):
    return tb.blocks_of(tb.line_components(_lines(spark, d)), clean=False).select("page_id", "root", "line_count", "x1", "y1", "x2", "y2", "text")


@query()
def grouped_blocks(spark, d):
    return tb.text_blocks(_lines(spark, d)).select("page_id", "block_no", "root", "line_count", "x1", "y1", "x2", "y2", "text")


@query()
def column_order(spark, d):
    return tb.column_order(tb.line_components(_lines(spark, d))).select("page_id", "root", "line_no", "column_no", "order_no")


@query(f"WITH {ad.LINES_SQL} SELECT page_id, line_no, greatest(0, lead(y1) OVER (PARTITION BY page_id ORDER BY y1, x1, line_no) - y2) AS gap FROM lines WHERE TRUE QUALIFY lead(y1) OVER (PARTITION BY page_id ORDER BY y1, x1, line_no) IS NOT NULL")
def line_gaps(spark, d):
    last = F.lead("y1").over(tb.by_page().orderBy("y1", "x1", "line_no")).isNull()
    return tb.line_gaps(_lines(spark, d)).withColumn("last", last).where("not last").select("page_id", "line_no", "gap")


@query(
    f"""WITH {ad.LINES_SQL}, e AS (SELECT *, min(x1) OVER w AS a, max(x2) OVER w AS b, min(y1) OVER w AS c, max(y2) OVER w AS f FROM lines WINDOW w AS (PARTITION BY page_id)),
    s AS (SELECT *, CASE WHEN greatest(1, b - a) / greatest(1, f - c)::DOUBLE >= 1.35 AND (x1 + x2) / 2.0::DOUBLE > (a + b) / 2.0::DOUBLE THEN 1 ELSE 0 END AS side FROM e),
    m AS (SELECT *, least(120.0::DOUBLE, greatest(24.0::DOUBLE, 0.9::DOUBLE * median(y2 - y1) OVER (PARTITION BY page_id, side))) AS band FROM s),
    k AS (SELECT *, round_even((y1 - fmod(y1::DOUBLE, band)) / band, 0)::INTEGER AS rkey FROM m) SELECT page_id, line_no, side, row_number() OVER (PARTITION BY page_id ORDER BY side, rkey, x1, y1, x2, line_no) AS read_no FROM k"""
)
def reading_order(spark, d):
    return tb.reading_order(_lines(spark, d), "line_no").select("page_id", "line_no", "side", "read_no")


@query(
    f"""WITH {ad.LINES_SQL}, e AS (SELECT *, min(x1) OVER w AS a, max(x2) OVER w AS b, min(y1) OVER w AS c, max(y2) OVER w AS f, greatest(26.0::DOUBLE, 1.45::DOUBLE * median(y2 - y1) OVER w) AS far FROM lines WINDOW w AS (PARTITION BY page_id)),
    s AS (SELECT *, CASE WHEN greatest(1, b - a) / greatest(1, f - c)::DOUBLE >= 1.35 AND (x1 + x2) / 2.0::DOUBLE > (a + b) / 2.0::DOUBLE THEN 1 ELSE 0 END AS side FROM e),
    n AS (SELECT *, CASE WHEN lag(side) OVER o IS NULL OR side <> lag(side) OVER o OR y1 - lag(y2) OVER o > far THEN 1 ELSE 0 END AS fresh FROM s WINDOW o AS (PARTITION BY page_id ORDER BY side, y1, x1, line_no)),
    c AS (SELECT *, sum(fresh) OVER (PARTITION BY page_id ORDER BY side, y1, x1, line_no ROWS UNBOUNDED PRECEDING)::BIGINT AS chunk_no FROM n)
    SELECT page_id, chunk_no, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n_blocks, string_agg(text, ' ' ORDER BY side, y1, x1, line_no) AS text FROM c GROUP BY page_id, chunk_no"""
)
def gap_sessions(spark, d):
    return tb.gap_sessions(_lines(spark, d), "line_no")


@query(f"WITH {ad.LINES_SQL} SELECT page_id, count(*) AS n_lines, sum(round(confidence * 100))::BIGINT AS conf, count(*) < 8 OR sum(round(confidence * 100)) / (100.0 * count(*)) < 0.62 AS second_pass FROM lines WHERE confidence >= 0.45 GROUP BY page_id")
def ocr_conf_gate(spark, d):
    lines = tb.confident(_lines(spark, d))
    return tb.needs_second_pass(lines).join(lines.groupBy("page_id").agg(F.sum(F.round(F.col("confidence") * 100)).cast("long").alias("conf")), "page_id").select("page_id", "n_lines", "conf", "second_pass")


@query()
def merge_line_sets(spark, d):
    lines = _lines(spark, d)
    second = lines.where("line_no % 3 <> 1").select("page_id", F.col("line_no") * 1, "text", ((F.col("confidence") * 100 + F.col("line_no") * 17) % 100 / 100).alias("confidence"), *[(F.col(c) + F.when(F.col("line_no") % 4 == 0, 300).otherwise(1)).alias(c) for c in ("x1", "y1", "x2", "y2")]).toDF(*lines.columns)
    return tb.merge_line_sets(lines, second)


def _blocks(spark, d):
    """Blocks with their prefix headlines split off, numbered from the top, with roles and an id per page."""
    lines = tb.grouped(_lines(spark, d))
    split = tb.split_prefix(lines).withColumn("root", F.col("root") * 2 + F.col("part"))
    blocks = tb.blocks_of(split).withColumn("seq", F.row_number().over(tb.by_page().orderBy("y1", "x1", "root")).cast("long"))
    median = lines.groupBy("page_id").agg(F.median((F.col("y2") - F.col("y1")).cast("double")).alias("page_median_h"))
    return tb.roles(blocks, median, "seq")


@query(
    f"""WITH {ad.LINES_SQL}, n AS (SELECT *, 0 AS root, row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, line_no) AS rn, greatest(0, lead(y1) OVER (PARTITION BY page_id ORDER BY y1, x1, line_no) - y2)::DOUBLE AS gap FROM lines),
    s AS (SELECT page_id, count(*) AS n, max(y2 - y1) FILTER (rn = 1) AS h1, max(x2 - x1) FILTER (rn = 1) AS w1, max(gap) FILTER (rn = 1) AS g1, median(y2 - y1) FILTER (rn > 1) AS hr, median(x2 - x1) FILTER (rn > 1) AS wr, coalesce(median(gap) FILTER (rn > 1), max(gap) FILTER (rn = 1)) AS gr FROM n GROUP BY page_id)
    SELECT n.page_id, line_no, CASE WHEN rn = 1 AND s.n >= 4 AND h1 >= hr * 1.16::DOUBLE AND (g1 >= gr * 1.6::DOUBLE OR g1 >= hr * 0.8::DOUBLE OR w1 <= wr * 0.9::DOUBLE) THEN 0 ELSE 1 END AS part FROM n JOIN s USING (page_id)"""
)
def prefix_split(spark, d):
    from ..config import Classification

    never = Classification(prefix_title_pattern_max_chars=-1)  # title patterns are oracle-checked on their own
    return tb.split_prefix(_lines(spark, d).withColumn("root", F.lit(0).cast("long")), never).select("page_id", "line_no", "part")


@query()
def block_roles(spark, d):
    return _blocks(spark, d).select("page_id", "seq", "line_count", "role", "x1", "y1", "x2", "y2", "text")


def _roled(spark, d):
    """Lines as blocks, every fourth one a headline and every seventh other text."""
    role = F.when(F.col("line_no") % 4 == 0, "headline").when(F.col("line_no") % 7 == 5, "other_text").otherwise("content")
    return _lines(spark, d).withColumn("role", role).withColumnRenamed("line_no", "seq")


_ROLED = "roled AS (SELECT *, CASE WHEN line_no % 4 = 0 THEN 'headline' WHEN line_no % 7 = 5 THEN 'other_text' ELSE 'content' END AS role FROM lines)"
_HB = f"""hb AS (SELECT a.page_id, a.line_no AS headline, b.line_no AS content, a.y1 AS hy, a.x1 AS hx, CASE WHEN greatest(0, b.y1 - a.y2) > {LH * 0.5} THEN -1e9 ELSE greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) / greatest(1, least(a.x2 - a.x1, b.x2 - b.x1))::DOUBLE * 2.0::DOUBLE
 - abs((a.x1 + a.x2) / 2.0::DOUBLE - (b.x1 + b.x2) / 2.0::DOUBLE) / {LH}.0::DOUBLE - greatest(0, b.y1 - a.y2) / {LH}.0::DOUBLE END AS score FROM roled a JOIN roled b ON a.page_id = b.page_id AND a.role = 'headline' AND b.role = 'content' AND b.y1 >= a.y1 AND b.y1 - a.y2 <= {LH * 0.35})"""


@query(f"WITH {ad.LINES_SQL}, {_ROLED}, {_HB} SELECT page_id, headline, content, score FROM hb QUALIFY row_number() OVER (PARTITION BY page_id, headline ORDER BY score DESC, content) = 1")
def headline_best_content(spark, d):
    return tb.headline_best(_roled(spark, d), F.lit(float(LH)), "seq")


@query(
    f"""WITH RECURSIVE {ad.LINES_SQL}, {_ROLED}, {_HB}, hl AS (SELECT page_id, list({{'headline': headline, 'content': content}} ORDER BY hy, hx, headline, score DESC, content) AS l FROM hb WHERE score >= -0.15 GROUP BY page_id),
    gr AS (SELECT page_id, 0::BIGINT AS i, l, l[1:0] AS kept FROM hl UNION ALL SELECT page_id, i + 1, l, CASE WHEN len(list_filter(kept, lambda k: k.headline = l[i + 1].headline OR k.content = l[i + 1].content)) > 0 THEN kept ELSE list_append(kept, l[i + 1]) END FROM gr WHERE i < len(l)),
    ch AS (SELECT page_id, unnest(kept) AS u FROM gr WHERE i = len(l)), led AS (SELECT page_id, u.headline AS lead, unnest([u.headline, u.content]) AS seq FROM ch),
    ky AS (SELECT r.page_id, r.line_no AS seq, role, coalesce(lead, r.line_no) AS g, (lead IS NULL)::INT AS late, h.y1 AS hy, h.x1 AS hx FROM roled r LEFT JOIN led ON led.page_id = r.page_id AND led.seq = r.line_no JOIN lines h ON h.page_id = r.page_id AND h.line_no = coalesce(lead, r.line_no))
    SELECT page_id, seq, role, dense_rank() OVER (PARTITION BY page_id ORDER BY late, hy, hx, g) AS article_no FROM ky"""
)
def article_groups(spark, d):
    return tb.article_groups(_roled(spark, d), F.lit(float(LH)), "seq").select("page_id", "seq", "role", F.col("article_no").cast("long").alias("article_no"))


@query()
def roled_logical_blocks(spark, d):
    grouped = tb.article_groups(_roled(spark, d), F.lit(float(LH)), "seq")
    return tb.compose(grouped.select("page_id", "seq", "role", "x1", "y1", "x2", "y2", "text", F.col("article_no").cast("long").alias("article_no")), "seq")


@query()
def logical_blocks(spark, d):
    grouped = tb.article_groups(_blocks(spark, d), F.lit(float(LH)), "seq")
    clean = tb.without_repeats(grouped, "seq")
    return tb.compose(clean.select("page_id", "seq", "role", "x1", "y1", "x2", "y2", "text", F.col("article_no").cast("long").alias("article_no")), "seq")


# --- text -----------------------------------------------------------------------------------------------------


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\\s\\p{Z}]+', ' ', 'g')) AS text FROM pages")
def clean_whitespace(spark, d):
    return ad.read(spark, d, "pages").select("page_id", t.untagged(F.col("html")).alias("text"))


@query()
def clean_full(spark, d):
    return ad.read(spark, d, "pages").select("page_id", t.clean_ocr(F.col("html")).alias("text"))


_LOW = "[A-Za-zÇĞİÖŞÜçğıöşü]"


@query(
    f"""WITH {ad.LINES_SQL}, s AS (SELECT page_id, line_no, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM lines), w AS (SELECT *, len(string_split(s, ' ')) AS n FROM s)
    SELECT page_id, line_no, s <> '' AND n BETWEEN 2 AND 10 AND NOT (suffix(s, '.') OR suffix(s, '!') OR suffix(s, '?')) AND NOT (contains(s, ':') AND n <= 4) AND (contains(s, '/') OR len(regexp_extract_all(s, '[,:;]')) <= 1) AS headline,
    len(regexp_extract_all(s, '{_LOW}')) AS letters, len(regexp_extract_all(s, '[0-9]')) AS digits FROM w"""
)
def title_pattern(spark, d):
    return _lines(spark, d).select("page_id", "line_no", t.is_headline_pattern(F.col("text")).alias("headline"), t.letters(F.col("text")).alias("letters"), t.digits(F.col("text")).alias("digits"))


@query(
    f"""WITH {ad.LINES_SQL}, s AS (SELECT page_id, line_no, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM lines) SELECT page_id, line_no, s <> '' AND (regexp_matches(s, '^[-–—]\\s*[\\p{{L}}\\p{{N}}_]+') OR (regexp_matches(s, '^[“"''‘]') AND regexp_matches(s, '[”"''’]$'))
    OR (length(s) <= 90 AND (suffix(s, '.') OR suffix(s, '!') OR suffix(s, '?')) AND (contains(s, ',') OR contains(s, '...')))) AS dialogue FROM s"""
)
def dialogue_like(spark, d):
    return _lines(spark, d).select("page_id", "line_no", t.is_dialogue(F.col("text")).alias("dialogue"))


@query(
    f"""WITH {ad.LINES_SQL}, s AS (SELECT page_id, line_no, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s, length(trim(regexp_replace(lead(text, 1, '') OVER w || ' ' || lead(text, 2, '') OVER w, '\\s+', ' ', 'g'))) AS rest FROM lines WINDOW w AS (PARTITION BY page_id ORDER BY line_no))
    SELECT page_id, line_no, s <> '' AND length(s) <= 80 AND rest >= 80 AND len(regexp_extract_all(s, '{_LOW}')) >= 5 AND (contains(s, '/') OR contains(s, ':') OR len(list_filter(string_split(s, ' '), lambda t: length(t) >= 3 AND t = upper(t) AND t <> lower(t))) > 0) AS title FROM s"""
)
def prefix_title_pattern(spark, d):
    order = tb.by_page().orderBy("line_no")
    rest = F.concat_ws(" ", F.lead("text", 1, "").over(order), F.lead("text", 2, "").over(order))
    lines = _lines(spark, d).withColumn("rest", F.length(t.squeezed(rest)))
    return lines.select("page_id", "line_no", t.is_title_pattern(F.col("text"), F.col("rest")).alias("title"))


_SOME = ("the", "that", "ing", "und", "pas", "con")


@query("SELECT doc_id, " + " + ".join(f"contains(lower(text), '{k}')::INT" for k in _SOME) + " AS hits, " + " OR ".join(f"contains(lower(text), '{k}')" for k in t.STRUCTURAL) + " AS structural FROM documents WHERE text IS NOT NULL")
def keyword_hits(spark, d):
    return ad.read(spark, d, "documents").where("text is not null").select("doc_id", bx.word_hits(F.col("text"), _SOME).alias("hits"), t.contains_any(F.col("text"), t.STRUCTURAL).alias("structural"))


_WORDS_SQL = "w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS token FROM documents WHERE text IS NOT NULL)"


def _tokens(spark, d, word="[a-zA-Z]+"):
    return ad.read(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(word), F.lit(0))).alias("token")).distinct()


def _lexicon(spark, d):
    """The built-in words and the longer ones of the benchmark's items."""
    words = ad.read(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("word"))
    return correction.lexicon(spark).union(words).distinct()


_LEXICON_SQL = f"lex AS (SELECT unnest([{', '.join(repr(x) for x in correction.LEXICON)}]) AS word UNION SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{6,}}')) AS word FROM benchmark)"


@query(f"WITH {_WORDS_SQL}, {_LEXICON_SQL} SELECT token FROM w WHERE lower(token) IN (SELECT word FROM lex)")
def lexicon_semi_join(spark, d):
    return _tokens(spark, d).join(_lexicon(spark, d), F.lower("token") == F.col("word"), "left_semi")


@query(f"WITH {_WORDS_SQL}, l AS (SELECT DISTINCT unnest([{', '.join(repr(x) for x in correction.LEXICON if x.isascii())}]) AS word) SELECT token, word, levenshtein(lower(token), word) AS distance FROM w JOIN l ON abs(length(token) - length(word)) <= 2 AND levenshtein(lower(token), word) <= 1")
def edit_prefilter(spark, d):
    near = (F.abs(F.length("token") - F.length("word")) <= 2) & (F.levenshtein(F.lower("token"), "word") <= 1)
    words = correction.lexicon(spark).where(F.col("word").rlike("^[a-z]+$"))  # the oracle's distance counts bytes
    return _tokens(spark, d).join(words, near).select("token", "word", F.levenshtein(F.lower("token"), "word").cast("long").alias("distance"))


@query()
def corrections(spark, d):
    """The words of the documents as a recogniser may misread them: each s as ş."""
    tokens = _tokens(spark, d, r"(?U)\w+")
    return correction.suggestions(tokens.union(tokens.select(F.replace("token", F.lit("s"), F.lit("ş")))).distinct(), _lexicon(spark, d))


@query()
def visual_line_titles(spark, d):
    regions = bx.rank_boxes(_cands(spark, d), BW, BH)
    return hl.window_titles(regions, _lines(spark, d))


@query(
    f"""WITH {ad.BOXES_SQL}, {ad.LINES_SQL}, j AS (SELECT a.page_id, a.rk, b.line_no, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) AS ov, b.x2 - b.x1 AS lw, b.confidence FROM boxes a JOIN lines b ON a.page_id = b.page_id AND b.y1 >= a.y1 - 8 AND b.y2 <= round_even(a.y1 + 0.36::DOUBLE * greatest(1, a.y2 - a.y1), 0))
    SELECT page_id, rk, count(*) AS n, min(line_no) AS first_line FROM j WHERE ov > 0 GROUP BY page_id, rk"""
)
def visual_line_range_join(spark, d):
    a, b = _cands(spark, d).alias("a"), _lines(spark, d).alias("b")
    x, y = Box.of("a"), Box.of("b")
    on = (F.col("a.page_id") == F.col("b.page_id")) & (y.y1 >= x.y1 - 8) & (y.y2 <= geometry.whole(x.y1 + 0.36 * F.greatest(F.lit(1), x.height))) & (F.least(x.x2, y.x2) > F.greatest(x.x1, y.x1))
    return a.join(b, on).groupBy(F.col("a.page_id").alias("page_id"), F.col("a.rk").alias("rk")).agg(F.count(F.lit(1)).alias("n"), F.min("b.line_no").alias("first_line"))


@query("WITH c AS (SELECT conv_id, turn, trim(regexp_replace(lower(role), '\\s+', ' ', 'g')) AS norm FROM conversations) SELECT conv_id, turn, norm <> '' AND row_number() OVER (PARTITION BY conv_id, norm ORDER BY turn) > 1 AS again FROM c")
def title_dedup(spark, d):
    return ad.read(spark, d, "conversations").select("conv_id", "turn", hl.repeated_title(F.col("role"), F.lit(""), F.lit("puzzle_page"), ["conv_id"], ["turn"]).alias("again"))


# --- pixels ------------------------------------------------------------------------------------------------------


@query(f"WITH {ad.PIXELS_SQL}, h AS (SELECT page_id, v, count(*) / 256.0::DOUBLE AS p FROM px GROUP BY page_id, v) SELECT page_id, round(sum(-p * log2(p)), 9) AS entropy FROM h GROUP BY page_id")
def gray_entropy(spark, d):
    return px.entropy(_pixels(spark, d)).select("page_id", F.round("entropy", 9).alias("entropy"))


@query(f"WITH {ad.PIXELS_SQL} SELECT page_id, round(avg((v > 128)::INT), 9) AS ratio FROM px WHERE x >= 2 AND x < 12 AND y >= 3 AND y < 9 GROUP BY page_id")
def mask_ratio(spark, d):
    box = ad.read(spark, d, "part").select(F.col("p_partkey").cast("long").alias("page_id"), F.lit(2).alias("x1"), F.lit(3).alias("y1"), F.lit(12).alias("x2"), F.lit(9).alias("y2"))
    return px.mask_ratio(_pixels(spark, d), box, F.col("p.v") > 128).select("page_id", F.round("ratio", 9).alias("ratio"))


@query(f"WITH {ad.PIXELS_SQL}, p AS (SELECT page_id, y, avg((v > 128)::INT) AS f FROM px GROUP BY page_id, y), i AS (SELECT page_id, y, y - row_number() OVER (PARTITION BY page_id ORDER BY y) AS k FROM p WHERE f >= 0.5) SELECT page_id, min(y) AS lo, max(y) + 1 AS hi FROM i GROUP BY page_id, k HAVING max(y) + 1 - min(y) >= 2")
def row_profile_islands(spark, d):
    return px.profile_runs(px.row_profile(_pixels(spark, d), F.col("v") > 128), F.col("fill") >= 0.5, 2)


@query(f"WITH {ad.PIXELS_SQL}, p AS (SELECT page_id, y, sum((v < 244)::INT) AS f FROM px GROUP BY page_id, y) SELECT page_id, y AS split FROM p WHERE y >= 9 AND y < 13 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY f, y) = 1")
def split_row(spark, d):
    profile = _pixels(spark, d).groupBy("page_id", "y").agg(F.sum((F.col("v") < 244).cast("int")).alias("ink"))
    return px.split_row(profile, "ink", 16)


_KERNEL = ", ".join(f"{x!r}::DOUBLE" for x in px.gaussian(31))


@query(
    f"""WITH {ad.PIXELS_SQL}, p AS (SELECT page_id, y, avg((v < 244)::INT) AS f FROM px GROUP BY page_id, y), o AS (SELECT unnest(range(31)) AS d), m AS (SELECT page_id, y, d, ((y + d - 15) % 30 + 30) % 30 AS k FROM p, o),
    s AS (SELECT m.page_id, m.y, round(sum([{_KERNEL}][d + 1] * p.f), 12) AS f FROM m JOIN p ON p.page_id = m.page_id AND p.y = CASE WHEN k < 16 THEN k ELSE 30 - k END GROUP BY m.page_id, m.y) SELECT page_id, y AS split FROM s WHERE y >= 9 AND y < 13 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY f, y) = 1"""
)
def split_row_smoothed(spark, d):
    profile = px.row_profile(_pixels(spark, d), F.col("v") < 244)
    return px.split_row(px.smoothed(profile, "fill").withColumn("fill", F.round("fill", 12)), "fill", 16)


@query(f"WITH {ad.PIXELS_SQL}, q AS (SELECT page_id, (x >= 8)::INT AS qx, (y >= 8)::INT AS qy, avg((v % 16 = 0)::INT) AS e, avg((v < 200)::INT) AS i, avg((v > 190)::INT) AS t FROM px GROUP BY ALL) SELECT page_id, qx, qy FROM q WHERE e >= 0.018 AND i >= 0.16 AND t <= 0.72")
def quadrant_gate(spark, d):
    return px.quadrants(_pixels(spark, d), 16, 16, F.col("v") % 16 == 0, F.col("v") < 200, F.col("v") > 190).select("page_id", "qx", "qy")


@query(f"WITH {ad.PIXELS_SQL} SELECT page_id, min(x) AS x1, min(y) AS y1, max(x) + 1 AS x2, max(y) + 1 AS y2 FROM px WHERE v > 230 GROUP BY page_id")
def tight_bbox(spark, d):
    return px.tight_box(_pixels(spark, d), F.col("v") > 230)


@query(
    f"""WITH {ad.PIXELS_SQL}, a AS (SELECT *, lead(v) OVER r - lag(v) OVER r AS dx, lag(v) OVER r + 2 * v + lead(v) OVER r AS sx FROM px WINDOW r AS (PARTITION BY page_id, y ORDER BY x)),
    b AS (SELECT page_id, lag(dx) OVER c + 2 * dx + lead(dx) OVER c AS gx, lead(sx) OVER c - lag(sx) OVER c AS gy FROM a WINDOW c AS (PARTITION BY page_id, x ORDER BY y)),
    g AS (SELECT * FROM b WHERE gx IS NOT NULL AND gy IS NOT NULL) SELECT page_id, round((quantile_cont(abs(gx), 0.92) / greatest(0.001, avg(abs(gx))) + quantile_cont(abs(gy), 0.92) / greatest(0.001, avg(abs(gy)))) / 2.0, 6) AS grid_score FROM g GROUP BY page_id"""
)
def sobel_grid(spark, d):
    return px.grid_score(_pixels(spark, d)).select("page_id", F.round("grid_score", 6).alias("grid_score"))


@query(
    f"""WITH {ad.PIXELS_SQL}, m AS (SELECT page_id, y, x FROM px WHERE v > 240), o AS (SELECT unnest([[0, 0], [0, 1], [0, -1], [1, 0], [-1, 0]]) AS o) SELECT DISTINCT page_id, (y + o[1])::INTEGER AS y, (x + o[2])::INTEGER AS x FROM m, o WHERE y + o[1] BETWEEN 0 AND 15 AND x + o[2] BETWEEN 0 AND 15"""
)
def dilated_mask(spark, d):
    return px.dilated(_pixels(spark, d).where("v > 240").select("page_id", "y", "x"), 1, 16, 16)


#: Pages that a task draws and looks at.
PAGES_A_TASK = 250


def _images(spark, d, size=(96, 128)):
    """Small pages of a few textured boxes on white, by formula.

    A file of ids is small whatever work its pages are, so they are counted and dealt out before they grow to pixels.
    """
    import numpy as np

    w, h = size

    def draw(batches):
        import pyarrow as pa

        for batch in (b.slice(a, 64) for b in batches for a in range(0, b.num_rows, 64)):
            out = []
            for page in batch.column("page_id").to_pylist():
                image = np.full((h, w, 3), 255, np.uint8)
                y, x = np.mgrid[0:h, 0:w]
                for k in range(page % 3 + 1):
                    a, b = 6 + (page * 7 + k * 43) % 40, 6 + (page * 13 + k * 59) % 60
                    part = (slice(b, b + 46), slice(a, a + 44))
                    image[part] = ((x * x * (k + 3) + y * y * 5 + page * 31) % 251)[part][..., None] * np.array([1.0, 0.6, 0.3])
                out.append(image.tobytes())
            n = len(out)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array([w] * n, pa.int64()), pa.array([h] * n, pa.int64()), pa.array(out, pa.binary())], ["page_id", "width", "height", "pixels"])

    ids = ad.read(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("page_id"))
    ids = ids.repartition(max(spark.sparkContext.defaultParallelism, ids.count() // PAGES_A_TASK + 1))
    return ids.mapInArrow(draw, "page_id long, width long, height long, pixels binary")


@query()
def page_features(spark, d):
    found = vi.page_features(_images(spark, d))
    return found.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes])


@query()
def page_pictures(spark, d):
    small = replace(Settings(), visual=Visual(min_visual_width_px=12, min_visual_height_px=12))
    return vi.visual_blocks(_images(spark, d), None, small)


@query()
def whole_page_json(spark, d):
    return whole_pages.process(spark, _images(spark, d), _lines(spark, d), Settings(), LH)


# --- reports ---------------------------------------------------------------------------------------------------


def _profiles(spark, d):
    stage = F.element_at(F.array(*[F.lit(s) for s in reports.STAGES]), (F.col("event_id") % 9 + 1).cast("int"))
    return ad.read(spark, d, "events").select(F.col("event_id").alias("page_id"), F.round(F.col("value"), 2).alias("total_sec"), stage.alias("stage"), F.col("event_type").alias("layout_type"))


_PROF = "p AS (SELECT event_id AS page_id, round(value, 2) AS v, event_type FROM events)"


@query(
    f"""WITH {_PROF}, r AS (SELECT v, row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n FROM p) SELECT count(*) AS pages, round(sum(v), 2) AS total_sec, round(avg(v), 3) AS avg_sec_per_page, round(median(v), 3) AS median_sec_per_page, round(max(v) FILTER (i = round_even(0.95 * (n - 1), 0) + 1), 3) AS p95_sec_per_page,
    round(count(*) * 60.0 / sum(v), 2) AS throughput_pages_per_min FROM r"""
)
def benchmark_summary(spark, d):
    digits = {"total_sec": 2, "avg_sec_per_page": 3, "median_sec_per_page": 3, "p95_sec_per_page": 3, "throughput_pages_per_min": 2}
    return reports.benchmark_summary(_profiles(spark, d)).select("pages", *[F.round(c, n).alias(c) for c, n in digits.items()])


@query("SELECT event_type AS layout_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ROLLUP (event_type, strftime(ts, '%Y-%m-%d'))")
def stage_rollup(spark, d):
    return ad.read(spark, d, "events").rollup(F.col("event_type").alias("layout_type"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ad.BOXES_SQL} SELECT count(DISTINCT page_id) AS pages, count(*) AS total, coalesce(round(median(area_ratio), 4), 0.0::DOUBLE) AS median_area_ratio, count(*) FILTER (area_ratio < 0.03) AS tiny, count(*) FILTER (area_ratio > 0.65) AS huge FROM boxes WHERE {REASON_SQL} = 'ok'")
def eval_report(spark, d):
    return reports.visual_report(_cands(spark, d).where(bx.keep_reason(BW, BH) == "ok"))


@query("SELECT conv_id AS page_id, count(*) FILTER (role = 'user') AS headline, count(*) FILTER (role = 'assistant') AS content, count(*) FILTER (role NOT IN ('user', 'assistant')) AS other, count(*) FILTER (role = 'user' AND regexp_matches(trim(text), '^[-–—]')) AS dialogue_as_headline FROM conversations GROUP BY conv_id")
def role_report(spark, d):
    role = F.when(F.col("role") == "user", "headline_group").when(F.col("role") == "assistant", "content").otherwise("other_text_group")
    return reports.role_report(ad.read(spark, d, "conversations").select(F.col("conv_id").alias("page_id"), role.alias("role"), "text"))


@query("WITH s AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'pdf' ELSE 'image' END AS kind, n_name AS name, unnest(range(1, 6))::BIGINT AS page_no FROM nation) SELECT kind, name, page_no FROM s WHERE kind = 'image' OR page_no >= 3 ORDER BY (kind = 'pdf')::INT, lower(name), name, page_no LIMIT 90")
def page_budget(spark, d):
    rows = ad.read(spark, d, "nation").select(F.when(F.col("n_nationkey") % 3 == 0, "pdf").otherwise("image").alias("kind"), F.col("n_name").alias("name"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("page_no"))
    return reports.page_budget(rows, 90, start=3)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents as OCR lines, grouped to blocks with roles."""
    return block_roles(spark, sf_dir)
