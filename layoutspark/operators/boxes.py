"""Filters, scores, selections and merges of boxes, each a DataFrame to a DataFrame; pages are the only groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Visual
from ..functions.geometry import Box
from .pages import per_page

BOX = ("x1", "y1", "x2", "y2")


def keep_reason(w: int, h: int, cfg: Visual = Visual()) -> Column:
    """The first reason to reject a candidate, or ok. What needs geometry alone comes before what needs pixels."""
    b = Box.of()
    area, edge, fill, text, entropy = (F.col(c) for c in ("area_ratio", "edge_density", "fill_ratio", "text_overlap_ratio", "entropy"))
    wr, hr = b.width / float(max(1, w)), b.height / float(max(1, h))
    strip = ((wr > cfg.strip_span_ratio) & (hr < cfg.strip_other_ratio)) | ((hr > cfg.strip_span_ratio) & (wr < cfg.strip_other_ratio))
    strip_rescue = area.between(0.08, 0.45) & (edge >= max(0.008, cfg.min_edge_density * 1.2)) & (entropy >= 3.4) & (fill >= 0.18)
    edge_rescue = (edge >= cfg.edge_touch_rescue_min_edge_density) & (entropy >= cfg.edge_touch_rescue_min_entropy) & (area <= cfg.edge_touch_rescue_max_area_ratio)
    text_rescue = (area >= cfg.text_heavy_rescue_min_area_ratio) & (edge >= cfg.text_heavy_rescue_min_edge_density) & (entropy >= cfg.text_heavy_rescue_min_entropy)
    small = area < cfg.small_region_high_quality_area_ratio
    rules = [
        ((b.width < cfg.min_visual_width_px) | (b.height < cfg.min_visual_height_px), "too_small_abs"),
        (area < cfg.min_visual_area_ratio, "too_small_ratio"),
        (area > cfg.max_visual_area_ratio, "too_large_ratio"),
        (F.col("short_side_ratio") < cfg.min_visual_short_side_ratio, "too_thin_relative"),
        (F.col("aspect_ratio") > cfg.max_aspect_ratio, "too_long_strip"),
        ((wr >= 0.97) & (hr >= 0.97), "full_page_like"),
        (strip & ~strip_rescue, "too_canvas_strip"),
        ((b.edge_touches(w, h) >= 3) & (area > cfg.edge_touch_reject_area_ratio) & ~edge_rescue, "edge_touch_large"),
        ((text > cfg.max_text_overlap_ratio) & ~text_rescue, "text_heavy_region"),
        (edge < cfg.min_edge_density, "low_edge_density"),
        (small & (edge < cfg.small_region_min_edge_density), "small_low_edge"),
        (small & (entropy < cfg.small_region_min_entropy), "small_low_entropy"),
        (fill < cfg.min_fill_ratio, "low_fill_ratio"),
        (entropy < cfg.min_entropy, "low_entropy"),
    ]
    return cascade(rules, "ok")


def cascade(rules: list[tuple[Column, object]], otherwise) -> Column:
    """The value of the first rule that holds."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def simple_reason(w: int, h: int, non_text_fill: Column, cfg: Visual = Visual()) -> Column:
    """keep_reason and what simple mode rejects besides."""
    b, base = Box.of(), keep_reason(w, h, cfg)
    return cascade(
        [
            (base != "ok", base),
            (b.is_full_page(w, h), "full_page_like_simple"),
            (b.is_strip(w, h, cfg.strip_span_ratio, cfg.strip_other_ratio), "strip_like_simple"),
            (F.col("area_ratio") > 0.7, "too_large_simple"),
            (non_text_fill < 0.1, "low_non_text_fill"),
            ((F.col("text_overlap_ratio") > 0.42) & (F.col("edge_density") < 0.012), "text_overlap_simple"),
        ],
        "ok",
    )


def visual_class(w: int, h: int) -> Column:
    b = Box.of()
    area, fill, aspect, text = (F.col(c) for c in ("area_ratio", "fill_ratio", "aspect_ratio", "text_overlap_ratio"))
    framed = (fill >= 0.35) & (aspect <= 4.0) & (text <= 0.6)
    return cascade(
        [
            (area >= 0.45, "full_compositions"),
            ((fill >= 0.43) & area.between(0.02, 0.2) & (aspect <= 2.2), "collage_cards"),
            (framed & (text >= 0.1) & (b.wr(w) >= 0.22) & (b.hr(h) >= 0.12), "comic_panels"),
            (framed, "framed_rectangular"),
            ((F.col("edge_density") >= 0.012) | (F.col("entropy") >= 3.8), "freeform_illustrations"),
        ],
        "ambiguous_review",
    )


def review_reasons(w: int, h: int, klass: Column) -> Column:
    """Why a person should look at a decision; none: an empty array."""
    b = Box.of()
    touches = (b.x1 <= 1) | (b.y1 <= 1) | (b.x2 >= w - 1) | (b.y2 >= h - 1)
    return F.array_compact(
        F.array(
            F.when((klass != "full_compositions") & touches, "touches_page_edge"),
            F.when((F.col("text_overlap_ratio") > 0.6) & (F.col("edge_density") < 0.02), "text_heavy"),
            F.when((F.col("area_ratio") < 0.01) & (F.col("entropy") < 3.2), "tiny_or_weak"),
        )
    )


def _capped(name: str, at: float) -> Column:
    return F.least(F.lit(1.0), F.col(name) / at)


def decision_score(w: int, h: int, needs_review: Column) -> Column:
    b, area = Box.of(), F.col("area_ratio")
    base = 2.0 * _capped("edge_density", 0.03) + 1.8 * _capped("entropy", 5.2) + 0.7 * _capped("fill_ratio", 0.45) - 1.6 * _capped("text_overlap_ratio", 0.55)
    base = base + cascade([(area > 0.72, F.lit(-2.4)), (area > 0.55, F.lit(-1.3)), (area.between(0.02, 0.5), F.lit(0.55))], F.lit(0.0))
    base = base + F.when(b.either_band(w, h, 0.92, 0.33, strict=True), F.lit(-1.8)).otherwise(F.lit(0.0))
    return base + F.when(needs_review, F.lit(-0.6)).otherwise(F.lit(0.0))


def simple_score(w: int, h: int) -> Column:
    b, area = Box.of(), F.col("area_ratio")
    base = 2.0 * _capped("edge_density", 0.03) + 1.8 * _capped("entropy", 5.2) + 0.9 * _capped("fill_ratio", 0.45) - 1.2 * _capped("text_overlap_ratio", 0.55)
    base = base + cascade([(area.between(0.03, 0.45), F.lit(0.6)), (area > 0.62, F.lit(-1.5))], F.lit(0.0))
    return base + F.when(b.either_band(w, h, 0.92, 0.33, strict=True), F.lit(-1.2)).otherwise(F.lit(0.0))


def decisions(candidates: DataFrame, w: int, h: int, cfg: Visual = Visual()) -> DataFrame:
    """Candidates that are kept, with their class, review reasons and quality score."""
    kept = candidates.withColumn("reason", keep_reason(w, h, cfg)).where("reason = 'ok'").withColumn("base_class", visual_class(w, h))
    kept = kept.withColumn("review_reasons", review_reasons(w, h, F.col("base_class"))).withColumn("needs_review", F.size("review_reasons") > 0)
    kept = kept.withColumn("visual_class", F.when(F.col("needs_review"), "ambiguous_review").otherwise(F.col("base_class")))
    return kept.withColumn("quality", decision_score(w, h, F.col("needs_review"))).drop("reason", "base_class")


def greedy(boxes: DataFrame, order: list[Column], threshold: float, most: int | None = None, clash: Callable | None = None, group: str = "page_id") -> DataFrame:
    """Non-maximum suppression per page: in the given order, boxes that overlap none kept before by more than the threshold.

    One array per page goes through a fold in the JVM; `order` must be total, as stable sorts are. `clash` of a kept
    box and another one replaces the overlap test.
    """
    names = boxes.columns
    ranked = boxes.withColumn("__rank", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    lists = ranked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__rank", *[c for c in names if c != group]))).alias("bs"))
    empty = F.filter("bs", lambda b: F.lit(False))

    clash = clash or (lambda k, b: Box.element(k).iou(Box.element(b)) > threshold)

    def step(kept: Column, b: Column) -> Column:
        drop = F.exists(kept, lambda k: clash(k, b))
        if most is not None:
            drop = drop | (F.size(kept) >= most)
        return F.when(drop, kept).otherwise(F.concat(kept, F.array(b)))

    return lists.select(group, F.explode(F.aggregate("bs", empty, step)).alias("b")).select(group, *[F.col(f"b.{c}").alias(c) for c in names if c != group])


def drop_contained(boxes: DataFrame, share: float = 0.92, group: str = "page_id", key: str = "rk") -> DataFrame:
    """Without boxes that lie in another of at least their area; two equal boxes drop each other."""
    a, b = boxes.alias("a"), boxes.alias("b")
    x, y = Box.of("a"), Box.of("b")
    inside = x.intersection(y) / F.greatest(F.lit(1), x.area()).cast("double") >= share
    return a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col(f"a.{key}") != F.col(f"b.{key}")) & inside & (y.area() >= x.area()), "left_anti")


def best(rows: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    """The first rows of each key."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def route(decided: DataFrame, archetype: Column, cfg: Visual = Visual()) -> DataFrame:
    """Per page at most as many decisions, of at least the area, as its archetype allows; the best ones."""
    least = cascade([(archetype == "full_photo_page", F.lit(0.04)), (archetype == "collage_card_page", F.lit(0.02)), (archetype == "text_heavy_editorial_page", F.lit(0.03))], F.lit(0.0))
    most = cascade(
        [
            (archetype == "full_photo_page", F.lit(cfg.max_visuals_full_photo_page)),
            (archetype == "collage_card_page", F.lit(cfg.max_visuals_collage_card_page)),
            (archetype == "comic_panel_page", F.lit(cfg.max_visuals_comic_panel_page)),
            (archetype == "text_heavy_editorial_page", F.lit(cfg.max_visuals_text_heavy_editorial_page)),
        ],
        F.lit(2**31 - 1),
    )
    fit = decided.withColumn("archetype", archetype).where(F.col("area_ratio") >= least)
    ranked = fit.withColumn("place", F.row_number().over(W.partitionBy("page_id").orderBy(F.col("quality").desc(), "rk")))
    return ranked.where(F.col("place") <= most)


def select_set(decided: DataFrame) -> DataFrame:
    """The decisions of a page that stay: overlaps go, one giant gets two alternatives, many fragments are cut to the best five."""
    order = [F.col("quality").desc(), F.col("rk")]
    kept = greedy(decided, order, 0.72)
    w = W.partitionBy("page_id")
    kept = kept.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("small", F.sum((F.col("area_ratio") <= 0.08).cast("int")).over(w)).withColumn("covered", F.sum("area_ratio").over(w))
    kept = kept.withColumn("place", F.row_number().over(w.orderBy(*order)))
    giant = kept.where("n = 1 and area_ratio > 0.7").select(F.col("page_id").alias("gp"), F.col("rk").alias("gk"), F.struct(*BOX).alias("g"))
    other = decided.join(giant, (F.col("page_id") == F.col("gp")) & (F.col("rk") != F.col("gk"))).where((F.col("area_ratio") >= 0.05) & (Box.of().iou(Box.of(struct="g")) < 0.55)).drop("gp", "gk", "g")
    kept = kept.where("not (n > 5 and small >= 4 and covered <= 0.7) or place <= 5").drop("n", "small", "covered", "place")
    return kept.unionByName(best(other, ["page_id"], order, 2))


# --- layout policy -----------------------------------------------------------------------------------


def rank_boxes(boxes: DataFrame, w: int, h: int, most: int = 2) -> DataFrame:
    """By area and a bonus for the usual shape, without bands and small boxes, overlaps above 0.7 suppressed."""
    b = Box.of()
    bonus = F.when(b.wr(w).between(0.18, 0.82) & b.hr(h).between(0.18, 0.95), F.lit(0.2)).otherwise(F.lit(0.0))
    fit = boxes.withColumn("policy_score", b.ar(w, h) + bonus).where((b.ar(w, h) >= 0.05) & ~b.is_band_like(w, h))
    return greedy(fit, [F.col("policy_score").desc(), F.col("rk")], 0.7, most)


def select_puzzle_boxes(boxes: DataFrame, w: int, h: int, most: int = 4) -> DataFrame:
    """The largest box of each half (on spreads), then of each quadrant, then by area, without overlaps."""
    b = Box.of()
    fit = boxes.withColumn("area", b.area()).where((b.ar(w, h) >= 0.045) & ~b.is_band_like(w, h)).withColumn("right", b.cx > w / 2.0).withColumn("low", b.cy > h / 2.0)
    by_area = [F.col("area").desc(), F.col("rk")]
    rank = lambda *keys: F.row_number().over(W.partitionBy("page_id", *keys).orderBy(*by_area))
    ranked = fit.withColumn("in_half", rank("right")).withColumn("in_quadrant", rank("right", "low"))
    spread = w / max(1, h) >= 1.35
    tier = cascade([((F.col("in_half") == 1) & F.lit(spread), F.when(F.col("right"), 1).otherwise(0)), (F.col("in_quadrant") == 1, F.lit(2))], F.lit(3))

    def clash(k: Column, b: Column) -> Column:
        overlap = Box.element(k).iou(Box.element(b))
        return F.when(b["tier"] == 1, overlap >= 0.7).otherwise(overlap > 0.68)

    return greedy(ranked.withColumn("tier", tier), [F.col("tier"), *by_area], 0.68, most, clash)


def plans(selected: DataFrame, w: int, h: int, page_type: Column, confidence: Column) -> DataFrame:
    """Class, side and number of each selected box."""
    b, ar = Box.of(), Box.of().ar(w, h)
    klass = cascade(
        [
            (page_type.isin("comic_panel_page", "activity_page"), "comic_panel_page"),
            (page_type == "puzzle_page", "puzzle_page"),
            (page_type == "framed_photo_page", "framed_photo"),
            (page_type == "background_photo_page", "background_photo_page"),
            (ar >= 0.45, "background_photo_page"),
            (ar >= 0.12, "framed_photo"),
        ],
        "corner_illustration",
    )
    side = b.side(w) if w / max(1, h) >= 1.35 else F.lit("single")
    order = W.partitionBy("page_id").orderBy("y1", "x1", "x2", "y2", "rk")
    return selected.withColumn("visual_class", klass).withColumn("page_side", side).withColumn("confidence", F.bround(confidence, 3)).withColumn("panel_index", F.row_number().over(order))


def page_archetype(text: Column, non_text: Column, edges: Column, components: Column) -> Column:
    return cascade(
        [
            ((text <= 0.14) & (edges >= 0.02) & (non_text >= 0.5), "full_photo_page"),
            ((text >= 0.4) & (non_text <= 0.45), "text_heavy_editorial_page"),
            ((components >= 7) & text.between(0.12, 0.38), "collage_card_page"),
            (components.between(3, 8) & text.between(0.12, 0.35), "comic_panel_page"),
        ],
        "mixed_page",
    )


#: The confidence of each archetype, and words that mark puzzle pages.
ARCHETYPE_CONFIDENCE = {"full_photo_page": 0.78, "text_heavy_editorial_page": 0.74, "collage_card_page": 0.72, "comic_panel_page": 0.66, "mixed_page": 0.5}
PUZZLE_WORDS = ("bulmaca", "kelime av", "kelime avi", "çengel", "sudoku", "soldan sağa", "yukarıdan aşağıya", "şifre", "rakamli", "rakamlı")


def page_layout(text: Column, non_text: Column, edges: Column, rects: Column, grid: Column, n_lines: Column, words: Column) -> Column:
    """struct(page_type, confidence)."""
    value = lambda name, confidence: F.struct(F.lit(name).alias("page_type"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).alias("confidence"))
    return cascade(
        [
            ((non_text >= 0.72) & (text <= 0.32) & (rects <= 2) & (edges >= 0.02), value("background_photo_page", 0.80)),
            (((grid >= 5.4) | (words >= 2)) & (text >= 0.08), value("puzzle_page", F.when(words >= 2, 0.82).otherwise(0.74))),
            ((rects >= 3) & (n_lines >= 12), value("comic_panel_page", 0.72)),
            ((rects >= 2) & (text >= 0.12), value("activity_page", 0.66)),
            ((rects >= 1) & (text <= 0.2), value("framed_photo_page", 0.62)),
        ],
        value("mixed_page", 0.5),
    )


def word_hits(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words a text contains, in lower case."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(k)).cast("int") for k in words), F.lit(0))


# --- plan quality ---------------------------------------------------------------------------------------


def plan_score(w: int, h: int) -> Column:
    strip = Box.of().either_band(w, h, 0.84, 0.30)
    entropy = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("entropy") - 2.0) / 4.0))
    return 1.6 * F.col("edge_density") + 0.9 * entropy + 0.9 * (1.0 - F.col("text_overlap_ratio")) - F.when(strip, F.lit(0.45)).otherwise(F.lit(0.0))


def refine(planned: DataFrame, w: int, h: int, page_type: Column, min_keep: int = 1) -> DataFrame:
    """Hard rejects, overlaps by score, the best rejected ones back up to min_keep, review flags and new numbers."""
    strip, text, score = Box.of().either_band(w, h, 0.84, 0.30), F.col("text_overlap_ratio"), F.col("plan_score")
    relaxed = page_type.isin("puzzle_page", "comic_panel_page", "activity_page")
    weak = (text >= F.when(relaxed, 0.66).otherwise(0.58)) & (F.col("edge_density") < 0.018) & (F.col("entropy") < 3.1)
    low = (score < F.when(relaxed, 0.40).otherwise(0.44)) & (text >= 0.34)
    scored = planned.withColumn("plan_score", plan_score(w, h))
    scored = scored.withColumn("rejected", (F.col("visual_class") != "background_photo_page") & ((strip & (text >= 0.26)) | weak | low))
    # rejected ones come last in the order; they are taken only while fewer than min_keep are kept
    names = scored.columns
    ranked = scored.withColumn("__rank", F.row_number().over(W.partitionBy("page_id").orderBy("rejected", score.desc(), "rk")))
    lists = ranked.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("__rank", *[c for c in names if c != "page_id"]))).alias("bs"))

    def step(kept: Column, p: Column) -> Column:
        clash = F.exists(kept, lambda k: Box.element(k).iou(Box.element(p)) > 0.72)
        return F.when(clash | (p["rejected"] & (F.size(kept) >= min_keep)), kept).otherwise(F.concat(kept, F.array(p)))

    out = lists.select("page_id", F.explode(F.aggregate("bs", F.filter("bs", lambda p: F.lit(False)), step)).alias("p")).select("page_id", *[F.col(f"p.{c}").alias(c) for c in names if c != "page_id"])
    out = out.withColumn("needs_review", (score < 0.52) | (text > 0.42))
    return out.withColumn("panel_index", F.row_number().over(W.partitionBy("page_id").orderBy("y1", "x1", "rk")))


def stacked_pairs(boxes: DataFrame, w: int, h: int, side: str | None = None) -> DataFrame:
    """Per page the best pair of boxes of one half (of `side`, if given), one well above the other."""
    b = Box.of()
    fit = boxes.where(b.ar(w, h).between(0.08, 0.34)).withColumn("side", b.side(w))
    fit = fit if side is None else fit.where(F.col("side") == side)
    x, y = Box.of("a"), Box.of("b")
    dy, apart = F.abs(x.y1 - y.y1) / float(max(1, h)), F.abs(x.cx - y.cx) / float(max(1, w))
    total = (x.area() + y.area()) / float(max(1, w * h))
    rules = (x.iou(y) <= 0.22) & (dy >= 0.16) & ((x.h_overlap(y) >= 0.42) | (apart <= 0.12)) & (total >= 0.22)
    pairs = fit.alias("a").join(fit.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.side") == F.col("b.side")) & (F.col("a.rk") < F.col("b.rk")) & rules)
    score = x.h_overlap(y) * 1.5 + F.least(F.lit(1.0), dy / 0.45) + total
    pairs = pairs.select(F.col("a.page_id").alias("page_id"), F.col("a.side").alias("side"), F.col("a.rk").alias("rk_a"), F.col("b.rk").alias("rk_b"), score.alias("pair_score"))
    return best(pairs, ["page_id"], [F.col("pair_score").desc(), F.col("rk_a"), F.col("rk_b")])


def halves(planned: DataFrame, w: int, h: int) -> DataFrame:
    """A spread's only plan, if it is a wide strip, becomes a left and a right one that overlap in the middle."""
    b = Box.of()
    alone = F.count(F.lit(1)).over(W.partitionBy("page_id")) == 1
    wide = F.lit(w / max(1, h) >= 1.35) & alone & (b.wr(w) >= 0.86) & b.hr(h).between(0.20, 0.76)
    mid, zero = F.lit(w // 2).cast("long"), F.lit(0).cast("long")
    both = F.array(Box(zero, b.y1, mid + 10, b.y2).struct(), Box(mid - 10, b.y1, F.lit(w).cast("long"), b.y2).struct())
    marked = planned.withColumn("wide", wide)
    return marked.select("page_id", "rk", "wide", F.posexplode(F.when(F.col("wide"), both).otherwise(F.array(b.struct()))).alias("half", "p")).select("page_id", "rk", "wide", "half", "p.*")


#: How many boxes a kind of page keeps; two, if it isn't here.
KEEP = {"background_photo_page": 1, "puzzle_page": 4}


def policy(pattern: DataFrame, heuristic: DataFrame, pages: DataFrame, w: int, h: int) -> DataFrame:
    """The plans of each page: of its pattern boxes or, if it has none, of its other ones; pages (page_id, page_type, confidence, full_page).

    A page with full_page is one plan of the whole page.
    """
    without = heuristic.join(pattern.select(F.col("page_id").alias("pp")).distinct(), F.col("page_id") == F.col("pp"), "left_anti")
    kinds = pages.select(F.col("page_id").alias("kp"), "page_type", "confidence", "full_page")
    source = pattern.unionByName(without, allowMissingColumns=True).join(kinds, F.col("page_id") == F.col("kp")).where("not full_page")
    puzzle = select_puzzle_boxes(source.where("page_type = 'puzzle_page'"), w, h, KEEP["puzzle_page"]).drop("area", "right", "low", "in_half", "in_quadrant", "tier")
    other = rank_boxes(source.where("page_type <> 'puzzle_page'"), w, h, 2)
    other = other.withColumn("place", F.row_number().over(W.partitionBy("page_id").orderBy(F.col("policy_score").desc(), "rk"))).where(f"page_type <> 'background_photo_page' or place <= {KEEP['background_photo_page']}").drop("place", "policy_score")
    names = ["page_id", "rk", *BOX, "visual_class", "page_side", "confidence", "panel_index"]
    made = plans(puzzle.unionByName(other), w, h, F.col("page_type"), F.col("confidence")).select(*names)
    whole = pages.where("full_page").select("page_id", F.lit(1).alias("rk"), *[F.lit(v).cast("long").alias(c) for c, v in zip(BOX, (0, 0, w, h))], F.lit("background_photo_page").alias("visual_class"), F.lit("single").alias("page_side"), F.lit(1.0).alias("confidence"), F.lit(1).alias("panel_index"))
    return made.unionByName(whole)


def replaced(planned: DataFrame, new: DataFrame) -> DataFrame:
    """planned, but for pages that have new plans."""
    return planned.join(new.select(F.col("page_id").alias("np")).distinct(), F.col("page_id") == F.col("np"), "left_anti").unionByName(new.select(*planned.columns))


def _as_plans(rows: DataFrame, boxes: Column, klass: str, confidence: Column, side: Column) -> DataFrame:
    """Plans of an array of boxes per page, numbered in its order."""
    found = rows.select("page_id", F.posexplode(boxes).alias("n", "b"), confidence.alias("confidence"), side.alias("side"))
    return found.select("page_id", (F.col("n") + 1).alias("rk"), *[F.col(f"b.{c}").cast("long").alias(c) for c in BOX], F.lit(klass).alias("visual_class"), F.get("side", F.col("n")).alias("page_side"), "confidence", (F.col("n") + 1).alias("panel_index"))


def _fixed(*boxes: tuple[float, float, float, float], w: int, h: int) -> Column:
    return F.array(*[Box(*(F.lit(round(v * s)).cast("long") for v, s in zip(b, (w, h, w, h)))).struct() for b in boxes])


def stacked_override(planned: DataFrame, pool: DataFrame, pages: DataFrame, w: int, h: int) -> DataFrame:
    """On the third page of a spread magazine two framed photos above each other on the left stand for a huge box on the right.

    pool: boxes that a pair may come from; pages (page_id, page_no, full_page). Without a pair, a huge box gives way to
    the usual places of the two.
    """
    if w / max(1, h) < 1.35:
        return planned
    asked = pages.where("page_no = 3 and not full_page").select("page_id")
    share, right = Box.of().ar(w, h), Box.of().cx > w / 2.0
    state = asked.join(planned, "page_id", "left").groupBy("page_id").agg(F.count("rk").alias("n"), F.coalesce(F.max((share >= 0.42) & right), F.lit(False)).alias("opposite"), F.coalesce(F.max(share >= 0.42), F.lit(False)).alias("huge"))
    pairs = stacked_pairs(pool, w, h, "left")
    box = lambda k: pool.select(F.col("page_id").alias(f"p{k}"), F.col("rk").alias(f"r{k}"), F.struct(*BOX).alias(k))
    pairs = pairs.join(box("a"), (F.col("page_id") == F.col("pa")) & (F.col("rk_a") == F.col("ra"))).join(box("b"), (F.col("page_id") == F.col("pb")) & (F.col("rk_b") == F.col("rb")))
    pairs = pairs.select(F.col("page_id").alias("sp"), F.array_sort(F.array(F.struct(F.col("a.y1").alias("top"), F.col("a").alias("box")), F.struct(F.col("b.y1").alias("top"), F.col("b").alias("box")))).alias("pair"))
    rows = state.join(pairs, F.col("page_id") == F.col("sp"), "left")
    left = F.array(F.lit("left"), F.lit("left"))
    found = _as_plans(rows.where("pair is not null and (opposite or n < 2)"), F.transform("pair", lambda x: x["box"]), "framed_photo", F.lit(0.74), left)
    usual = _as_plans(rows.where("pair is null and huge"), _fixed((0.20, 0.05, 0.49, 0.52), (0.04, 0.52, 0.49, 0.98), w=w, h=h), "framed_photo", F.lit(0.68), left)
    return replaced(planned, found.unionByName(usual))


def puzzle_override(planned: DataFrame, splits: DataFrame, w: int, h: int) -> DataFrame:
    """A puzzle page's four plans are cut anew at its emptiest row; splits (page_id, split). The parts overlap there and in the middle."""
    four = planned.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("panel_index", "confidence"))["confidence"].alias("c"), F.min("visual_class").alias("lo"), F.max("visual_class").alias("hi")).where("n = 4 and lo = 'puzzle_page' and hi = 'puzzle_page'")
    rows = four.join(splits, "page_id")
    lap, mid, of = max(22, round(h * 0.055)), w // 2, lambda v: F.lit(v).cast("long")
    top, low = F.least(of(h), F.col("split") + lap), F.greatest(of(0), F.col("split") - lap)
    boxes = F.array(*[Box(of(a), c, of(b), d).struct() for c, d in ((of(0), top), (low, of(h))) for a, b in ((0, mid + 8), (mid - 8, w))])
    sides = F.array(*[F.lit(x) for x in ("left", "right", "left", "right")])
    return replaced(planned, _as_plans(rows, boxes, "puzzle_page", F.greatest(F.lit(0.78), F.col("c")), sides))


def forced(planned: DataFrame, candidates: DataFrame, pages: DataFrame, most: int = 2) -> DataFrame:
    """Pages (page_id) that must show something get their largest candidates that overlap no plan by more than 0.55, up to two plans."""
    have = planned.join(pages.select("page_id"), "page_id", "left_semi").select("page_id", F.lit(0).alias("late"), F.col("panel_index").cast("long").alias("n"), "rk", *BOX)
    more = candidates.join(pages.select("page_id"), "page_id", "left_semi").withColumn("n", F.row_number().over(W.partitionBy("page_id").orderBy(Box.of().area().desc(), "rk")).cast("long")).select("page_id", F.lit(1).alias("late"), "n", "rk", *BOX)
    none = pages.select("page_id").join(planned.select("page_id").distinct(), "page_id", "left_anti").withColumn("empty", F.lit(True))
    both = have.unionByName(more)
    kept = greedy(both, [F.col("late"), F.col("n")], 0.55, most, lambda k, b: (b["late"] == 1) & (Box.element(k).iou(Box.element(b)) > 0.55))
    new = kept.where("late = 1").join(none, "page_id", "left")
    new = new.select("page_id", "rk", *BOX, F.lit("framed_photo").alias("visual_class"), F.lit("single").alias("page_side"), F.when(F.col("empty"), 0.4).otherwise(0.42).alias("confidence"), F.when(F.col("empty"), 1).otherwise(2).alias("panel_index"))
    return planned.unionByName(new.select(*planned.columns))


# --- merges whose result depends on the order: one page at a time ----------------------------------------


def _area(b) -> int:
    return max(0, b[2] - b[0]) * max(0, b[3] - b[1])


def _iou(a, b) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0, w) * max(0, h)
    return both / (_area(a) + _area(b) - both) if both else 0.0


def _around(a, b):
    return (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))


def absorb(boxes: list, joins: Callable, grow: bool, again: bool) -> list:
    """Each box in turn takes in the later ones that join it: once, or with `grow` while it grows.

    With `again`, passes over all boxes repeat until none takes in any.
    """
    while True:
        left, out, any_took = list(boxes), [], False
        while left:
            current = left.pop(0)
            while True:
                rest, took = [], False
                for other in left:
                    if joins(current, other):
                        current, took = _around(current, other), True
                    else:
                        rest.append(other)
                left, any_took = rest, any_took or took
                if not (grow and took):
                    break
            out.append(current)
        if not (again and any_took):
            return out
        boxes = out


def merge_pages(boxes: DataFrame, joins: Callable, grow: bool = False, again: bool = False) -> DataFrame:
    """(page_id, seq, box) of the merged boxes; the order of boxes in a page is (y1, x1, x2, y2)."""

    def page(rows: list) -> list[tuple]:
        return [(n, *b) for n, b in enumerate(absorb([(r.x1, r.y1, r.x2, r.y2) for r in rows], joins, grow, again))]

    slim = boxes.select("page_id", *[F.col(c).cast("long").alias(c) for c in BOX])
    return per_page(slim, ["page_id"], ["y1", "x1", "x2", "y2"], page, "page_id long, seq int, x1 long, y1 long, x2 long, y2 long")


def merge_overlaps(boxes: DataFrame, threshold: float = 0.25) -> DataFrame:
    return merge_pages(boxes, lambda a, b: _iou(a, b) >= threshold, grow=True)


def merge_panels(boxes: DataFrame, threshold: float = 0.24) -> DataFrame:
    return merge_pages(boxes, lambda a, b: _iou(a, b) >= threshold, again=True)


def merge_fragments(boxes: DataFrame, w: int, h: int, cfg: Visual = Visual()) -> DataFrame:
    """Boxes that are near on an axis and overlap across it, while their union stays small."""
    near = max(3, round(min(w, h) * cfg.fragment_merge_gap_ratio))
    gap = lambda a, b, i: max(0, b[i] - a[i + 2], a[i] - b[i + 2])
    cross = lambda a, b, i: max(0, min(a[i + 2], b[i + 2]) - max(a[i], b[i])) / max(1, min(a[i + 2] - a[i], b[i + 2] - b[i]))

    def joins(a, b) -> bool:
        if min(gap(a, b, 0), gap(a, b, 1)) > near or max(cross(a, b, 0), cross(a, b, 1)) < cfg.fragment_merge_min_cross_overlap:
            return False
        return _area(_around(a, b)) / (w * h) <= cfg.fragment_merge_max_union_area_ratio

    return merge_pages(boxes, joins, grow=True, again=True)


def merge_parents(boxes: DataFrame, w: int, h: int, cfg: Visual = Visual()) -> DataFrame:
    """Boxes of which one lies for the larger part in the other, while their union is not the whole page."""

    def joins(a, b) -> bool:
        bw, bh = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        both = max(0, bw) * max(0, bh)
        return both > 0 and both / max(1, min(_area(a), _area(b))) >= cfg.parent_child_iou_merge and _area(_around(a, b)) / max(1, w * h) <= cfg.max_visual_area_ratio

    return merge_pages(boxes, joins, again=True)
