"""Operators on the cases of FIXTURES.md, and properties that must hold on any boxes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from layoutspark.config import Classification, Correction, Grouping, Settings, load_settings
from layoutspark.functions import correction, geometry
from layoutspark.functions import text as t
from layoutspark.functions.geometry import Box
from layoutspark.operators import boxes as bx
from layoutspark.operators import headlines as hl
from layoutspark.operators import pixels as px
from layoutspark.operators import reports
from layoutspark.operators import text_blocks as tb
from layoutspark.plans.engine import Engine
from layoutspark.sources import files
from layoutspark.streaming import pages as stream

LINE = "page_id long, line_no long, text string, confidence double, x1 long, y1 long, x2 long, y2 long"


def lines(spark, rows, page=1):
    return spark.createDataFrame([(page, i, text, 0.9, *box) for i, (text, *box) in enumerate(rows)], LINE)


def boxes(spark, rows, page=1):
    return spark.createDataFrame([(page, i, *b) for i, b in enumerate(rows, 1)], "page_id long, rk int, x1 long, y1 long, x2 long, y2 long")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_geometry_round_trip(spark):
    b = Box.of()
    one = boxes(spark, [(123, 456, 1789, 2890)]).select(b.per_mille(2000, 3000).struct().alias("s")).select(*Box.of(struct="s").from_per_mille(2000, 3000).columns()).first()
    assert all(abs(x - y) <= 3 for x, y in zip(one, (123, 456, 1789, 2890)))


def test_iou_is_symmetric_and_bounded(spark):
    r = random.Random(1)
    rows = [(x, y, x + r.randint(1, 60), y + r.randint(1, 60)) for x, y in ((r.randint(0, 80), r.randint(0, 80)) for _ in range(40))]
    df = boxes(spark, rows)
    a, b = Box.of("a"), Box.of("b")
    for p, q in df.alias("a").join(df.alias("b"), F.col("a.page_id") == F.col("b.page_id")).select(a.iou(b), b.iou(a)).collect():
        assert p == q and 0 <= p <= 1


def test_page_number_and_kernel(spark):
    assert value(spark, geometry.page_number(F.lit("mag_p0042"))) == 42
    assert value(spark, geometry.page_number(F.lit("mag"))) is None
    assert value(spark, geometry.kernel_of(1000, 600, 0.005)) == 3


def test_column_order(spark):
    df = lines(spark, [("R1", 420, 100, 520, 130), ("L1", 60, 80, 200, 110), ("R2", 420, 140, 520, 170), ("L2", 60, 120, 200, 150)]).withColumn("root", F.lit(0).cast("long"))
    found = tb.column_order(df).join(df.select("line_no", "text"), "line_no").orderBy("order_no").collect()
    assert [r.text for r in found] == ["L1", "L2", "R1", "R2"]


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("B", 500, 80, 700, 200), ("A", 60, 90, 260, 230), ("C", 80, 420, 300, 560)], "A B C"),
        ([("R_TOP", 1180, 80, 1450, 180), ("L_TOP", 120, 90, 420, 210), ("L_BOTTOM", 140, 360, 430, 500), ("R_BOTTOM", 1210, 340, 1490, 490)], "L_TOP L_BOTTOM R_TOP R_BOTTOM"),
    ],
)
def test_reading_order(spark, rows, expected):
    assert " ".join(r.text for r in tb.reading_order(lines(spark, rows), "line_no").orderBy("read_no").collect()) == expected


def test_three_lines_are_one_block(spark):
    found = tb.text_blocks(lines(spark, [("line1", 50, 100, 420, 130), ("line2", 52, 140, 418, 170), ("line3", 49, 180, 422, 210)])).collect()
    assert len(found) == 1 and found[0].line_count == 3 and found[0].text == "line1 line2 line3"


def test_every_line_is_in_one_block(spark):
    r = random.Random(3)
    rows = [(f"word{i} and more", x, y, x + r.randint(60, 400), y + r.randint(18, 40)) for i, (x, y) in enumerate((r.randint(0, 700), r.randint(0, 1400)) for _ in range(60))]
    df = lines(spark, rows)
    assert sum(b.line_count for b in tb.text_blocks(df).collect()) == 60
    again = tb.line_components(df).select("page_id", "line_no", "root").collect()
    assert all(x.root <= x.line_no for x in again)


def test_prefix_headline_is_split(spark):
    rows = [
        ("Ektiğini biçer insan", 100, 100, 560, 155),
        ("Vaktiyle kimseciği olmayan ihtiyar bir kadıncağız...", 102, 210, 860, 248),
        ("Teyze, kanaatkâr ve mütevekkildi.", 102, 255, 830, 292),
        ("Avuç açmazdı kimseye, şükrederdi hep hâline.", 104, 298, 850, 335),
    ]
    df = lines(spark, rows).withColumn("root", F.lit(0).cast("long"))
    split = tb.split_prefix(df)
    assert [r.part for r in split.orderBy("line_no").collect()] == [0, 1, 1, 1]
    blocks = tb.blocks_of(split.withColumn("root", F.col("part").cast("long"))).withColumn("seq", F.col("root"))
    median = df.groupBy("page_id").agg(F.median((F.col("y2") - F.col("y1")).cast("double")).alias("page_median_h"))
    found = tb.roles(blocks, median, "seq", Classification())
    assert {r.role for r in found.collect()} == {"headline", "content"}
    grouped = tb.article_groups(found, F.lit(1000.0), "seq")
    assert {r.article_no for r in grouped.collect()} == {1}
    items = tb.compose(grouped.select("page_id", "seq", "role", "x1", "y1", "x2", "y2", "text", F.col("article_no").cast("long").alias("article_no")), "seq").collect()
    assert len(items) == 1 and items[0].role == "headline_group" and items[0].headline_text == "Ektiğini biçer insan"


def test_logical_items(spark):
    rows = [(1, 1, 1, "headline", 10, 10, 110, 30, "BASLIK"), (1, 2, 1, "content", 10, 40, 180, 120, "icerik 1"), (1, 3, 2, "content", 220, 20, 300, 70, "diger 1"), (1, 4, 3, "other_text", 220, 90, 330, 150, "diger 2")]
    found = tb.compose(spark.createDataFrame(rows, "page_id long, seq long, article_no long, role string, x1 long, y1 long, x2 long, y2 long, text string"), "seq").orderBy("item_no").collect()
    assert [r.role for r in found] == ["headline_group", "other_text_group"]
    assert found[0].headline_text == "BASLIK" and "icerik 1" in found[0].content_text and "diger 1" in found[0].content_text and found[1].text == "diger 2"


def test_headlines_have_at_most_one_content(spark):
    rows = [(1, i, "headline" if i % 3 == 0 else "content", 10 * i % 400, 40 * i, 10 * i % 400 + 200, 40 * i + 30, "x") for i in range(1, 25)]
    found = tb.article_groups(spark.createDataFrame(rows, "page_id long, seq long, role string, x1 long, y1 long, x2 long, y2 long, text string"), F.lit(1000.0), "seq").collect()
    for n in {r.article_no for r in found}:
        roles = [r.role for r in found if r.article_no == n]
        assert len(roles) <= 2 and roles.count("content") <= 1 and roles.count("headline") <= 1


@pytest.mark.parametrize("box, metrics, reason", [((0, 0, 20, 20), (0.001, 0.02, 1.0, 0.5, 0.9, 0.0, 5.0), "too_small_abs"), ((10, 10, 220, 220), (0.08, 0.2, 1.0, 0.12, 0.6, 0.01, 6.0), "ok")])
def test_candidate_filter(spark, box, metrics, reason):
    names = ("area_ratio", "short_side_ratio", "aspect_ratio", "edge_density", "fill_ratio", "text_overlap_ratio", "entropy")
    df = boxes(spark, [box]).select("*", *[F.lit(m).alias(n) for n, m in zip(names, metrics)])
    assert df.select(bx.keep_reason(1000, 1000).alias("r")).first().r == reason


def test_suppressed_boxes_overlap_kept_ones(spark):
    r = random.Random(5)
    rows = [(x, y, x + r.randint(20, 90), y + r.randint(20, 90)) for x, y in ((r.randint(0, 100), r.randint(0, 100)) for _ in range(60))]
    kept = [tuple(k)[2:] for k in bx.greedy(boxes(spark, rows), [F.col("rk")], 0.3).collect()]
    assert all(bx._iou(a, b) <= 0.3 for i, a in enumerate(kept) for b in kept[:i])
    assert all(any(bx._iou(x, k) > 0.3 for k in kept) for x in rows if x not in kept)


def test_merges(spark):
    rows = [(0, 0, 10, 10), (2, 2, 12, 12), (100, 100, 120, 120), (11, 11, 13, 13)]
    merged = {tuple(r)[2:] for r in bx.merge_overlaps(boxes(spark, rows), 0.25).collect()}
    assert merged == {(0, 0, 12, 12), (100, 100, 120, 120), (11, 11, 13, 13)}
    assert {tuple(r)[2:] for r in bx.merge_fragments(boxes(spark, rows), 1000, 1000).collect()} == {(0, 0, 13, 13), (100, 100, 120, 120)}


def test_equal_boxes_drop_each_other(spark):
    assert bx.drop_contained(boxes(spark, [(0, 0, 9, 9), (0, 0, 9, 9), (50, 50, 60, 60)])).count() == 1


def test_halves_of_a_wide_strip(spark):
    found = bx.halves(boxes(spark, [(10, 100, 1950, 800)]), 2000, 1400).orderBy("half").collect()
    assert [(r.x1, r.x2) for r in found] == [(0, 1010), (990, 2000)]


@pytest.mark.parametrize("cfg, text, expected", [(Correction(similarity_threshold=0.8, min_margin_over_second=0.01), "Turkiyede cocuklar icin harika hikayler var.", ["hikayeler"]), (Correction(), "Iletisim: 444 44 39", ["444 44 39"]), (Correction(), "IHLAS KOLEJI", ["ihlas koleji"]), (Correction(), "Buvuklerimiz dive dedi, evimde kilom vok.", ["büyüklerimiz", "diye", "yok"])])
def test_correction(spark, cfg, text, expected):
    blocks = spark.createDataFrame([(1, text)], "id long, text string")
    found = correction.correct(blocks, correction.lexicon(spark), ["id"], cfg=cfg).first().text
    assert all(x in found.lower() for x in expected)


def test_both_ways_of_correction_agree(spark, monkeypatch):
    """A lexicon that is broadcast and one that is joined; and all near words are found by their pieces."""
    r = random.Random(2)
    words = sorted({"".join(r.choice("abcçgğıikosşuüvy") for _ in range(r.randint(4, 16))) for _ in range(120)} | set(correction.LEXICON))

    def changed(w):
        w = list(w)
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(w))
            w[i : i + r.randint(0, 1)] = r.choice(["", "v", "ı", "o", "q", "s"])
        return "".join(w)

    for cfg in (Correction(), Correction(similarity_threshold=0.8, min_margin_over_second=0.01)):
        here = correction.Corrector(words, cfg)
        tokens = sorted({t for t in (changed(r.choice(words)) for _ in range(400)) if t})
        for token in tokens:
            rated = sorted((-max(0.0, 1 - here.distance(token, w) / max(1, len(token), len(w))), w) for w in words if abs(len(w) - len(token)) <= 2)
            if rated and -rated[0][0] >= cfg.similarity_threshold:
                assert any(rated[0][1] in here.near.get(k, ()) for k in correction.token_keys(token, cfg))
        df = spark.createDataFrame([(w,) for w in words], "word string")
        pairs = spark.createDataFrame([(t, w) for t in tokens[:60] for w in words if t.translate(correction._fold) == w.translate(correction._fold)], "t string, w string")
        assert all(x.a == x.b for x in pairs.select(F.array_contains(correction.variants(F.col("t")), F.col("w")).alias("a"), correction.is_variant(F.col("t"), F.col("w")).alias("b")).collect())
        joined = correction.suggestions(spark.createDataFrame([(t,) for t in tokens], "token string"), df, cfg).collect()
        assert {x.token: x.suggestion for x in joined} == {t: s for t in tokens if (s := here.suggestion(t)) is not None} != {}
    blocks = spark.createDataFrame([(1, "Buvuklerimiz dive dedi, evimde kilom vok."), (2, None)], "id long, text string")
    near = {x.id: x.text for x in correction.correct(blocks, correction.lexicon(spark), ["id"]).collect()}
    monkeypatch.setattr(correction, "BROADCAST_WORDS", 3)
    assert near == {x.id: x.text for x in correction.correct(blocks, correction.lexicon(spark), ["id"]).collect()} and near[2] is None


def test_weighted_distance(spark):
    d = lambda a, b: value(spark, correction.weighted_distance(F.lit(a), F.lit(b)))
    assert d("yok", "vok") == pytest.approx(0.24) and d("", "abc") == 3 and d("abc", "") == 3 and d("kitap", "kitp") == 1 and d("şey", "sey") == pytest.approx(0.24)


def test_cleaning_is_the_same_in_both_forms(spark):
    texts = ["  A  b <i>c</i> , d .", "k itap", "the the end", "re- do it", "5 % 3 , x ' y", "ﬁne  ½", "Word word WORD", "", "ç ocuk ; a : b"]
    found = [r.c for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").orderBy("i").select(t.clean_ocr(F.col("x")).alias("c")).collect()]
    assert found == [t.clean_ocr_text(x) for x in texts]


def test_titles(spark):
    split = value(spark, t.title_and_byline(F.lit("Kar Tanesi - Yazan Ayşe Er")))
    assert (split.title, split.byline) == ("Kar Tanesi", "Yazan Ayşe Er")
    assert value(spark, t.normalized_title(F.lit("bir <b>mini kare</b> a@b.c"))) == "Mini Kare"
    assert value(spark, t.is_headline_pattern(F.lit("Bir"))) is False


def test_a_large_page(spark):
    """10,000 lines on one page, in two columns."""
    import time

    rows = [(f"line {i} of many words", 60 + 520 * (i % 2), 40 * (i // 2), 500 + 520 * (i % 2), 40 * (i // 2) + 26 + i % 3) for i in range(10_000)]
    began = time.time()
    found = tb.text_blocks(lines(spark, rows)).select("line_count").collect()
    assert sum(r.line_count for r in found) == 10_000 and time.time() - began < 60


def test_closures_equal_brute_force(spark):
    r = random.Random(23)
    cfg = Grouping()
    for size in (1, 7, 60):
        rows = [(f"w{i}", x, y, x + r.randint(20, 300), y + r.randint(10, 60)) for i, (x, y) in enumerate((r.randint(0, 900), r.randint(0, 1500)) for _ in range(size))]
        heights = sorted(y2 - y1 for _, _, y1, _, y2 in rows)
        med = max(1.0, (heights[size // 2] + heights[(size - 1) // 2]) / 2)

        def over(a, b):
            return max(0, min(a[3], b[3]) - max(a[1], b[1])) / max(1, min(a[3] - a[1], b[3] - b[1]))

        def linked(a, b):
            ha, hb, center, left = a[4] - a[2], b[4] - b[2], abs((a[1] + a[3]) / 2 - (b[1] + b[3]) / 2) / med, abs(a[1] - b[1]) / med
            near = max(0, b[2] - a[4], a[2] - b[4]) / med <= cfg.max_vertical_gap_ratio
            return max(ha, hb) / max(1, min(ha, hb)) <= cfg.max_line_height_ratio and near and center <= cfg.max_reading_flow_dx_ratio and (over(a, b) >= cfg.min_horizontal_overlap_ratio or min(left, center) <= cfg.max_alignment_delta_ratio)

        def blocks_linked(a, b):
            return max(0, b[2] - a[4], a[2] - b[4]) / med <= cfg.max_block_vertical_gap_ratio and (over(a, b) >= cfg.min_horizontal_overlap_ratio or abs(a[1] - b[1]) / med <= cfg.max_alignment_delta_ratio)

        def closure(items, link):
            root = list(range(len(items)))
            for _ in items:
                for i in range(len(items)):
                    for j in range(len(items)):
                        if link(items[i], items[j]):
                            root[i] = root[j] = min(root[i], root[j])
            return root

        first = closure(rows, linked)
        assert [x.root for x in tb.line_components(lines(spark, rows)).orderBy("line_no").collect()] == first
        names = sorted(set(first))
        around = [("", *(f(x[k] for x, g in zip(rows, first) if g == n) for f, k in ((min, 1), (min, 2), (max, 3), (max, 4)))) for n in names]
        second = closure(around, blocks_linked)
        assert [x.root for x in tb.grouped(lines(spark, rows), absorb=False).orderBy("line_no").collect()] == [names[second[names.index(g)]] for g in first]


def test_second_pass_is_held_against_the_lines_so_far(spark):
    first = lines(spark, [("a", 0, 0, 100, 20), ("b", 0, 300, 100, 320)])
    second = lines(spark, [("c", 0, 80, 100, 100), ("d", 0, 80, 101, 100), ("A", 0, 0, 110, 20), ("AA", 0, 0, 122, 20), ("weak", 0, 300, 100, 320)])
    second = second.withColumn("confidence", F.when(F.col("text") == "d", 0.95).when(F.col("text") == "weak", 0.5).otherwise(0.93))
    # d takes the place of c, which no first-pass line matched; AA lies on A, which moved the line, but isn't surer
    assert [(r.text, r.x2) for r in tb.merge_line_sets(first, second).orderBy("line_no").collect()] == [("A", 110), ("d", 101), ("b", 100)]


def test_region_titles(spark):
    regions = boxes(spark, [(100, 100, 700, 900)]).withColumn("visual_class", F.lit("puzzle_page")).withColumn("panel_index", F.lit(1))
    found = hl.window_titles(regions, lines(spark, [("Çengel Bulmaca", 150, 110, 400, 150), ("başka bir satır", 150, 600, 400, 640)])).collect()
    assert [r.title for r in found] == ["Çengel Bulmaca"]
    items = spark.createDataFrame([(1, 1, "headline_group", 120, 120, 500, 300, "Kelime Avı burada", "Kelime Avı")], "page_id long, item_no int, role string, x1 long, y1 long, x2 long, y2 long, text string, headline_text string")
    grouped = hl.group_titles(regions, items, 1200, 1000)
    assert grouped.first().title == "Kelime Avı"
    assert hl.choose([hl.window_titles(regions, lines(spark, [("Çengel Bulmaca", 150, 110, 400, 150)])), grouped], regions).count() == 1


def test_second_pass_lines(spark):
    first = lines(spark, [("a", 0, 0, 100, 20), ("b", 0, 40, 100, 60)])
    second = lines(spark, [("A", 0, 0, 100, 20), ("c", 0, 80, 100, 100)]).withColumn("confidence", F.lit(0.95))
    assert sorted(r.text for r in tb.merge_line_sets(first, second).collect()) == ["A", "b", "c"]


def test_masks(spark):
    mask = px.filled_boxes(boxes(spark, [(2, 2, 4, 4)]), 8, 8)
    assert mask.count() == 9
    grown = px.dilated(mask, 1, 8, 8)
    assert grown.count() == 21 and px.eroded(grown, 1, 8, 8).count() == 9


def test_benchmark_summary(spark):
    rows = spark.createDataFrame([(i, float(i), 1.0) for i in range(1, 11)], "page_id long, total_sec double, read_sec double")
    found = reports.benchmark_summary(rows).first()
    assert (found.pages, found.total_sec, found.median_sec_per_page, found.p95_sec_per_page) == (10, 55.0, 5.5, 10.0)
    assert reports.benchmark_summary(rows.limit(0)).first().pages == 0
    assert reports.stage_totals(rows).collect()[0].total_sec == 10.0
    assert files.report_markdown(found.asDict(), {"read_sec": 10.0}).startswith("# Benchmark Report")


def test_settings(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"grouping": {"max_vertical_gap_ratio": 2.0, "unknown": 1}}))
    assert load_settings(str(path)).grouping.max_vertical_gap_ratio == 2.0
    with pytest.raises(FileNotFoundError):
        load_settings(str(tmp_path / "none.json"))


def test_engine_and_sql(spark):
    rows = [("Kar Tanesi Masalı", 100, 100, 560, 155), ("Bir varmış bir yokmuş, evvel zaman içinde uzun bir yol vardı.", 102, 210, 860, 248), ("İkinci satır burada devam eder ve sürer.", 102, 255, 830, 292), ("Üçüncü satır da böyle.", 104, 298, 850, 335)]
    engine = Engine(spark, lines(spark, rows).union(lines(spark, rows, 2)), Settings())
    engine.where("page_id = 1").register()
    assert spark.sql("SELECT count(DISTINCT page_id) AS n FROM text_blocks").first().n == 1
    assert spark.sql("SELECT box_area(0, 0, 3, 4) AS a").first().a == 12
    assert "headline_group" in {r.role for r in spark.table("logical_blocks").collect()}
    result = files.nested(spark.createDataFrame([(1, 10)], "page_id long, width long"), engine.where("page_id = 1").text_blocks.withColumn("block_no", F.col("read_no")).drop("regions"), spark.createDataFrame([], "page_id long, block_no int, klass string"))
    assert json.loads(result.first().json)["width"] == 10


def test_sources(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "x.txt", "doc.pdf"):
        (tmp_path / name).write_bytes(b"data")
    assert sorted(r.name for r in files.images(spark, str(tmp_path)).collect()) == ["a.jpg", "b.PNG"]
    assert [r.name for r in files.listing(spark, str(tmp_path), content=False).collect()] == ["a.jpg", "b.PNG"]
    assert {(r.name, r.kind) for r in files.inputs(spark, str(tmp_path)).collect()} == {("a.jpg", "image"), ("b.PNG", "image"), ("doc.pdf", "pdf")}
    render = lambda content, scale, start: iter([(1, 1, b"p")] * (4 - start))
    pages = files.pdf_pages(files.pdfs(spark, str(tmp_path)), render, start=2)
    assert [r.page_no for r in pages.collect()] == [2, 3]
    assert [r.page_no for r in files.pdf_pages(files.pdfs(spark, str(tmp_path)), render, only=3).collect()] == [3]
    with pytest.raises(Exception, match="no page 4"):
        files.pdf_pages(files.pdfs(spark, str(tmp_path)), render, only=4).collect()
    with pytest.raises(ValueError):
        files.recognised(pages, "none")
    files.BACKENDS["stub"] = lambda: lambda rows: [[("hello", 0.9, [(1.4, 2.6), (9, 2), (9, 8), (1, 8)]), ("weak", 0.1, [(0, 0)] * 4)] for _ in rows]
    found = files.recognised(pages.withColumn("page_id", F.col("page_no").cast("long")), "stub").collect()
    assert [(r.text, r.x1, r.y1, r.x2, r.y2) for r in found] == [("hello", 1, 2, 9, 8)] * 2


def test_parsed_lines(spark):
    raw = json.dumps({"rec_polys": [[[1, 2], [9, 2], [9, 8], [1, 8]]], "rec_texts": ["hi"], "rec_scores": [0.7]})
    row = files.parsed_lines(spark.createDataFrame([(1, raw)], "page_id long, result string")).first()
    assert tuple(row) == (1, 0, "hi", 0.7, 1, 2, 9, 8)


def test_older_results(spark):
    raw = json.dumps([None, [[[[1, 2], [9, 2], [9, 8], [1, 8]], ["hi", 0.7]], [[[1, 2], [3, 4]], ["", 0.9]]]])
    assert [tuple(r) for r in files.parsed_older_lines(spark.createDataFrame([(1, raw)], "page_id long, result string")).collect()] == [(1, 0, "hi", 0.7, 1, 2, 9, 8)]


def test_streaming(spark, tmp_path):
    rows = lines(spark, [("a b", 0, 0, 100, 20)]).union(lines(spark, [("c d", 0, 0, 100, 20)], 2))
    for page in (1, 2):
        rows.where(F.col("page_id") == page).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def work(df):
        return tb.line_components(df).withColumn("checked", F.when(F.col("page_id") == 2, F.raise_error(F.lit("bad page"))).otherwise(F.lit("ok")).cast("string"))

    query = stream.process(stream.arriving(spark, str(tmp_path / "in"), LINE), work, str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "bad"))
    query.awaitTermination(120)
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).select("page_id").distinct().count() == 1
    assert [r.page_id for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == [2]
    events = spark.createDataFrame([("2024-01-01 00:00:01", "a", 1.0), ("2024-01-01 00:04:00", "a", 2.0), ("2024-01-01 00:30:00", "a", 3.0)], "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    assert stream.windowed(events).count() == 2 and stream.sessions(events, F.col("event_type")).count() == 2


def test_entry_imports_without_the_llm_folders(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "layoutspark", tmp_path / "layoutspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q) and len(q) > 50; e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True).returncode == 0


@pytest.mark.parametrize("text", ["a" + " " * 100 + "b", "<b class='" + "x" * 90 + "'>ab</b>"])
def test_a_block_is_short_by_its_cleaned_text(spark, text):
    assert len(t.clean_ocr_text(text).strip()) <= 18
    rows = lines(spark, [("A long line of text that stays as it is", 0, 0, 300, 30), (text, 0, 40, 300, 70)])
    apart = Grouping(max_vertical_gap_ratio=-1, max_block_vertical_gap_ratio=-1)
    assert {r.root for r in tb.grouped(rows, apart, absorb=False).collect()} == {0, 1}
    assert {r.root for r in tb.grouped(rows, apart).collect()} == {0}


def test_corrections_take_unicode_words(spark, tmp_path):
    from layoutspark.plans import catalog

    spark.createDataFrame([(1, "Bir öğrencı geldi, réeaution."), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "No word of these.")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [(r.token, r.suggestion) for r in catalog.corrections(spark, str(tmp_path)).collect()] == [("öğrencı", "öğrenci")]
    assert {r.token for r in catalog._tokens(spark, str(tmp_path), r"(?U)\w+").collect()} == {"Bir", "öğrencı", "geldi", "réeaution"}


def test_composition_equals_brute_force(spark):
    """Items of random pages against the rules said one after the other, without plans."""
    r = random.Random(40)
    pages = []
    for page in range(14):
        wide = page % 2 == 0
        blocks = []
        for seq in range(r.randint(1, 14)):
            x, y = r.randrange(0, 1500 if wide else 600, 10), r.randrange(0, 900, 10)
            blocks.append((page, seq, r.randint(0, 5), r.choice(["headline", "content", "content", "other_text"]), x, y, x + r.randrange(50, 400, 10), y + r.randrange(20, 120, 10), r.choice(["", " "]) + f"t{seq}" if r.random() < 0.9 else "  "))
        pages.append(blocks)
    schema = "page_id long, seq long, article_no long, role string, x1 long, y1 long, x2 long, y2 long, text string"
    found = {}
    for x in tb.compose(spark.createDataFrame([b for p in pages for b in p], schema), "seq").collect():
        found.setdefault(x.page_id, []).append((x.item_no, x.article_no, x.role, x.x1, x.y1, x.x2, x.y2, x.text, x.headline_text, x.content_text))
    around = lambda bs: (min(b[4] for b in bs), min(b[5] for b in bs), max(b[6] for b in bs), max(b[7] for b in bs))
    centre = lambda a, b: (a + b) / 2
    for page, blocks in enumerate(pages):
        px1, py1, px2, py2 = around(blocks)
        spread, mid = (px2 - px1) / (py2 - py1) >= 1.35, centre(px1, px2)
        right = lambda x1, x2: spread and centre(x1, x2) > mid
        articles = {}
        for b in blocks:
            articles.setdefault(b[2], []).append(b)

        def from_top(bs):
            top = min(bs, key=lambda b: (b[5], b[4]))
            return right(around(bs)[0], around(bs)[2]), top[5], top[4], around(bs)[1], bs[0][2]

        order = sorted(articles, key=lambda a: from_top(articles[a]))
        headed = {a: list(articles[a]) for a in order if any(b[3] == "headline" for b in articles[a])}
        rest = []
        for b in blocks:
            if b[2] in headed:
                continue
            if b[3] != "content" or not headed:
                rest.append(b)
                continue
            marks = []
            for place, (a, bs) in enumerate(headed.items()):
                head, box = around([m for m in bs if m[3] == "headline"]), around(bs)
                if len(headed) > 1 and spread and (centre(b[4], b[6]) > mid) != (centre(head[0], head[2]) > mid):
                    continue
                down = max(0, b[5] - head[3]) if b[5] >= head[1] else abs(centre(b[5], b[7]) - centre(box[1], box[3]))
                over = max(0, min(b[6], box[2]) - max(b[4], box[0])) / max(1, min(b[6] - b[4], box[2] - box[0]))
                marks.append((2 * over - abs(centre(b[4], b[6]) - centre(box[0], box[2])) / (px2 - px1) - 0.8 * (down / (py2 - py1)) + 0.2 * (b[1] >= max(m[1] for m in bs)), -place, a))
            if len(headed) == 1:
                headed[next(iter(headed))].append(b)
            elif marks and max(marks)[0] >= -0.35:
                headed[max(marks)[2]].append(b)
            else:
                rest.append(b)
        said = lambda bs: " ".join(b[8].strip() for b in bs if b[8].strip())
        items = []
        for a, bs in headed.items():
            bs = sorted(bs, key=lambda b: b[1])
            head, body = said([b for b in bs if b[3] == "headline"]), said([b for b in bs if b[3] != "headline"])
            items.append((a, "headline_group", *around(bs), " ".join(x for x in (head, body) if x), head, body))
        heights = sorted(b[7] - b[5] for b in rest)
        far = max(26, 1.45 * (heights[len(heights) // 2] + heights[(len(heights) - 1) // 2]) / 2) if rest else 0
        groups = []
        for b in sorted(rest, key=lambda b: (right(b[4], b[6]), b[5], b[4], b[1])):
            if not groups or right(groups[-1][-1][4], groups[-1][-1][6]) != right(b[4], b[6]) or b[5] - groups[-1][-1][7] > far:
                groups.append([])
            groups[-1].append(b)
        items += [(None, "other_text_group", *around(g), said(g), None, None) for g in groups if said(g)]
        got = sorted(found.get(page, []))
        assert sorted(map(repr, (x[1:] for x in got))) == sorted(map(repr, items)), page
        if items:
            ix1, ix2 = min(i[2] for i in items), max(i[4] for i in items)
            tall = max(i[5] for i in items) - min(i[3] for i in items)
            keys = [(max(1, ix2 - ix1) / max(1, tall) >= 1.35 and centre(i[3], i[5]) > centre(ix1, ix2), i[4], i[3]) for i in got]
            assert keys == sorted(keys) and [i[0] for i in got] == list(range(1, len(got) + 1))


def test_order_dependent_merges_equal_brute_force(spark):
    r = random.Random(6)
    rows = [(x, y, x + r.randint(20, 120), y + r.randint(20, 120)) for x, y in ((r.randint(0, 700), r.randint(0, 700)) for _ in range(45))]
    order = sorted(rows)
    order.sort(key=lambda b: (b[1], b[0], b[2], b[3]))
    around = lambda a, b: (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))

    def growing(boxes):
        out, left = [], list(boxes)
        while left:
            current = left.pop(0)
            while near := [b for b in left if bx._iou(current, b) >= 0.25]:
                current = around(current, near[0])
                left.remove(near[0])
            out.append(current)
        return out

    def panels(boxes):
        while True:
            out, used = [], set()
            for i, a in enumerate(boxes):
                if i in used:
                    continue
                for j in range(i + 1, len(boxes)):
                    if j not in used and bx._iou(a, boxes[j]) >= 0.24:
                        a, used = around(a, boxes[j]), used | {j}
                out.append(a)
            if len(out) == len(boxes):
                return out
            boxes = out

    got = lambda df: [tuple(x)[2:] for x in df.orderBy("seq").collect()]
    assert set(got(bx.merge_overlaps(boxes(spark, rows)))) == set(growing(order))
    assert got(bx.merge_panels(boxes(spark, rows))) == panels(order)
