"""Headlines of visual regions: range joins with lines and logical items, scored, the best one kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.geometry import Box, is_spread, whole
from .boxes import best


def window_candidates(regions: DataFrame, lines: DataFrame) -> DataFrame:
    """(page_id, region key rk, line_no, score, text): lines at the top of a region that may be its title."""
    a, b = regions.alias("a"), lines.alias("b")
    x, y = Box.of("a"), Box.of("b")
    shared = F.greatest(F.lit(0), F.least(x.x2, y.x2) - F.greatest(x.x1, y.x1))
    cap = whole(x.y1 + 0.36 * F.greatest(F.lit(1), x.height))
    joined = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (y.y1 >= x.y1 - 8) & (y.y2 <= cap) & (shared > 0))
    rows = joined.select(F.col("a.page_id").alias("page_id"), F.col("a.rk").alias("rk"), F.col("b.line_no").alias("line_no"), t.normalized_title(F.col("b.text")).alias("text"), (shared / F.greatest(F.lit(1), y.width).cast("double")).alias("over"), F.col("b.confidence").alias("confidence"))
    known = t.contains_any(F.col("text"), t.STRUCTURAL)
    rows = rows.where((F.size(t.words_of(F.col("text"))) <= 7) & (~F.col("text").rlike("[?!]") | known) & (F.regexp_count("text", F.lit(r"\p{L}")) >= 4))
    score = 0.2 + F.col("over") + F.when(known, 1.0).otherwise(0.0) + F.when(F.col("confidence") >= 0.8, 0.25).otherwise(0.0)
    return rows.select("page_id", "rk", "line_no", score.alias("score"), "text")


def window_titles(regions: DataFrame, lines: DataFrame) -> DataFrame:
    """(page_id, rk, title, byline, full): the best line of each region."""
    top = best(window_candidates(regions, lines), ["page_id", "rk"], [F.col("score").desc(), F.col("line_no")])
    return top.select("page_id", "rk", t.title_and_byline(F.col("text")).alias("h")).select("page_id", "rk", "h.*")


#: Words that keep a group's headline from being a region's, and titles lifted from other text.
GROUP_NOISE = ("gezegenimize", "bekli", "dünyalılar", "koku", "saçtınız", "hazırlan", "oğlum", "şef", "isterseniz", "buyrun")
LIFTED = "(labirent bulmaca|nokta birleştirme|kelime avı|çengel bulmaca|fazla harfler|mini kare|hayvanat bahçesi|kar tanesi|haylaz)"


def group_titles(regions: DataFrame, items: DataFrame, w: int, h: int) -> DataFrame:
    """(page_id, rk, title, byline, full): the logical item whose headline goes best with each region."""
    lifted = F.regexp_extract("text", f"(?iu){LIFTED}", 1)
    raw = F.trim(F.when(F.col("role") == "headline_group", F.coalesce("headline_text", F.lit(""))).otherwise(F.when(t.contains_any(F.coalesce("text", F.lit("")), t.STRUCTURAL), lifted).otherwise(F.lit(""))))
    named = items.withColumn("raw", raw).where((F.col("raw") != "") & ~t.contains_any(F.col("raw"), GROUP_NOISE))
    known = t.contains_any(F.col("raw"), t.STRUCTURAL)
    credited = F.col("raw").rlike(r"(?iuU)\b(yazan|çizen|hazırlayan|resimleyen)\b")
    named = named.where((~F.col("raw").rlike("[!?]") | known) & ((F.size(t.words_of(F.col("raw"))) <= 9) | credited))
    named = named.withColumn("hd", t.title_and_byline(F.col("raw"))).where("hd.full <> ''").withColumn("known", known)
    a, b = regions.alias("a"), named.alias("b")
    x, y = Box.of("a"), Box.of("b")
    panel = F.col("a.visual_class").isin(*t.PANEL_PAGES)
    full = F.col("b.hd.full")
    fits = ~panel | t.contains_any(full, t.CREDITS) | t.contains_any(full, t.STRUCTURAL)
    asked = ~((F.col("a.visual_class") == "puzzle_page") & (F.col("a.panel_index") > 2))
    over = x.intersection(y) / F.greatest(F.lit(1), F.least(x.area(), y.area())).cast("double")
    apart = F.abs(x.cx - y.cx) / float(max(1, w)) + F.abs(x.cy - y.cy) / float(max(1, h))
    same = F.when(x.side(w) == y.side(w), 0.4).otherwise(-0.4)
    side = F.when(is_spread(F.lit(w), F.lit(h)), same).otherwise(0.0)
    top = F.when(y.y1 <= x.y1 + F.floor(0.35 * F.greatest(F.lit(1), x.height)), 0.2).otherwise(0.0)
    score = 2.6 * over + side + top + F.when(F.col("b.known"), 0.25).otherwise(0.0) - apart
    pairs = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & fits & asked)
    pairs = pairs.select(F.col("a.page_id").alias("page_id"), F.col("a.rk").alias("rk"), F.col("b.item_no").alias("item_no"), score.alias("score"), F.col("b.hd").alias("h")).where("score >= -0.1")
    return best(pairs, ["page_id", "rk"], [F.col("score").desc(), F.col("item_no")]).select("page_id", "rk", "h.*")


# Words that keep a line from being a title, that mark a credit or a name, and that mark a title.
LINE_NOISE = ("bak", "oğlum", "doktoraya", "işletme", "mezunuyum", "gezegenimize", "yükselt", "hazırlan", "yürüyün", "koku", "saçtınız", "sevgili arkadaşlar", "listedeki", "her sırada", "bulduğunuz", "işlemine", "yerleştirin", "bütün fazla")
NAMES = ("mustafa", "kocabaş", "kocabas")
TITLES = ("bulmaca", "kelime", "mini", "sayı", "yerleştirme", "hayvanat", "bahçesi", "sıska", "sıtki", "sitki", "uzayda", "ortaya", "karışık", "karisik", "çengel", "haylaz", "kar tanesi", "labirent", "nokta birleştirme", "birleştirme", "etkinlik", "yapboz", "boyama")
MIXED = r"(?iuU)\bOrtaya\s+[A-Za-zÇĞİÖŞÜçğıöşü]{0,3}t[A-Za-zÇĞİÖŞÜçğıöşü]*s[A-Za-zÇĞİÖŞÜçğıöşü]*k\b"
SERIES, SERIES_CREDIT, SERIES_NAME, MIXED_TITLE = "SISKA SITKI UZAYDA", "Yazan ve Çizen Mustafa Kocabaş", "Mustafa Kocabaş", "Ortaya Karışık"


def norm_piece(text: Column) -> Column:
    """A line's text with the known series and names in their usual form and without small numbers."""
    s = F.regexp_replace(t.squeezed(text), r"(?iuU)\bKocabas\b", "Kocabaş")
    s = F.regexp_replace(F.regexp_replace(s, MIXED, MIXED_TITLE), r"(?iuU)\bOrtaya\s+karisik\b", MIXED_TITLE)
    return t.squeezed(F.regexp_replace(s, r"(?U)\b[0-9]{1,2}\b", ""))


def line_roles(regions: DataFrame, lines: DataFrame, w: int, h: int) -> DataFrame:
    """(page_id, rk, line_no, y, x, text, is_title, is_byline): lines by the top of a region, on its half or under it."""
    a, b = regions.alias("a"), lines.where("confidence >= 0.55").withColumn("clean", t.squeezed(F.col("text"))).where("clean <> '' and length(clean) <= 120").alias("b")
    x, y = Box.of("a"), Box.of("b")
    tall = F.greatest(F.lit(1), x.height)
    right = x.cx > w / 2.0
    left_end, right_end = F.when(right, w / 2.0).otherwise(0.0), F.when(right, float(w)).otherwise(w / 2.0)
    over = F.greatest(F.lit(0), F.least(x.x2, y.x2) - F.greatest(x.x1, y.x1)) / F.greatest(F.lit(1), y.width).cast("double")
    near = (y.y1 <= F.least(F.lit(h), whole(x.y1 + 0.45 * tall))) & (y.y1 >= F.greatest(F.lit(0), whole(x.y1 - 0.03 * h)))
    joined = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & near & (y.cx.between(left_end, right_end) | (over >= 0.2)))
    joined = joined.select(F.col("a.page_id").alias("page_id"), F.col("a.rk").alias("rk"), "b.line_no", y.y1.alias("y"), y.x1.alias("x"), F.col("b.clean").alias("text"), ((y.y1 - x.y1) / tall.cast("double")).alias("depth"), whole(x.y1 + 0.22 * tall).alias("to_plain"), whole(x.y1 + 0.30 * tall).alias("to_known"), ((y.cx - left_end) / F.greatest(F.lit(1.0), right_end - left_end)).alias("across"))
    s = F.col("text")
    credit = t.contains_any(s, t.CREDITS) | t.contains_any(s, NAMES)
    known = t.contains_any(s, TITLES)
    n = F.size(t.words_of(F.regexp_replace(s, r"(?U)\S+@\S+", " ")))
    plain = (F.col("y") <= F.col("to_plain")) & n.between(2, 8) & ~s.rlike("[.!?;:…]")
    title = ~credit & ~t.contains_any(s, LINE_NOISE) & (t.digits(s) < 2) & F.when(known, F.col("y") <= F.col("to_known")).otherwise(plain)
    words = t.words_of(s)
    named = F.size(words).between(2, 4) & (t.digits(s) == 0) & (F.col("across") >= 0.64) & (F.col("y") <= round(h * 0.18)) & (F.size(F.filter(words, lambda v: v.rlike(r"^\p{Lu}.+"))) >= 2)
    return joined.select("page_id", "rk", "line_no", "y", "x", "text", title.alias("is_title"), (credit | named).alias("is_byline"))


def line_titles(regions: DataFrame, lines: DataFrame, w: int, h: int) -> DataFrame:
    """(page_id, rk, title, byline, full): a title of up to three lines and a byline of up to two of each region, if they look like a headline."""
    rows = line_roles(regions, lines, w, h)
    order = F.struct("y", "x", "line_no", norm_piece(F.col("text")).alias("t"))
    first = lambda flag, most: F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col(flag), order))), 1, most), lambda v: v["t"]), " ")
    heads = rows.groupBy("page_id", "rk").agg(first("is_title", 3).alias("title"), first("is_byline", 2).alias("byline")).join(regions.select("page_id", "rk", "visual_class"), ["page_id", "rk"])
    heads = heads.withColumn("title", t.squeezed(F.regexp_replace("title", r"(?U)\b\d+\b", ""))).withColumn("byline", t.squeezed(F.col("byline")))
    tail = (F.col("byline") != "") & F.lower("title").endswith(F.lower("byline"))
    heads = heads.withColumn("title", F.when(tail, F.btrim(F.expr("substring(title, 1, length(title) - length(byline))"))).otherwise(F.col("title")))
    said = lambda c: F.contains(F.lower(c), F.lit(SERIES_NAME.lower()))
    heads = heads.withColumn("title", F.when(said(F.col("title")) & said(F.col("byline")), t.squeezed(F.regexp_replace("title", r"(?iuU)\bmustafa kocaba[şs]\b", ""))).otherwise(F.col("title")))
    low = F.lower(F.concat_ws(" ", "title", "byline"))
    has = lambda *ks: t.contains_any(F.col("low"), ks)
    heads = heads.withColumn("low", low)
    series = has("siska", "sıska") & has("sitki", "sıtki") & has("uzayda")
    mixed = has("ortaya") & has("karışık", "karisik", "mustafa", "hazırlayan")
    by = F.when(mixed & has("mustafa") & has("kocaba"), SERIES_NAME).when(series & has("mustafa") & has("kocaba") & has("yazan", "çizen"), SERIES_CREDIT).otherwise(F.col("byline"))
    heads = heads.select("page_id", "rk", "visual_class", F.when(mixed, MIXED_TITLE).when(series, SERIES).otherwise(F.col("title")).alias("title"), by.alias("byline")).withColumn("full", t.squeezed(F.concat_ws(" ", "title", "byline")))
    panel = F.col("visual_class").isin(*t.PANEL_PAGES)
    credited = t.contains_any(F.col("full"), (*t.CREDITS, "kocabaş", "mustafa"))
    most_words, most_chars = F.when(panel, 5).otherwise(4), F.when(panel, 64).otherwise(42)
    alpha = F.regexp_count("full", F.lit(r"\p{L}"))
    heads = heads.where((alpha >= 8) & (t.digits(F.col("full")) <= alpha)).withColumn("credited", credited)
    short = F.array_join(F.slice(t.words_of(F.col("full")), F.lit(1), most_words), " ")
    long = ~F.col("credited") & ((F.size(t.words_of(F.col("full"))) > most_words) | (F.length("full") > most_chars))
    heads = heads.withColumn("short", F.when(long, short)).where("short is null or length(short) >= 6")
    heads = heads.withColumn("title", F.when(F.col("short").isNotNull() & (F.col("title") == ""), F.col("short")).otherwise(F.col("title"))).withColumn("full", F.coalesce("short", "full"))
    fine = F.col("credited") | ((~panel | t.contains_any(F.col("full"), TITLES)) & (F.size(t.words_of(F.col("title"))) >= 2) & ~t.contains_any(F.col("full"), LINE_NOISE))
    cut = lambda c, n: F.substring(c, 1, n).alias(c)  # noqa: E731  the reference's lengths of headline fields
    return heads.where(fine).select("page_id", "rk", cut("title", 140), cut("byline", 140), cut("full", 220))


def choose(candidates: list[DataFrame], regions: DataFrame, group: DataFrame | None = None) -> DataFrame:
    """(page_id, rk, title, byline, full): the best scored headline of each region; of equals that of the first source.

    group: those of logical groups, which replace a panel's headline that reads like body text.
    """
    pool = None
    for n, c in enumerate(candidates):
        c = c.withColumn("source", F.lit(n))
        pool = c if pool is None else pool.unionByName(c)
    rows = pool.join(regions.select("page_id", "rk", "visual_class"), ["page_id", "rk"])
    rows = rows.where("full <> ''").withColumn("score", t.headline_score(F.col("full"), F.col("byline"), F.col("visual_class")))
    kept = best(rows, ["page_id", "rk"], [F.col("score").desc(), F.col("source")])
    if group is not None:
        # a panel's headline that reads like body text gives way to that of its group
        other = group.select("page_id", "rk", F.struct("title", "byline", "full").alias("g"))
        kept = kept.join(other, ["page_id", "rk"], "left")
        spoken = lambda c: F.lower(c).rlike(r"(?U)[!?]|,\s|\.\s")
        sound = t.has_structural_signal(F.col("g.full"), F.col("g.byline"), F.col("visual_class")) & ~t.is_body_sentence(F.col("g.full"))
        swap = F.col("visual_class").isin(*t.PANEL_PAGES) & (F.coalesce(F.col("g.full"), F.lit("")) != "") & ((t.is_body_sentence(F.col("full")) & sound) | (spoken(F.col("full")) & ~spoken(F.col("g.full"))))
        kept = kept.select("page_id", "rk", "visual_class", *[F.when(swap, F.col(f"g.{c}")).otherwise(F.col(c)).alias(c) for c in ("title", "byline", "full")])
    kept = kept.where(t.is_structural_headline(F.col("full"), F.col("byline"), F.col("visual_class")))
    fixed = [F.regexp_replace(c, MIXED, MIXED_TITLE).alias(c) for c in ("title", "full")]
    kept = kept.select("page_id", "rk", "visual_class", "byline", *fixed)
    return kept.select("page_id", "rk", t.sanitized(F.col("title"), F.col("byline"), F.col("full"), F.col("visual_class")).alias("h")).select("page_id", "rk", "h.*")


def repeated_title(full: Column, byline: Column, visual_class: Column, keys: list[str], order: list[str]) -> Column:
    """Whether a panel's title without a byline was already given to an earlier panel of the page."""
    norm = t.squeezed(F.lower(full))
    place = F.row_number().over(W.partitionBy(*keys, norm).orderBy(*order))
    return (norm != "") & (place > 1) & visual_class.isin(*t.PANEL_PAGES) & (byline == "")
