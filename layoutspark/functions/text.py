"""Text rules as Column expressions. Patterns are Unicode-aware; lists of words are fixed values."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Classification

# Letters, and words that mark titles, credits, bodies and noise.
LETTER = "[A-Za-zÇĞİÖŞÜçğıöşü]"
STRUCTURAL = (
    "bulmaca", "kelime", "mini", "sayı", "yerleştirme", "hayvanat", "bahçesi", "siska", "sıska", "sitki", "sıtki", "uzayda", "ortaya", "karışık", "karisik", "hadis", "hikmetli", "soru", "cevap",
    "fazla harfler", "çengel", "haylaz", "kar tanesi", "labirent", "nokta birleştirme", "birleştirme", "yapboz", "boyama", "etkinlik",
)
CREDITS = ("yazan", "çizen", "hazırlayan", "resimleyen")
BODY = ("için", "ve", "ile", "ama", "çünkü", "sonra", "üzere", "gibi", "böyle", "şöyle", "der", "dedi", "diyor", "verir", "olur", "oldu", "sorar", "yardımcı", "ulaşmak", "yapmak", "gitmek")
NOISY = ("sevgili arkadaşlar", "listedeki", "bulduğunuz", "işlemine", "yerleştirin", "her sırada", "gezegenimize", "dünyalılar", "bekli", "isterseniz")
TITLE_REPAIRS = (
    (("hawanat", "haywanat", "hayanat"), "Hayvanat Bahçesi"),
    (("kelime avi", "kelime avı"), "Kelime Avı"),
    (("mini kare",), "Mini Kare"),
    (("sayı yerleştirme", "sayi yerlestirme"), "Sayı Yerleştirme"),
)
PANEL_PAGES = ("puzzle_page", "comic_panel_page", "activity_page")


def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFKC", t) if t is not None else None)


def nfkc(text: Column) -> Column:
    """Compatibility composition; Spark has no function for it, so text that isn't plain ASCII goes through Arrow."""
    return F.pandas_udf(_composed, "string")(text)


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def untagged(text: Column) -> Column:
    """Without markup, white space squeezed."""
    return squeezed(F.regexp_replace(text, "<[^>]+>", " "))


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body(x) with x as a variable: however often body uses it, the plan has its expression once."""
    return F.element_at(F.transform(F.array(x), body), 1)


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(rf"\Q{k}\E" for k in words))


def words_of(text: Column) -> Column:
    return F.filter(F.split(squeezed(text), " "), lambda w: w != "")


#: The steps that clean recognised text after composition, in their order.
CLEANING = (
    (r"<[^>]+>", " "),
    (r"\s+", " "),
    (r"^ | $", ""),
    (rf"\b({LETTER})\s+([a-zçğıöşü])", "$1$2"),  # letters split from their word
    (r" ([,.!?;:])", "$1"),
    (r"\s+'\s*", "'"),
    (r"%\s+(\d)", "%$1"),
    (r"(?i)\b(\w+)\s+\1\b", "$1"),  # a word said twice
    (r"- ", ""),
    (r"\s{2,}", " "),
    (r"^ | $", ""),
)


def clean_ocr(text: Column, normalize: bool = True) -> Column:
    """Recognised text cleaned; `normalize` composes it first, in Python."""
    s = F.coalesce(text, F.lit(""))
    s = nfkc(s) if normalize else s
    for pattern, new in CLEANING:
        s = F.regexp_replace(s, f"(?U){pattern}".replace("(?U)(?i)", "(?iuU)"), new)
    return s


def clean_ocr_text(text: str) -> str:
    """The same for one text, for functions that see a page at a time."""
    s = unicodedata.normalize("NFKC", text or "")
    for pattern, new in CLEANING:
        s = re.sub(pattern, new.replace("$", "\\"), s)
    return s


def surely_longer(text: str, chars: int) -> bool:
    """Whether the cleaned text has more characters for certain, without cleaning it.

    Cleaning plain ASCII without markup drops white space, hyphens and words said twice, and joins a letter to the word
    behind it; so of its different words of two letters or more at least every other one stays.
    """
    head = text[:400]
    if not head.isascii() or "<" in head:
        return False
    return sum(map(len, {w.lower() for w in re.findall(r"\w\w+", head)[:-1]})) > 4 * chars


def letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LETTER))


def digits(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\d"))


def is_title_pattern(first: Column, rest_chars: Column, cfg: Classification = Classification()) -> Column:
    """A first line that reads like a title: a delimiter or a word in capitals, short, with text after it."""

    def rule(s: Column) -> Column:
        capital = F.exists(F.split(s, " "), lambda t: (F.length(t) >= 3) & (t == F.upper(t)) & (t != F.lower(t)))
        fits = (s != "") & (F.length(s) <= cfg.prefix_title_pattern_max_chars) & (letters(s) >= cfg.headline_min_alpha_chars)
        return fits & (s.rlike("[/:]") | capital)

    return (rest_chars >= cfg.prefix_title_pattern_min_rest_chars) & let(squeezed(first), rule)


def is_headline_pattern(text: Column) -> Column:
    def rule(s: Column, n: Column) -> Column:
        return (s != "") & n.between(2, 10) & ~s.rlike("(?s)[.!?]$") & ~(F.contains(s, F.lit(":")) & (n <= 4)) & (F.contains(s, F.lit("/")) | (F.regexp_count(s, F.lit("[,:;]")) <= 1))

    return let(squeezed(text), lambda s: let(F.size(words_of(s)), lambda n: rule(s, n)))


def is_dialogue(text: Column) -> Column:
    """Starts with a dash, stands in quotes, or is a short sentence with a comma or dots."""

    def rule(s: Column) -> Column:
        quoted = s.rlike("(?s)^[“\"'‘]") & s.rlike("(?s)[”\"'’]$")
        spoken = (F.length(s) <= 90) & (s.endswith(".") | s.endswith("!") | s.endswith("?")) & (F.contains(s, F.lit(",")) | F.contains(s, F.lit("...")))
        return (s != "") & (s.rlike(r"(?U)^[-–—]\s*\w+") | quoted | spoken)

    return let(squeezed(text), rule)


def is_reasonable_headline(text: Column) -> Column:
    def rule(s: Column) -> Column:
        lower = let(F.regexp_extract(s, f"({LETTER})", 1), lambda first: (first != "") & (F.lower(first) == first))
        return (s != "") & ~lower & ((F.size(words_of(s)) >= 2) | s.rlike("^[A-ZÇĞİÖŞÜ0-9]{3,}$"))

    return let(squeezed(text), rule)


def normalized_title(text: Column) -> Column:
    """Without markup and mail addresses; known titles in their usual form."""

    def rule(s: Column) -> Column:
        out = s
        for words, title in reversed(TITLE_REPAIRS):
            out = F.when(contains_any(s, words), title).otherwise(out)
        return out

    return let(squeezed(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " "), r"(?U)\S+@\S+", " ")), rule)


def _broken(text: Column) -> Column:
    return text.rlike(r"(?U)[!?]|,\s|:\s|;\s|\.\s")


def _trimmed(text: Column, body: Callable[[Column], Column]) -> Column:
    return let(F.trim(F.coalesce(text, F.lit(""))), body)


def is_body_sentence(text: Column) -> Column:
    return _trimmed(text, lambda s: (s != "") & ~contains_any(s, STRUCTURAL) & (_broken(s) | (F.size(words_of(s)) >= 6) | contains_any(s, BODY)))


def has_structural_signal(full: Column, byline: Column, visual_class: Column) -> Column:
    def rule(s: Column) -> Column:
        alpha, upper = F.regexp_count(s, F.lit(r"\p{L}")), F.regexp_count(s, F.lit(r"\p{Lu}"))
        loud = visual_class.isin(*PANEL_PAGES) & (F.size(words_of(s)) <= 3) & let(alpha, lambda n: (n >= 6) & (upper >= F.greatest(F.lit(2), F.floor(0.45 * n))))
        return (s != "") & ((byline != "") | contains_any(s, STRUCTURAL) | loud)

    return _trimmed(full, rule)


def is_structural_headline(full: Column, byline: Column, visual_class: Column) -> Column:
    asked = visual_class.isin("framed_photo", "background_photo_page", *PANEL_PAGES)
    return _trimmed(full, lambda s: (s != "") & (~asked | (byline != "") | contains_any(s, STRUCTURAL)))


def headline_score(full: Column, byline: Column, visual_class: Column) -> Column:
    part = lambda condition, value: F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    def rule(s: Column, n: Column) -> Column:
        total = part(byline != "", 1.5) + part(contains_any(s, STRUCTURAL), 1.2) + part(contains_any(s, NOISY), -1.2) + part(_broken(s) & (byline == ""), -1.0)
        total = total + part(n == 2, 0.25) + part(n <= 5, 0.5) + part(n > 9, -1.0) + part(visual_class.isin(*PANEL_PAGES), 0.2)
        return F.when(s == "", F.lit(-1.0)).otherwise(total)

    return _trimmed(full, lambda s: let(F.size(words_of(s)), lambda n: rule(s, n)))


def title_and_byline(text: Column) -> Column:
    """struct(title, byline, full): split at the first credit."""
    three = lambda a, b, c: F.struct(a.alias("title"), b.alias("byline"), c.alias("full"))
    credit = r"(?iuU)\b(yazan|çizen|hazırlayan|resimleyen)\b"

    def rule(s: Column, at: Column) -> Column:
        title = F.btrim(F.substring(s, F.lit(1), at - 1), F.lit(" -,:;"))
        byline = F.trim(F.substring(s, at, F.length(s)))
        return F.when(at > 0, three(title, byline, F.trim(F.concat_ws(" ", title, byline)))).otherwise(three(s, F.lit(""), s))

    return let(normalized_title(text), lambda s: let(F.regexp_instr(s, F.lit(credit)), lambda at: rule(s, at)))


def sanitized(title: Column, byline: Column, full: Column, visual_class: Column) -> Column:
    """struct(title, byline, full), all empty where the text isn't a headline."""
    most = F.when(visual_class.isin(*PANEL_PAGES), 5).otherwise(6)

    def rule(x: Column) -> Column:
        good = has_structural_signal(x["full"], x["byline"], visual_class) & ((x["byline"] != "") | (F.size(words_of(x["full"])) <= most))
        empty = F.struct(*[F.lit("").alias(c) for c in ("title", "byline", "full")])
        return F.when(good, x).otherwise(empty)

    return let(F.struct(normalized_title(title).alias("title"), normalized_title(byline).alias("byline"), normalized_title(full).alias("full")), rule)
