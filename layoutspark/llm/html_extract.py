"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read once, in time linear in its length whatever its markup: elements that HTML closes by itself are closed,
scripts, styles and other unrendered elements (by name, a `hidden` attribute or display:none in their style) are
passed over, character references are decoded; a tag that the page doesn't end is no text, as in browsers. Each stretch
of text between block boundaries is a leaf block. Its features are the tags and the words in class, id and role of its ancestors, and its
own text (length, links, end, marks). The chain has two labels, main text or not; its weights are trained on labelled
pages (`labelled_pages`) by gradient steps on the exact likelihood, and Viterbi decodes the best sequence. The
main text is the blocks of that label, in page order, joined by one space.

Null and empty html give the empty text, an empty table no rows. Repeated pages and ids are rows like others. Nothing
is capped or cut: a long page is held whole in memory, the pages of a batch in pieces. Of two best label sequences the
one with fewer main blocks from the end wins. Only id, url and html are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .labelled_pages import labelled_pages

STEPS, RIDGE, RATE = 120, 0.3, 0.2

# Element names of HTML by how a parser treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNRENDERED = frozenset("script style template noscript noframes noembed iframe svg object canvas audio video head title xmp".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An element that begins closes an open one of these, unless one of the walls lies between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set())}
P_WALLS = ("button", "table", "td", "th", "li", "div", "section", "article", "aside")
#: Words in class, id and role that sites use, by what they name.
HINTS = {
    "ad": "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner",
    "comment": "comment comments commentlist reply replies respond discussion disqus reactions responses",
    "side": "sidebar side aside widget widgets related recommended recommendations more popular trending rail complementary",
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal newsletter subscribe subscription overlay warning message toast",
    "foot": "footer foot copyright legal colophon bottom contentinfo",
    "head": "header masthead topbar top branding logo banner site",
    "nav": "nav navigation navbar menu menus breadcrumb breadcrumbs toc pagination pager links",
    "share": "share sharing social follow tools toolbar actions",
    "form": "form login signin search signup contact register",
    "main": "article articles content main post entry story body text page",
}
_hint_of: dict[str, list[str]] = {}
for _name, _words in HINTS.items():
    for _word in _words.split():
        _hint_of.setdefault(_word, []).append(_name)

_name = re.compile(r"[a-zA-Z][^\s/>]*")
_to_value = re.compile(r"[^>=]*")
_spaces = re.compile(r"\s*")
_named = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_attribute = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
_maybe_hidden = re.compile(r"hidden|style", re.I)
_style_parts = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\((?:[^()"']|"[^"]*"|'[^']*')*\)""", re.S)
_no_display = re.compile(r"\s*none\s*(?:!\s*important\s*)?", re.I)
_split = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Above:
    """What the ancestors of a block give it: the features that one of them is the first to have, and the ancestors of that one."""

    __slots__ = ("own", "up")

    def __init__(self, own: tuple[str, ...], up: Above | None):
        self.own, self.up = own, up


@dataclass
class Block:
    text: str
    own: tuple[str, ...]
    above: Above | None

    @property
    def features(self) -> tuple[str, ...]:
        chain, at = [], self.above
        while at:
            chain.append(at.own)
            at = at.up
        return (*self.own, *(f for own in reversed(chain) for f in own))


def _frame_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The features that an element gives to the blocks in it."""
    out = [f"in:{tag}"]
    if attributes:
        for m in _named.finditer(attributes):
            for word in _split.findall(m[1] or m[2] or m[3] or ""):
                word = word.lower()
                out.append(f"word:{word}")
                out += [f"hint:{h}" for h in _hint_of.get(word, ())]
    return tuple(dict.fromkeys(out))


_known_frame = lru_cache(8192)(_frame_of)


def _frame(tag: str, attributes: str) -> tuple[str, ...]:
    return _known_frame(tag, attributes) if len(attributes) + len(tag) < 200 else _frame_of(tag, attributes)


def _hidden(attributes: str) -> bool:
    """Whether an element isn't rendered: a `hidden` attribute (not until-found), or display:none in its style."""
    if not _maybe_hidden.search(attributes):
        return False
    seen: dict[str, str] = {}
    for m in _attribute.finditer(attributes):
        seen.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))  # the first of a name holds
    if "hidden" in seen and unescape(seen["hidden"]).strip().lower() != "until-found":
        return True
    display, held = "", False
    for declared in _style_parts.sub(lambda m: " " if m[0].startswith("/*") else "_", unescape(seen.get("style", ""))).split(";"):
        name, _, value = declared.partition(":")
        if name.strip().lower() == "display":
            important = value.lower().replace(" ", "").endswith("!important")
            if important or not held:  # the last holds, but for an important one
                display, held = value, important
    return bool(_no_display.fullmatch(display))


def _own(text: str, linked: int, tag: str) -> list[str]:
    words = text.count(" ") + 1
    share = linked / len(text)
    out = ["all", f"tag:{tag}", f"words:{min(6, words.bit_length())}", "links:" + ("none" if not linked else "all" if share > 0.8 else "half" if share > 0.3 else "some")]
    if text[-1] in ".!?…\"»”":
        out.append("ends")
    if "©" in text or "·" in text or "|" in text or "»" in text[:2]:
        out.append("marks")
    if text[0].islower():
        out.append("low")
    if sum(map(str.isdigit, text)) * 4 > len(text):
        out.append("digits")
    return out


def _tag_end(html: str, at: int, last_quote: dict[str, int]) -> int:
    """Where the tag whose attributes begin at `at` has its `>`, -1 if it has none. A quoted value may hold one; a quote that nothing closes is a letter."""
    while True:
        at = _to_value.match(html, at).end()
        if at >= len(html):
            return -1
        if html[at] == ">":
            return at
        at = _spaces.match(html, at + 1).end()  # behind the equals sign
        quote = html[at : at + 1]
        if quote and quote in last_quote and last_quote[quote] > at:
            at = html.index(quote, at + 1) + 1


class Elements:
    """The open elements of a page, with what is asked of them in constant time."""

    def __init__(self):
        self.open: list[tuple[str, tuple[str, ...], bool, str, Above | None]] = []  # tag, features, passed over, block tag, above
        self.places: dict[str, list[int]] = {}
        self.seen: dict[str, int] = {}  # how many open elements have a feature
        self.passed = 0

    def push(self, tag: str, features: tuple[str, ...], passed: bool) -> None:
        new = tuple(f for f in features if not self.seen.get(f))
        for f in features:
            self.seen[f] = self.seen.get(f, 0) + 1
        above = Above(new, self.above) if new else self.above
        block = self.block if tag in INLINE else tag
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, features, passed, block, above))
        self.passed += passed

    def pop(self) -> None:
        tag, features, passed, _, _ = self.open.pop()
        self.places[tag].pop()
        for f in features:
            self.seen[f] -= 1
        self.passed -= passed

    @property
    def above(self) -> Above | None:
        return self.open[-1][4] if self.open else None

    @property
    def block(self) -> str:
        return self.open[-1][3] if self.open else "none"

    def place(self, tag: str) -> int:
        """Of the innermost open element of the name; -1 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def innermost(self, tags) -> int:
        return max((self.place(t) for t in tags), default=-1)


def leaf_blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in page order, each with its features."""
    blocks: list[Block] = []
    els = Elements()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(unescape("".join(text)).split())
            text.clear()
            if whole:
                blocks.append(Block(whole, tuple(_own(whole, min(linked, len(whole)), els.block)), els.above))
        linked = 0

    def pop_to(i: int) -> None:
        if any(x[0] not in INLINE for x in els.open[i:]):
            flush()
        while len(els.open) > i:
            els.pop()

    def close(closed, walls) -> None:
        i = els.innermost(closed)
        if i >= 0 and i > els.innermost(walls):
            pop_to(i)

    def say(a: int, b: int) -> None:
        nonlocal linked
        if b > a and not els.passed:
            text.append(html[a:b])
            if els.places.get("a"):
                linked += b - a

    at, end = 0, len(html)
    lowered = None
    last_quote = {q: html.rfind(q) for q in "\"'"}
    while at < end:
        start = html.find("<", at)
        if start < 0:
            say(at, end)
            break
        say(at, start)
        at = start
        if html.startswith("<!--", at):
            stop = html.find("-->", at + 2)
            at = end if stop < 0 else stop + 3
            continue
        if html.startswith("<![CDATA[", at):
            stop = html.find("]]>", at)
            stop = end if stop < 0 else stop
            if not els.passed:
                text.append(html[at + 9 : stop].replace("&", "&amp;"))
            at = stop + 3
            continue
        if html[at + 1 : at + 2] in ("!", "?"):
            stop = html.find(">", at)
            at = end if stop < 0 else stop + 1
            continue
        closing = html.startswith("/", at + 1)
        named = _name.match(html, at + 1 + closing)
        if not named:
            say(at, at + 1)
            at += 1
            continue
        stop = _tag_end(html, named.end(), last_quote)
        if stop < 0:
            break
        tag, attributes = named[0].lower(), html[named.end() : stop]
        at = stop + 1
        if closing:
            i = els.place(tag)
            if tag == "p" and i < 0 or tag == "br":
                flush()
            elif i >= 0:
                pop_to(i)
            continue
        if tag in CLOSES_P:
            close(("p",), P_WALLS)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag not in INLINE:
            flush()
        if tag in VOID or attributes.endswith("/") and tag in ("path", "circle", "rect", "use"):
            continue
        passed = tag in UNRENDERED or (bool(attributes) and _hidden(attributes))
        if tag in RAW:
            if lowered is None:
                lowered = html.lower()
                if len(lowered) != end:  # a letter's lower case may be longer
                    lowered = "".join(c.lower() if c < "\x80" else c for c in html)
            shut = lowered.find(f"</{tag}", at)
            if tag == "textarea" and not els.passed:
                text.append(html[at : shut if shut >= 0 else end])
                els.push(tag, _frame(tag, attributes), False)
                pop_to(len(els.open) - 1)
            stop = html.find(">", shut) if shut >= 0 else -1
            at = end if stop < 0 else stop + 1
            continue
        els.push(tag, _frame(tag, attributes), passed)
    pop_to(0)
    flush()
    return blocks


@dataclass
class Chain:
    """Weights per feature and label, and of label to label; the label before the first is 2."""

    place: dict[str, int]
    state: np.ndarray
    step: np.ndarray

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: whether each block is main text in the best sequence."""
        place, state = self.place, self.state_rows
        (t00, t01), (t10, t11) = self.step_rows[:2]
        back: list[tuple[int, int]] = []
        s0, s1 = 0.0, 0.0

        def add(features: tuple[str, ...], e: tuple[float, float]) -> tuple[float, float]:
            e0, e1 = e
            for f in features:
                i = place.get(f)
                if i is not None:
                    w = state[i]
                    e0 += w[0]
                    e1 += w[1]
            return e0, e1

        given: dict[Above | None, tuple[float, float]] = {None: (0.0, 0.0)}  # each ancestor adds up once
        for n, b in enumerate(blocks):
            at, todo = b.above, []
            while at not in given:
                todo.append(at)
                at = at.up
            for at in reversed(todo):
                given[at] = add(at.own, given[at.up])
            e0, e1 = add(b.own, given[b.above])
            if not n:
                s0, s1 = self.step_rows[2][0] + e0, self.step_rows[2][1] + e1
                continue
            a, b_, c, d = s0 + t00, s1 + t10, s0 + t01, s1 + t11
            back.append((int(b_ > a), int(d > c)))
            s0, s1 = max(a, b_) + e0, max(c, d) + e1
        label = int(s1 > s0)
        out = [label]
        for pointers in reversed(back):
            label = pointers[label]
            out.append(label)
        return [bool(x) for x in reversed(out)] if blocks else []

    def __post_init__(self):
        self.state_rows = [tuple(x) for x in self.state.tolist()]
        self.step_rows = self.step.tolist()


def train(pages: Iterable[tuple[list[Block], list[bool]]], steps: int = STEPS) -> Chain:
    """Weights of greatest penalised likelihood, by gradient steps with exact expectations (forward and backward)."""
    pages = [p for p in pages if p[0]]
    place: dict[str, int] = {}
    rows, cols = [], []
    longest, n = max(len(b) for b, _ in pages), len(pages)
    gold = np.full((n, longest), -1)
    for i, (blocks, labels) in enumerate(pages):
        gold[i, : len(blocks)] = labels
        for j, b in enumerate(blocks):
            for f in b.features:
                rows.append(i * longest + j), cols.append(place.setdefault(f, len(place)))
    rows, cols = np.array(rows), np.array(cols)
    state, step = np.zeros((len(place), 2)), np.zeros((3, 2))
    real = gold >= 0
    seen_state = np.stack([np.bincount(cols, (gold.ravel()[rows] == k).astype(float), minlength=len(place)) for k in (0, 1)], 1)
    seen_step = np.zeros((3, 2))
    np.add.at(seen_step, (2, gold[:, 0]), 1)
    both = real[:, 1:]
    np.add.at(seen_step, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    moments = [np.zeros_like(x) for x in (state, state, step, step)]
    for t in range(1, steps + 1):
        score = np.stack([np.bincount(rows, state[cols, k], minlength=n * longest) for k in (0, 1)], 1).reshape(n, longest, 2)
        forward = np.zeros((n, longest, 2))
        forward[:, 0] = step[2] + score[:, 0]
        for j in range(1, longest):
            new = np.logaddexp(forward[:, j - 1, :1] + step[0], forward[:, j - 1, 1:] + step[1]) + score[:, j]
            forward[:, j] = np.where(real[:, j, None], new, forward[:, j - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        backward = np.zeros((n, longest, 2))
        expected_step = np.zeros((3, 2))
        for j in range(longest - 1, 0, -1):
            after = score[:, j] + backward[:, j]
            pair = np.exp(forward[:, j - 1, :, None] + step[None, :2] + after[:, None, :] - total[:, None, None]) * real[:, j, None, None]
            expected_step[:2] += pair.sum(0)
            new = np.logaddexp(step[:2, 0] + after[:, :1], step[:2, 1] + after[:, 1:])
            backward[:, j - 1] = np.where(real[:, j, None], new, backward[:, j])
        share = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        expected_step[2] = share[:, 0].sum(0)
        flat = share.reshape(-1, 2)
        expected = np.stack([np.bincount(cols, flat[rows, k], minlength=len(place)) for k in (0, 1)], 1)
        for x, slope, m, v in ((state, expected - seen_state + RIDGE * state, *moments[:2]), (step, expected_step - seen_step + RIDGE * step, *moments[2:])):
            m *= 0.9
            m += 0.1 * slope
            v *= 0.99
            v += 0.01 * slope**2
            x -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Chain(place, state, step)


@lru_cache(1)
def default_chain() -> Chain:
    """Trained on the labelled pages that come with the operator."""
    pages = []
    for parts in labelled_pages():
        blocks, labels = [], []
        for html, main in parts:
            blocks.append(html), labels.append(main)
        pages.append(align("".join(blocks), list(zip(blocks, labels))))
    return train(pages)


#: Stand for the labels in a page while it is cut into blocks.
MAIN, OTHER = "\ue000", "\ue001"


def align(html: str, parts: list[tuple[str, bool]]) -> tuple[list[Block], list[bool]]:
    """The blocks of a page whose source is given in labelled parts: a mark in front of each text tells its part's label."""
    marked = "".join(re.sub(r"(>)([^<]*[^<\s][^<]*)", lambda m, k=MAIN if main else OTHER: m[1] + k + m[2], part) for part, main in parts)
    blocks, labels = [], []
    for b in leaf_blocks(marked):
        clean = b.text.replace(MAIN, "").replace(OTHER, "").strip()
        if clean:
            labels.append(MAIN in b.text)
            blocks.append(clean)
    plain = leaf_blocks(html)
    if [b.text for b in plain] != [" ".join(x.split()) for x in blocks]:
        raise ValueError("a labelled page must cut into the same blocks with and without marks")
    return plain, labels


def main_text(html: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(html or "")
    return " ".join(b.text for b, keep in zip(blocks, chain.decode(blocks)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chain: Chain | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of pages."""
    model = pages.sparkSession.sparkContext.broadcast(chain or default_chain())

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h, model.value) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
