"""Each operator against a brute-force version on odd rows, on no rows, and without labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layoutspark.llm import exact_dedup, html_extract, language_id, mixing, ngram_join, packing, quality_classifier, quality_rules, suffix_dedup, toxicity
from layoutspark.llm.components import components
from layoutspark.llm.labelled_pages import labelled_pages

from .conftest import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1: quality rules ----------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORD.search(line))
        seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_rules_counts_are_exact(odd, odd_rows, labels):
    found = quality_rules.quality_rules(odd, labels).collect()
    expected = Counter((d, *base_counts(t)) for d, t, *_ in odd_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_rules_without_rows_or_labels(odd, none, labels, no_labels):
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert all(r.kept != r.base_failed for r in quality_rules.quality_rules(odd, no_labels).collect())


def test_isolation_forest_finds_the_odd_ones():
    r = np.random.default_rng(1)
    x = np.vstack([r.normal(size=(500, 4)), r.normal(6, 1, size=(8, 4))])
    good = np.arange(508) < 500
    forest = quality_rules.grow(x)
    scores = forest.score(x)
    cut = quality_rules.calibrate(scores, good, 5)
    assert (scores[~good] > cut).mean() > 0.8 and (scores[good] > cut).mean() < 0.02
    assert quality_rules.calibrate(scores, np.ones(508, bool)) == np.inf


def test_keep_good_keeps_columns(odd, labels):
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in quality_rules.quality_rules(odd, labels).collect() if r.kept)


def thue_morse(n, letters):
    text = letters[0]
    while len(text) < n:
        text += text.translate(str.maketrans(letters, letters[::-1]))
    return text


def test_words_are_told_apart_by_their_bytes():
    """Polynomial hashes take these two words for one; here neither hashes nor windows do, even if all hashes are equal."""
    from layoutspark.llm import common, stats

    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    texts = pa.array([f"1 2 3 4 5 6 7 {a} x y 1 2 3 4 5 6 7 {b}", f"{a} {b} {a}", None, ""])
    w = common.words(texts)
    assert len(set(w.hashes().tolist())) == len({w.bytes_of(i) for i in range(len(w.start))})
    assert stats.text_stats(texts)[0]["n_repeat_words"].tolist() == [0, 0, 0, 0]
    ids = w.ids(np.zeros(len(w.start), np.uint64))
    assert len(set(zip(ids.tolist(), (w.bytes_of(i) for i in range(len(ids)))))) == len(set(ids.tolist())) == 11
    assert stats.repeated_words(common.words(pa.array(["p q p q p q p q p q"])), np.zeros(10, np.int64)).tolist() == [10]


# --- 2: exact deduplication ------------------------------------------------------------------------


def exact_expected(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    out = []
    for d, t, *_ in rows:
        keep = max((x for x in groups[t or ""] if x is not None), default=None)
        out.append((d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hashed", ["xxhash64", "length"])
def test_exact_dedup(odd, odd_rows, hashed):
    """The hash is also replaced by the length: then most chunks collide, and identifiers must still tell them apart."""
    from pyspark.sql import functions as F

    options = {"hashed": lambda c: F.length(c).cast("long"), "least": 16, "most": 64} if hashed == "length" else {}
    assert rows_of(exact_dedup.exact_dedup(odd, **options).drop("n_chunks")) == exact_expected(odd_rows)


def test_exact_dedup_keeps_one(odd, odd_rows, none):
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(x[0] for x in exact_expected(odd_rows) if x[3])
    assert exact_dedup.exact_dedup(none).count() == exact_dedup.keep_one(none).count() == 0


# --- 3: quality classifier -------------------------------------------------------------------------


def test_quality_classifier(spark, odd, labels, none, no_labels):
    found = quality_classifier.quality_classifier(odd, labels).collect()
    assert len(found) == odd.count()
    for r in found:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert quality_classifier.quality_classifier(none, labels).count() == 0
    assert {r.score for r in quality_classifier.quality_classifier(odd, no_labels).collect()} == {0.5}


def test_quality_classifier_on_held_out_rows(spark):
    r = random.Random(9)
    rows = [(i, prose(r, 80) if i % 4 else prose(r, 80, 6).upper() + "!!", "en", "a") for i in range(600)]
    truth = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(600)], "doc_id long, quality int")
    held = [x for x in quality_classifier.quality_classifier(frame(spark, rows), truth).collect() if x.held_out]
    assert np.mean([x.predicted == int(x.doc_id % 4 > 0) for x in held]) > 0.95


def test_isotonic_is_monotone_and_keeps_the_mean():
    n, y = np.array([5.0, 3, 0, 4, 8]), np.array([1.0, 2, 0, 1, 7])
    rate = quality_classifier.isotonic(n, y)
    assert (np.diff(rate) >= 0).all() and np.isclose((rate * n).sum(), y.sum())


# --- 4: suffix-array deduplication ----------------------------------------------------------------


def remove_repeats(texts, length=100):
    seen, out = set(), {}
    for key, b in texts:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                cover[i] += 1
                cover[i + length] -= 1
            seen.add(b[i : i + length])
        gone = np.cumsum(cover)[: len(b)] > 0
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        out[key] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_suffix_dedup(spark, odd_rows):
    from pyspark.sql import functions as F

    df = frame(spark, odd_rows).repartition(3)
    hashes = {(r.doc_id, r.text): r.h for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    keys = sorted({(d is not None, d or 0, hashes[d, t], (t or "").encode()) for d, t, *_ in odd_rows})
    expected = remove_repeats([(k, k[3]) for k in keys])
    want = Counter((d, *expected[d is not None, d or 0, hashes[d, t], (t or "").encode()]) for d, t, *_ in odd_rows)
    assert Counter(tuple(r) for r in suffix_dedup.suffix_dedup(df).collect()) == want


def test_suffix_dedup_of_random_repeats(spark):
    r = random.Random(2)
    shared = [prose(r, 40, 30) for _ in range(4)]
    rows = [(i, " ".join(r.choice(shared)[r.randrange(60) : r.randrange(120, 300)] if r.random() < 0.6 else prose(r, 12, 30) for _ in range(5)), "en", "a") for i in range(60)]
    expected = remove_repeats([(d, t.encode()) for d, t, *_ in rows])
    found = suffix_dedup.suffix_dedup(frame(spark, rows).repartition(5)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected


def test_suffix_dedup_without_rows(none):
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_loser_tree_merges_and_knows_shared_prefixes():
    r = random.Random(3)
    runs = [sorted("".join(r.choice("ab") for _ in range(12)).encode() for _ in range(r.randint(0, 40))) for _ in range(7)]
    share = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    coded = [(run, [0] + [share(a, b) for a, b in zip(run, run[1:])]) for run in runs]
    merged = [(runs[p][i], l) for p, i, l in suffix_dedup.LoserTree(coded).merged()]
    assert [s for s, _ in merged] == sorted(s for run in runs for s in run)
    assert [l for _, l in merged[1:]] == [share(a, b) for (a, _), (b, _) in zip(merged, merged[1:])]


def test_anchors_depend_on_the_window_alone():
    r = np.random.default_rng(8)
    data = r.integers(97, 101, 3000).astype(np.uint8)
    data[2000:2300] = data[500:800]
    at, _ = suffix_dedup.anchors(data, np.array([0]), np.array([3000]))
    chosen = set(at.tolist())
    for i in range(500, 701):  # each window that stands twice has an anchor at the same place in both
        assert {a - i for a in chosen if i <= a <= i + 76} & {a - i - 1500 for a in chosen if i + 1500 <= a <= i + 1576}


def test_anchors_are_the_same_whatever_the_piece():
    r = np.random.default_rng(6)
    data = r.integers(97, 99, 20_000).astype(np.uint8)  # two letters: many equal hashes
    whole, h = suffix_dedup.anchors(data, np.array([0, 7000]), np.array([7000, 20_000]))
    blocks, g = suffix_dedup.anchors(data, np.array([0, 7000]), np.array([7000, 20_000]), block=300)
    apart = [suffix_dedup.anchors(data[a:b], np.array([0]), np.array([b - a]))[0] + a for a, b in ((0, 7000), (7000, 20_000))]
    assert whole.tolist() == blocks.tolist() == np.concatenate(apart).tolist() and (h == g).all()
    for i in range(0, 6901, 137):  # of one window alone
        assert suffix_dedup.anchors(data[i : i + 100], np.array([0]), np.array([100]))[0][0] + i in set(whole.tolist())


def test_suffix_dedup_of_pieces_of_very_different_size(spark):
    r = random.Random(12)
    long = "".join(r.choice("ab") for _ in range(60_000))
    rows = [(1, long, "en", "a"), *((i, long[i * 517 : i * 517 + 100 + i], "en", "a") for i in range(2, 90)), (None, long[:400], "en", "a"), (None, long[300:900], "en", "b"), (None, long[:400], "en", "a")]
    df = frame(spark, rows).repartition(4)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted({(d is not None, d or 0, hashes[t], t.encode()) for d, t, *_ in rows})
    expected = remove_repeats([(k, k[3]) for k in order])
    want = Counter((d, *expected[d is not None, d or 0, hashes[t], t.encode()]) for d, t, *_ in rows)
    assert Counter(tuple(x) for x in suffix_dedup.suffix_dedup(df).collect()) == want


# --- 5: HTML extraction -----------------------------------------------------------------------------


def test_extraction_on_pages_not_trained_on():
    chain = html_extract.default_chain()
    wrong = total = 0
    for parts in labelled_pages(120, seed=991):
        blocks, labels = html_extract.align("".join(p for p, _ in parts), parts)
        wrong += sum(a != b for a, b in zip(chain.decode(blocks), labels))
        total += len(labels)
    assert total > 1000 and wrong / total < 0.01


def test_viterbi_is_the_best_sequence():
    chain = html_extract.default_chain()
    page = next(labelled_pages(1, seed=5))
    blocks, _ = html_extract.align("".join(p for p, _ in page), page)
    blocks = blocks[:9]
    emit = np.array([sum((np.array(chain.state[chain.place[f]]) for f in b.features if f in chain.place), np.zeros(2)) for b in blocks])
    def score(s):
        return chain.step[2, s[0]] + emit[range(len(s)), s].sum() + sum(chain.step[a, b] for a, b in zip(s, s[1:]))
    best = max(([(n >> i) & 1 for i in range(len(blocks))] for n in range(2 ** len(blocks))), key=score)
    assert [bool(x) for x in best] == chain.decode(blocks)


def test_extract_odd_pages(spark):
    page = "<html><head><title>x</title><script>var a='</p>';</script></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>First <b>bold</b>ly said,&nbsp;here.<p>Second one is a bit longer, &lt;really&gt; so.<ul><li>One thing.<li>Other thing.</ul></article><section id=comments><p>Nice article.</p></section><footer>&copy; us</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (None, "u", page), (5, "u", "<article><p>" + "long text here. " * 20_000 + "</p></article>"), (6, "u", "<!-- never closed <p>text"), (7, "u", "<div class='ad'>Buy this now.</div>")]
    found = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1].text == "A & B First boldly said, here. Second one is a bit longer, <really> so. One thing. Other thing." == found[None].text
    assert found[1].n_chars == len(found[1].text)
    assert found[2].text == found[3].text == found[6].text == found[7].text == ""
    assert found[5].n_chars == len("long text here. " * 20_000) - 1
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def words_of(html):
    return " ".join(b.text for b in html_extract.leaf_blocks(html))


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', 'class="hidden-xs"', 'class="hidden"', 'aria-hidden="false"', 'href="/hidden-gems"', 'title="The hidden city"', 'title="x hidden y"', "data-hidden", "hidden=until-found", 'hidden="Until-Found"', 'style="color:red;visibility:hidden"', 'title="display:none"', 'style="--display:none"', 'style="background:url(a;display:none)"', 'style="/* display:none */"', 'style="display:none;display:block"', 'title=">" class="hidden"', 'title=""hidden""', 'class="a" title=\'hidden\''])
def test_rendered_text_is_kept(attributes):
    assert words_of(f"<p>One <span {attributes}>two</span> three.") == "One two three."
    assert words_of(f"<article {attributes}><p>Text.</p></article>") == "Text."


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", "hidden=''", 'hidden="hidden"', "class=a hidden id=b", 'class="a"hidden', 'style="display:none"', 'style="color:red; Display : None !important;"', "style=display:none", 'style="display:none!important;display:block"'])
def test_unrendered_text_is_passed_over(attributes):
    assert words_of(f"<p>One <span {attributes}>two</span> three.") == "One three."


@pytest.mark.parametrize("piece", ["<a", "<div>x", "<b><br>x", "<p><button><center>x", "<a '>'", "<a =", "<!--", "<li><ul>", "<a href='", "&", "<table><tr><td>", "<i x=\"", "<a style='('>"])
def test_malformed_markup_takes_linear_time(piece):
    import time

    page = piece * (400_000 // len(piece))
    began = time.process_time()
    html_extract.default_chain().decode(html_extract.leaf_blocks(page))
    assert time.process_time() - began < 5


def test_unfinished_markup():
    assert words_of("One <b two") == "One" and words_of("1 < 2 and <3") == "1 < 2 and <3" and words_of("One <i a='>two") == "One two"
    assert words_of("One <i a='>' b=\">\">two") == "One two" and words_of("<p>One<!-->two<!-- -->three") == "Onetwothree"


def test_math_is_rendered():
    assert words_of("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.") == "So x=2 holds."


# --- 6: mixing ----------------------------------------------------------------------------------------


def targets_by_rounds(size):
    """What is above a cap is shared again by weight, until nothing is."""
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    fixed, left = {}, sum(size.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * size[s]]
        if not above:
            return fixed | share
        for s in above:
            fixed[s] = 3.0 * size[s]
            left -= 3 * size[s]


def test_mixing(odd, odd_rows, none):
    size = defaultdict(int)
    for _, t, _, s in odd_rows:
        size[s] += len(WORD.findall(t or ""))
    want = targets_by_rounds(size)
    found = mixing.mix(odd).collect()
    by_id = {(d, len(WORD.findall(t or ""))): s for d, t, _, s in odd_rows}
    assert len(found) == len(odd_rows)
    for r in found:
        s = by_id[r.doc_id, r.size]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        rate = want[s] / size[s] if size[s] else 0
        assert r.copies in (int(rate + 1e-9), int(rate + 1e-9) + 1, int(rate)) and r.taken == r.size * r.copies <= 3 * r.size
    assert rows_of(mixing.mix(odd.repartition(5))) == rows_of(mixing.mix(odd))
    assert mixing.mix(none).count() == mixing.mixed(none).count() == 0


def test_mixed_emits_each_row_as_often_as_it_is_taken(odd):
    taken = Counter()
    for r in mixing.mix(odd).collect():
        taken[r.doc_id] += r.copies
    emitted = mixing.mixed(odd)
    assert emitted.columns == odd.columns
    assert Counter(r.doc_id for r in emitted.collect()) == +taken


def test_mixing_comes_near_its_targets(spark):
    r = random.Random(6)
    rows = [(i, prose(r, r.randint(5, 60)), "en", r.choice("aaaaabcde")) for i in range(4000)]
    found = mixing.mix(frame(spark, rows)).groupBy("source_size", "target").sum("taken").collect()
    for r in found:
        assert r["sum(taken)"] == pytest.approx(r.target, rel=0.1)


# --- 7: n-gram Jaccard join ------------------------------------------------------------------------------


def jaccard_expected(rows):
    sets = {}
    for d, t, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d, t] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()
    keys = [k for k in sets if k[0] is not None]
    root = {d: d for d, _ in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    return {d: (sets[d, t], find(d)) for d, t in keys}


def clusters(r, groups, per_group, words, edits):
    rows = []
    for g in range(groups):
        base = prose(r, words, 900).split(" ")
        for c in range(per_group):
            text = list(base)
            for _ in range(r.randint(0, edits)):
                text[r.randrange(len(text))] = f"edit{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(text), "en", "a"))
    return rows


@pytest.mark.parametrize("shape", [(12, 8, 120, 6), (1, 90, 150, 9), (40, 2, 30, 2)])
def test_ngram_join(spark, shape):
    rows = clusters(random.Random(sum(shape)), *shape) + [(1000 + i, prose(random.Random(i), 40), "en", "a") for i in range(30)]
    want = jaccard_expected(rows)
    found = ngram_join.ngram_join(frame(spark, rows).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {d: (len(s), c) for d, (s, c) in want.items()}


def test_ngram_join_on_odd_rows(spark, odd_rows, none):
    rows = odd_rows
    want = jaccard_expected(rows)
    assert want[14][1] == 14
    found = ngram_join.ngram_join(frame(spark, rows).repartition(3)).collect()
    sizes = {(d, t): len(jaccard_expected([(0, t)])[0][0]) for d, t, *_ in rows}  # two texts of one id have a set each
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == Counter((d, sizes[d, t], want[d][1]) for d, t, *_ in rows if d is not None)
    assert sorted(str(r.component_id) for r in found if r.doc_id is None) == ["1", "None"]
    assert ngram_join.ngram_join(none).count() == ngram_join.keep_one(none).count() == 0
    kept = ngram_join.keep_one(frame(spark, rows))
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 5, 6, 9} and 3 not in {r.doc_id for r in kept.collect()}


def test_ngram_join_links_all_texts_of_one_id(spark):
    r = random.Random(31)
    a, b, c = (prose(r, 80, 900) for _ in range(3))
    near = lambda t: t.replace(t.split(" ")[40], "edited", 1)
    rows = [(3, a, "en", "a"), (14, a, "en", "a"), (14, b, "en", "a"), (20, near(b), "en", "a"), (21, b.upper(), "en", "a"), (30, c, "en", "a"), (31, near(c), "en", "a"), (31, near(a), "en", "a"), (31, "", "en", "a")]
    found = ngram_join.ngram_join(frame(spark, rows)).collect()
    assert {r.component_id for r in found if r.n_shingles} == {3}


def test_ngram_join_compares_words_by_their_bytes(spark):
    rows = [(1, thue_morse(1024, "ab"), "en", "a"), (2, thue_morse(1024, "ba"), "en", "a"), (3, thue_morse(1024, "ab").upper(), "en", "a")]
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_join(frame(spark, rows)).collect()} == {1: 1, 2: 2, 3: 1}
    sets = ngram_join.exact_sets(pa.array(["a b c d e", "x a b c d", "a b", "A B", "a", None]), hashes=np.zeros(15, np.uint64))
    assert [len(s) for s in sets] == [2, 2, 1, 1, 1, 0] and len(np.intersect1d(sets[0], sets[1])) == 1 and sets[2] == sets[3] != sets[4]


def test_pivots_find_a_group_whose_original_has_the_largest_id(spark):
    """Copies are two edits from the original, four from each other: only the original links them."""
    from pyspark.sql import functions as F

    r = random.Random(17)
    base = prose(r, 150, 900).split(" ")
    rows = []
    for i in range(300):
        text = list(base)
        for place in r.sample(range(0, 150, 5), 2):
            text[place] = f"edit{r.randrange(10**6)}"
        rows.append((i, " ".join(text), "en", "a"))
    rows.append((1000, " ".join(base), "en", "a"))
    made = {}
    check = ngram_join.cross_candidates
    ngram_join.cross_candidates = lambda *args: made.setdefault("pairs", check(*args))
    try:
        found = ngram_join.ngram_join(frame(spark, rows).repartition(3)).collect()
    finally:
        ngram_join.cross_candidates = check
    assert {x.component_id for x in found} == {0}
    assert made["pairs"].count() == 0


def test_prefix_bounds_hold_for_random_sets():
    """Two sets that are similar enough share at least min(l) tokens of the prefixes that the rule gives them."""
    r = random.Random(1)
    for _ in range(300):
        n = r.randint(1, 60)
        x = set(r.sample(range(200), n))
        y = set(x)
        for _ in range(r.randint(0, 1 + n // 8)):
            y.discard(r.choice(sorted(y))) if r.random() < 0.5 and len(y) > 1 else y.add(r.randrange(200))
        both = len(x & y)
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        x, y = (x, y) if len(x) >= len(y) else (y, x)
        for l in range(1, min(4, int(ngram_join.need(len(x))), int(ngram_join.need(len(y)))) + 1):
            px = set(sorted(x)[: len(x) - int(ngram_join.need(len(x))) + l])
            py = set(sorted(y)[: len(y) - int(ngram_join.need_equal(len(y))) + l])
            assert len(px & py) >= l


def test_bitmaps_bound_the_difference():
    r = np.random.default_rng(4)
    for _ in range(50):
        a = np.unique(r.integers(0, 2**63, 150, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: r.integers(50, 150)], r.integers(0, 2**63, 20, dtype=np.uint64)]))
        apart = sum(int(np.bitwise_count(x)) for x in ngram_join.bitmap(a).view(np.uint64) ^ ngram_join.bitmap(b).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_random_graphs(spark):
    r = random.Random(7)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 50)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 8: language identification -----------------------------------------------------------------------------


def test_language_id(spark, none):
    r = random.Random(12)
    speak = {"en": "the and of with house tree going", "de": "der und nicht haus straße gehen zwölf", "fr": "le et avec maison forêt aller être"}
    say = lambda lang, n: " ".join(r.choice(speak[lang].split()) for _ in range(n))
    langs = list(speak)
    docs = frame(spark, [(i, say(langs[i % 3], 30), langs[i % 3], "s") for i in range(200)] + [(900, None, "en", "s"), (901, "", None, None), (None, say("de", 20), "de", None)])
    page = lambda lang, n, said: f'<html{f" lang={said}" if said else ""}><head><script>the and of</script></head><p>{say(lang, n)}</p>'
    rows = [(i, f"https://h{i % 3}.example.{('com', 'de', 'fr')[i % 3]}/x", page(langs[i % 3], 25, langs[i % 3])) for i in range(60)]
    rows += [(100, "https://h1.example.de/y", "<html><p>12</p>"), (101, None, None), (102, "not an address", ""), (103, "https://h1.example.de/z", page("fr", 40, "de")), (None, None, page("de", 20, None))]
    found = language_id.language_id(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()
    assert len(found) == 203 + 65
    by_page = {r.page_id: r for r in found if r.page_id is not None}
    assert all(by_page[i].lang == langs[i % 3] for i in range(60))
    assert by_page[100].lang == "de"  # no text to speak of: its host and suffix decide
    assert by_page[103].text_lang == "fr"
    assert all(0 < r.probability <= 1 for r in found)
    assert all(r.lang == langs[r.doc_id % 3] for r in found if r.doc_id is not None and r.doc_id < 200)
    nothing = language_id.language_id(spark.createDataFrame(rows, "page_id long, url string, html string"), none)
    assert {r.lang for r in nothing.collect()} == {None}


# --- 9: packing ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="session")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check_pieces(found, ids_of):
    """Every id in exactly one piece, sequences gapless and at most 2048 long; returns the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids_of[d]) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids_of[d][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids_of[d])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_packing(spark, odd_rows, none, encode):
    rows = list({x[0]: x for x in odd_rows if x[0] is not None}.values())
    found = packing.packing(frame(spark, rows).repartition(3), shard_tokens=20_000).collect()
    assert check_pieces(found, {d: encode(t) for d, t, *_ in rows}) == 0
    assert packing.packing(none).count() == 0


def test_packing_puts_like_with_like():
    r = np.random.default_rng(3)
    topics = [r.integers(k * 1000, k * 1000 + 400, 400) for k in range(2, 12)]
    ids = [r.choice(topics[i % 10], 250).astype(np.uint32) for i in range(80)]
    order = packing.order_of(ids)
    assert sorted(order) == list(range(80))
    assert np.mean([order[i] % 10 == order[i - 1] % 10 for i in range(1, 80)]) > 0.6


def test_packing_finds_likes_by_common_tokens_too():
    r = np.random.default_rng(8)
    copy = r.integers(0, 5000, 60)
    ids = [(copy if i % 3 == 0 else r.integers(5000, 40_000, 60)).astype(np.uint32) for i in range(1200)]  # 400 copies
    order = packing.order_of(ids)
    assert sorted(order) == list(range(1200))
    assert np.mean([order[i - 1] % 3 == 0 for i in range(1, 1200) if order[i] % 3 == 0]) > 0.95


def test_packing_takes_a_seed_s_best_by_all_its_tokens():
    r = np.random.default_rng(9)
    ids = [r.choice(300, 40).astype(np.uint32) for _ in range(300)]
    n, terms = len(ids), [set(x.tolist()) for x in ids]
    df = {t: sum(t in x for x in terms) for t in set().union(*terms)}
    def score(d):
        return sum(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * (tf := np.sum(ids[d] == t)) * 2.2 / (tf + 1.2) for t in terms[0] & terms[d])
    best = sorted(range(1, n), key=lambda d: (-round(score(d), 9), d))
    assert packing.order_of(ids)[:50] == [0, *best[:49]]
    index, used = packing.Index(ids), np.zeros(n, bool)
    used[0] = True
    assert index.neighbours(0, used, 20).tolist() == best[:20] == index.neighbours(0, used, n).tolist()[:20]
    used[best[::3]] = used[np.arange(n) % 4 == 3] = True
    index.forget(used, int(np.sum(~used)))
    assert index.neighbours(0, used, n).tolist() == [d for d in best if not used[d] and terms[d] & terms[0]]


@pytest.mark.parametrize("text", ["", " ", "a", "two  spaces", " lead", "trail ", "tab\t x", "line \n next", "don't you'll", "naïve café 漢字 🙂", "x y 　z", "12 345 6,7 %% --", "<|endoftext|> is text", "\x1c a \x1f", "a" * 500, "İstanbul ǅ ﬁ", "a <|endoftext|>", "x<|endoftext|><|endoftext|>\ny", "<|endoftext", "line\nnext\n", "\n", "\na b\n c", "x\r\ny", "a\n'll"])
def test_ids_equal_those_of_the_tokenizers_file(encode, text):
    ids = np.frombuffer(packing.tokenizer()(text), "<u4").tolist()
    assert ids == encode(text)[:-1]


def test_cuts_are_full_windows_and_powers_of_two():
    for total in (1, 5, 2047, 2048, 2049, 7000):
        sizes = np.diff(np.append(0, packing.cuts(total)))
        assert sizes.sum() == total and all(s & (s - 1) == 0 for s in sizes) and sizes.max() <= 2048


# --- 10: toxicity ---------------------------------------------------------------------------------------------


def test_toxicity(spark, odd, labels, none, no_labels):
    r = random.Random(5)
    bad = ["zorg", "blick", "vlam"]
    rows, truth = [], []
    for i in range(900):
        n = (i % 10 == 0) * (1 + i // 10 % 4)
        rows.append((i, " ".join([prose(r, 40), *(r.choice(bad).upper() + "!" for _ in range(n)), prose(r, 10)]), "en", "a"))
        truth.append((i, 1, int(n > 0)))
    found = {x.doc_id: x for x in toxicity.toxicity(frame(spark, rows), spark.createDataFrame(truth, "doc_id long, quality int, toxic int").where("doc_id < 700")).collect()}
    assert all(found[i].toxic == (i % 10 == 0) for i in range(700, 900))
    severity = lambda n: np.mean([found[i].expected_severity for i in range(0, 900, 10) if 1 + i // 10 % 4 == n])
    assert 0.5 < severity(1) < severity(4) <= 3
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    assert toxicity.toxicity(none, labels).count() == 0
    assert not any(x.toxic for x in toxicity.toxicity(odd, no_labels).collect())


def test_word_features_drop_outer_punctuation():
    from layoutspark.llm.common import words

    f = toxicity.word_features(words(pa.array(['Word "word," ... (WORD) wor-d', None, "word"])))
    assert f[0] == f[1] == f[3] == f[5] and f[2] == -1 and f[4] != f[0]
