"""The fitted models against plain versions of the same formulas."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layoutspark.llm import common, language_id, quality_classifier, stats, toxicity

from .conftest import frame, prose


def test_scores_solve_the_normal_equations(spark):
    """One solve over all training rows at once, pooling by brute force, against sums per partition."""
    r = random.Random(14)
    rows = [(i, prose(r, 30 + i % 90, 20 + i % 300) + "!" * (i % 5), "en", "a") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 < 2 or i % 7 == 0)) for i in range(400)], "doc_id long, quality int")
    found = {x.doc_id: x for x in quality_classifier.quality_classifier(frame(spark, rows).repartition(7), labels).collect()}
    _, x = stats.text_stats(pa.array([t for _, t, *_ in rows]))
    train = np.array([not found[i].held_out for i in range(400)])
    y = np.array([float(i % 5 < 2 or i % 7 == 0) for i in range(400)])[train]
    fourier = quality_classifier.Fourier(x[train].mean(0), np.sqrt(np.maximum(x[train].var(0), 1e-6)))
    z = fourier(x)
    weights = np.linalg.solve(z[train].T @ z[train] + quality_classifier.RIDGE * np.eye(z.shape[1]), z[train].T @ y)
    raw = z @ weights
    edges = np.linspace(-0.5, 1.5, quality_classifier.BINS * 8 + 1)[1:-1]
    fine = np.searchsorted(edges, raw[train])
    per_bin = max(train.sum() / quality_classifier.BINS, 1)
    before = np.array([(fine < b).sum() for b in range(len(edges) + 1)])
    group = np.minimum(before / per_bin, quality_classifier.BINS - 1).astype(int)
    means = {g: y[group[fine] == g] for g in sorted(set(group[fine]))}
    keys = list(means)
    # the greatest convex minorant by definition: max over starts of min over ends of the mean
    level = {k: max(min(np.concatenate([means[m] for m in keys[a : b + 1]]).mean() for b in range(j, len(keys))) for a in range(j + 1)) for j, k in enumerate(keys)}
    for i in range(400):
        g = group[np.searchsorted(edges, raw[i])]
        if g in level:
            assert found[i].score == pytest.approx(min(1, max(0, level[g])), abs=2e-2 if abs(raw[i] * 256 - round(raw[i] * 256)) < 1e-6 else 1e-6)


def test_ordinal_gradient_and_thresholds():
    rng = np.random.default_rng(2)
    n, d = 60, 5
    lists = [np.flatnonzero(rng.random(d) < 0.4) for _ in range(n)]
    rows, cols = np.repeat(np.arange(n), [len(x) for x in lists]), np.concatenate(lists)
    grade, fitted = rng.integers(0, toxicity.GRADES, n), rng.random(n) < 0.8
    model = toxicity.Severity(np.zeros(1, np.int32), rng.normal(size=d), np.sort(rng.normal(size=toxicity.GRADES - 1)))

    def loss(weights, bounds):
        total = toxicity.RIDGE * (weights**2).sum() / 2
        for i in np.flatnonzero(fitted):
            for k in range(toxicity.GRADES - 1):
                p = 1 / (1 + math.exp(-(sum(weights[j] for j in lists[i]) - bounds[k])))
                total -= math.log(p if grade[i] > k else 1 - p)
        return total / fitted.sum()

    slope = toxicity.slopes(model, rows, cols, grade, fitted)
    flat = np.concatenate([model.weights, model.bounds])
    for j in range(len(flat)):
        step = np.zeros(len(flat))
        step[j] = 1e-5
        up, down = flat + step, flat - step
        assert slope[j] == pytest.approx((loss(up[:d], up[d:]) - loss(down[:d], down[d:])) / 2e-5, abs=1e-6)
    before = loss(model.weights, model.bounds)
    for _ in toxicity.descend(model, rows, cols, grade, fitted, 100):
        assert (np.diff(model.bounds) >= 0).all()
    assert loss(model.weights, model.bounds) < before
    above = model.above(np.array([-1.0, 0, 2]))
    assert (np.diff(above, axis=1) <= 0).all() and (np.diff(above, axis=0) > 0).all()


def test_words_that_stand_out_are_counted_over_all_rows(spark):
    r = random.Random(8)
    texts = {i: " ".join([prose(r, 20, 60), *(["zorg"] * (i % 10 == 0)), *(["blick"] * (i % 30 == 0))]) for i in range(300)}
    rows = [(i, int(i % 10 == 0), i % 5 != 1, t) for i, t in texts.items()]
    of = lambda t: sorted(set(toxicity.word_features(common.words(pa.array([t]))).tolist()))
    sampled = spark.createDataFrame([(i, y, fit, of(t)) for i, y, fit, t in rows], "doc_id long, y int, fitted boolean, f array<int>").repartition(5)
    n1, n0 = Counter(), Counter()
    for _, y, fit, t in rows:
        if fit:
            (n1 if y else n0).update(of(t))
    t1, t0 = sum(y and fit for _, y, fit, _ in rows), sum(fit and not y for _, y, fit, _ in rows)
    want = {}
    for f, n in n1.items():
        z = (math.log((n + 0.05) / (t1 + 0.1)) - math.log((n0[f] + 0.5) / (t0 + 1))) * math.sqrt(n)
        if n >= toxicity.LEAST_ROWS and z > 3:
            want[f] = (n, n0[f], round(z, 9))
    found = toxicity.standing_out(sampled, t1, t0)
    assert {x.f: (x.n1, x.n0, round(x.z, 9)) for x in found} == want and want
    assert [x.z for x in found] == sorted((x.z for x in found), reverse=True)


def test_language_posteriors_by_hand(spark):
    """Every row's probability again, from the likelihoods and plain dictionaries."""
    r = random.Random(5)
    speak = {"en": "the and of with house", "de": "der und nicht haus gehen", "fr": "le et avec maison aller"}
    say = lambda lang, n: " ".join(r.choice(speak[lang].split()) for _ in range(n))
    langs = sorted(speak)
    docs = [(i, say(langs[i % 3], 12), langs[i % 3], ("a", "b", None)[i % 3 if i % 4 else 0]) for i in range(60)]
    pages = [(i, f"http://x{i % 4}.{('one', 'two')[i % 2]}.{('com', 'de', 'fr')[i % 3]}/p" if i % 9 else None, f"<html{' lang=' + langs[i % 3] if i % 5 else ''}><p>{say(langs[i % 3] if i % 7 else 'en', i % 6)}</p>") for i in range(50)]
    found = language_id.language_id(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), frame(spark, docs)).collect()
    like = language_id.learn(frame(spark, docs).select("doc_id", "text", "lang"))
    assert like.names == langs
    rows = [dict(key=("d", i), host=f"source:{s}" if s is not None else None, domain=None, suffix=None, declared=None, text=t) for i, t, _, s in docs]
    for i, url, html in pages:
        host = url.split("/")[2] if url else None
        m = language_id._html.search(html)
        rows.append(dict(key=("p", i), host=host, domain=".".join(host.split(".")[-2:]) if host else None, suffix=host.split(".")[-1] if host else None, declared=m[1] if m else None, text=language_id.visible(html)))
    logs = like(pa.array([x["text"] for x in rows]))
    post = np.exp(logs - logs.max(1, keepdims=True))
    post /= post.sum(1, keepdims=True)
    sums = {k: defaultdict(lambda: np.zeros(3)) for k in ("host", "domain", "suffix", "declared")}
    for x, p in zip(rows, post):
        for k, s in sums.items():
            if x[k] is not None:
                s[x[k]] = s[x[k]] + p
    base = post.sum(0) + language_id.SEEN
    base /= base.sum()
    shrink = lambda own, up, weight: (own + weight * up) / (own.sum() + weight)
    got = {("d", x.doc_id) if x.doc_id is not None else ("p", x.page_id): x for x in found}
    for x, l, p in zip(rows, logs, post):
        prior = base
        if x["host"] is not None:
            up = base
            if x["suffix"] is not None:
                up = shrink(sums["domain"][x["domain"]], shrink(sums["suffix"][x["suffix"]], base, language_id.SUFFIX_WEIGHT), language_id.DOMAIN_WEIGHT)
            prior = shrink(np.maximum(sums["host"][x["host"]] - p, 0), up, language_id.HOST_WEIGHT)
        score = l + np.log(prior)
        for k in ("declared", "suffix"):
            if x[k] is not None:
                whole = sum(sums[k].values())
                score = score + np.log((sums[k][x[k]] + language_id.SEEN) / (whole + language_id.SEEN * (len(sums[k]) + 1)))
        share = np.exp(score - score.max())
        assert got[x["key"]].probability == pytest.approx(1 / share.sum(), rel=1e-9)
        assert got[x["key"]].lang == langs[int(np.argmax(score))]
