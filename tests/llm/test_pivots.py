"""op7's pivots decide when links are found, not whether."""

import random

import pytest

from layoutspark.llm import ngram_join

from .conftest import frame, prose


@pytest.mark.parametrize("rounds", [0, 2])
def test_pivots_leave_no_link_out(spark, rounds, monkeypatch):
    """Chains whose ends are unlike, groups near each other, and a hub with a copy changed in each place: components by brute force."""
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    r = random.Random(8)
    texts = []
    for _ in range(4):
        words = prose(r, 120, 5000).split()
        for step in range(9):  # each is linked with the next ones only
            texts.append(" ".join(words))
            words = words[4:] + prose(r, 4, 5000).split()
    hub = prose(r, 90, 5000).split()
    texts += [" ".join([*hub[:i], "other", *hub[i + 1 :]]) for i in range(0, 90, 7)]
    texts += [prose(r, 80, 5000) for _ in range(10)]
    r.shuffle(texts)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.lower().split() for t in texts)]
    lowest, changed = list(range(len(texts))), True
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            if lowest[i] != lowest[j]:
                lowest[i] = lowest[j] = min(lowest[i], lowest[j])
                changed = True
    found = ngram_join.ngram_join(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]))
    assert {x.doc_id: x.component_id for x in found.collect()} == dict(enumerate(lowest))
    assert len(links) > 40 and "n_links" not in found.columns  # a count of some links would be taken for one of all
