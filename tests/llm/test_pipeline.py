"""The pipeline against its stages done by brute force (the forest's verdicts are its own; all else is made again)."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from layoutspark.llm import packing, quality_rules

from .conftest import frame, prose
from .test_operators import WORD, jaccard_expected, targets_by_rounds


def expected_mix(rows, seed="mix-1"):
    size = defaultdict(int)
    for _, text, _, source in rows:
        size[source] += len(WORD.findall(text or ""))
    target = targets_by_rounds(size)
    out = Counter()
    for d, text, _, source in rows:
        rate = target[source] / size[source] if size[source] else 0.0
        draw = int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) / 2**52
        out[d] += int(rate) + (draw < rate - int(rate))
    return +out


def test_run_equals_brute_force(spark, tmp_path):
    r = random.Random(21)
    rows = []
    for i in range(140):
        text = prose(r, r.randint(25, 160))
        if i % 11 == 0:
            text = "junk*** &&& " * 30
        if i % 9 == 1 and rows:
            text = rows[-1][1]
        if i % 9 == 4 and rows:
            words = rows[-1][1].split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        rows.append((i, text, "en", r.choice(["a", "a", "b", "c", None])))
    rows += [(500, None, "en", "a"), (501, "", None, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 11 > 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, labels = spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet"))
    good = {x.doc_id for x in quality_rules.quality_rules(docs, labels).collect() if x.kept}
    left = [x for x in rows if x[0] in good]
    last = {}
    for x in left:
        last[x[1]] = max(x[0], last.get(x[1], -1))
    left = [x for x in left if last[x[1]] == x[0]]
    groups = jaccard_expected(left)
    left = [x for x in left if groups[x[0]][1] == x[0]]
    copies = expected_mix(left)
    ids = {d: len(packing.tokenizer()(t)) // 4 + 1 for d, t, *_ in left}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokens = Counter()
    for p in found:
        tokens[p.doc_id] += p.length
    assert tokens == Counter({d: n * ids[d] for d, n in copies.items()})
    by_sequence = defaultdict(int)
    for p in found:
        by_sequence[p.sequence_id] += p.length
    assert max(by_sequence.values()) <= 2048 and np.all([n & (n - 1) == 0 for n in by_sequence.values()])


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, prose(r, 60), "en", "a") for i in range(20)]
    docs = frame(spark, rows)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame(spark, rows).columns
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
