"""Language identification by Bayesian evidence fusion over web pages and documents.

For each row, log P(language) adds up four kinds of evidence:
- the text: a naive Bayes likelihood over hashed byte trigrams, learnt from a bounded sample of labelled documents
  (SAMPLE rows whose id isn't held out) and tempered, since trigrams of one text are not independent;
- the declared markup language (`<html lang>`): P(declared | language), from a grouped count over all rows;
- the address suffix (last label of the host): P(suffix | language), likewise;
- the host's prior, smoothed along a hierarchy: a host's counts shrink to those of its domain, these to its suffix's,
  these to those of all rows. All counts are grouped sums of the text's posterior, over all rows. A row's own part
  is taken out of its host's counts, so it doesn't vote for itself twice.

Documents have their source as host and no markup or address. Null texts, declarations and addresses are missing
evidence, which adds nothing. With no labelled document there is no language and `lang` is null. Ties go to the
language whose name is first. Repeated rows are rows like others (they count in the host priors). Empty texts have
no evidence of their own; long ones are used whole, their evidence tempered. Empty tables give no rows. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import block_sums, buffers, lowered, materialize, packed, slices
from .stats import bounded_sample

BITS, SAMPLE, SMOOTH, TEMPER_AT = 17, 4_000, 0.5, 60.0
HOST_WEIGHT, DOMAIN_WEIGHT, SUFFIX_WEIGHT, SEEN = 8.0, 20.0, 50.0, 1.0
_hidden = re.compile(r"<(script|style|head|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_tag = re.compile(r"<[^>]*>")
_html = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.I)


def trigram_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of all texts, and where each text's begin. Each text has one more, of its end; it's marked -1."""
    data, start, end = buffers(texts)
    d = lowered(data)
    d = np.where(((d < 97) | (d > 122)) & (d < 128), 32, d).astype(np.uint32)
    ids = np.full(len(d) + 2, -1, np.int64)
    if len(d) > 2:
        g = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)
        blank = (d[:-2] == 32) & (d[1:-1] == 32) | (d[1:-1] == 32) & (d[2:] == 32)
        ids[: len(g)] = np.where(blank, -1, g.astype(np.int64))
    cross = np.concatenate([end - 1, end - 2])
    ids[cross[(cross >= 0) & np.concatenate([end > start, end > start + 1])]] = -1
    return ids[: len(d)], start


def per_text(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[end] - sums[start]


class Likelihood:
    """Log P(trigram | language), 2 ** BITS numbers a language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + SMOOTH
        self.logs = np.log(smooth / smooth.sum(1, keepdims=True)) if len(names) else np.zeros((0, 1 << BITS))
        if len(names):
            self.logs -= self.logs.mean(0)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Tempered log likelihoods, a row per text: at most as much evidence as TEMPER_AT independent trigrams."""
        ids, start = trigram_ids(texts)
        _, _, end = buffers(texts)
        real = ids >= 0
        n = per_text(real, start, end)
        place = np.maximum(ids, 0)
        out = np.column_stack([per_text(np.where(real, row[place], 0.0), start, end) for row in self.logs]) if len(self.names) else np.zeros((len(start), 0))
        return out * np.minimum(1.0, TEMPER_AT / np.maximum(n, 1))[:, None]


def learn(docs: DataFrame, sample: int = SAMPLE) -> Likelihood:
    """From (doc_id, text, lang): trigram counts per language over a bounded sample, summed on the executors."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    chosen = bounded_sample(known.select("doc_id").distinct(), sample).select(F.col("doc_id").alias("chosen"))
    texts = known.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("lang", F.col("text").alias("t"))  # at most `sample` ids
    names = sorted(r["lang"] for r in texts.select("lang").distinct().collect())  # as many as sampled rows, at most
    place = {x: i for i, x in enumerate(names)}

    def count(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "t"):
                ids, start = trigram_ids(part.column("t"))
                ends = np.append(start[1:], len(ids))
                for lang, a, b in zip(part.column("lang").to_pylist(), start.tolist(), ends.tolist()):
                    own = ids[a:b]
                    i = place[lang]
                    if i not in sums:
                        sums[i] = np.zeros(1 << BITS)
                    sums[i] += np.bincount(own[own >= 0], minlength=1 << BITS)
        for i, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(v)], pa.binary())], ["i", "v"])

    found = block_sums(texts.mapInArrow(count, "i int, v binary"))
    return Likelihood(names, np.array([found[i] for i in range(len(names))]).reshape(len(names), 1 << BITS))


def visible(html: str) -> str:
    """The text of a page without markup; only statistics are made of it."""
    return _tag.sub(" ", _hidden.sub(" ", html))


def _evidence(model):
    def run(batches):
        found = model.value
        for batch in batches:
            for part in slices(batch, "t"):
                texts = part.column("t")
                declared = pa.nulls(len(part), pa.string())
                markup = part.column("markup").to_pylist()
                if any(markup):
                    raw = texts.to_pylist()
                    declared = pa.array([(m[1].lower() if m else None) if is_page else None for is_page, m in zip(markup, (_html.search(x) if y else None for x, y in zip(raw, markup)))], pa.string())
                    texts = pa.array([visible(x) if y else x for x, y in zip(raw, markup)], pa.string())
                logs = found(texts)
                if logs.shape[1]:
                    top = np.exp(logs - logs.max(1, keepdims=True))
                    post = top / top.sum(1, keepdims=True)
                else:
                    post = logs
                offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * logs.shape[1])
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (logs, post)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "page_id", "host", "domain", "suffix")), declared, *lists], ["doc_id", "page_id", "host", "domain", "suffix", "declared", "logs", "post"])

    return run


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def _vector_sum(names: list[str], column: str = "post") -> list[Column]:
    return [F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(len(names))]


def _array(n: int, prefix: str = "s") -> Column:
    return F.array(*[F.col(f"{prefix}{i}") for i in range(n)])


def language_id(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, page_id, host, declared, text_lang, lang, probability), a row per row of docs and of pages.

    docs: doc_id, text, lang (read for the sample only), source; pages: page_id, url, html.
    """
    spark = docs.sparkSession
    model = learn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), sample)
    names = model.names
    n = len(names)
    long, string = F.lit(None).cast("long"), F.lit(None).cast("string")
    host = host_of(F.col("url"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), long.alias("page_id"), F.concat(F.lit("source:"), F.col("source")).alias("host"), string.alias("domain"), string.alias("suffix"), F.lit(False).alias("markup"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.unionByName(pages.select(long.alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), F.lit(True).alias("markup"), F.coalesce("html", F.lit("")).alias("t")))
    seen = materialize(rows.mapInArrow(_evidence(spark.sparkContext.broadcast(model)), "doc_id long, page_id long, host string, domain string, suffix string, declared string, logs array<double>, post array<double>"), "language-evidence")
    out = ["doc_id", "page_id", "host", "declared"]
    if not n:
        return seen.select(*out, string.alias("text_lang"), string.alias("lang"), F.lit(None).cast("double").alias("probability"))

    def counts(key: list[str], name: str) -> DataFrame:
        """Summed posteriors by key, as an array, keyed for a join that deals both sides anew."""
        return seen.where(F.col(key[0]).isNotNull()).groupBy(*key).agg(*_vector_sum(names)).select(*[F.col(k).alias(f"{name}_{k}") for k in key], _array(n).alias(name))

    total = seen.agg(*_vector_sum(names)).first()
    base = np.array([(x or 0.0) + SEEN for x in total])
    base = base / base.sum()
    prior = F.array(*[F.lit(float(x)) for x in base])
    shrink = lambda own, up, weight: F.transform(own, lambda x, i: (x + weight * up[i]) / (F.aggregate(own, F.lit(0.0), lambda a, b: a + b) + weight))
    # priors down the hierarchy, per host: tables of a row per suffix, domain and host
    suffix = counts(["suffix"], "cs").withColumn("ps", shrink(F.col("cs"), prior, SUFFIX_WEIGHT)).select("cs_suffix", "ps")
    domain = counts(["domain", "suffix"], "cd").join(suffix, F.col("cd_suffix") == F.col("cs_suffix"), "left").withColumn("pd", shrink(F.col("cd"), F.coalesce("ps", prior), DOMAIN_WEIGHT)).select("cd_domain", "pd")
    hosts = seen.where("host is not null").groupBy("host").agg(F.first("domain").alias("d"), *_vector_sum(names)).select(F.col("host").alias("h"), "d", _array(n).alias("ch"))
    hosts = hosts.join(domain, F.col("d") == F.col("cd_domain"), "left").select("h", "ch", F.coalesce("pd", prior).alias("up"))
    hosts = materialize(hosts, "host-priors")
    # P(value | language) of a declaration or a suffix: its share of the language's rows that have any, smoothed
    evidence = {}
    for key in ("declared", "suffix"):
        evidence[key] = materialize(counts([key], key), f"{key}-counts")
    found = seen.join(hosts, (F.col("host") == F.col("h")) & (F.xxhash64("host") == F.xxhash64("h")), "left")
    for key, table in evidence.items():
        sums = table.agg(F.count(F.lit(1)).alias("k"), *[F.sum(F.col(key)[i]).alias(f"s{i}") for i in range(n)]).first()
        size = int(sums["k"])
        like = F.array(*[F.log((F.col(key)[i] + SEEN) / F.lit(float((sums[f"s{i}"] or 0.0) + SEEN * (size + 1)))) for i in range(n)])
        table = table.select(F.col(f"{key}_{key}"), like.alias(f"like_{key}"))
        found = found.join(table, (F.col(key) == F.col(f"{key}_{key}")) & (F.xxhash64(key) == F.xxhash64(f"{key}_{key}")), "left")
    others = F.transform("ch", lambda x, i: F.greatest(x - F.col("post")[i], F.lit(0.0)))
    found = found.withColumn("own", F.when(F.col("ch").isNotNull(), others)).withColumn("prior", F.when(F.col("own").isNotNull(), shrink(F.col("own"), F.col("up"), HOST_WEIGHT)).otherwise(prior))
    nothing = F.array(*[F.lit(0.0)] * n)
    score = F.transform("logs", lambda x, i: x + F.log(F.col("prior")[i]) + F.coalesce("like_declared", nothing)[i] + F.coalesce("like_suffix", nothing)[i])
    found = found.withColumn("score", score).withColumn("best", F.array_max("score"))
    named = F.array(*[F.lit(x) for x in names])
    pick = lambda xs: F.element_at(named, F.array_position(xs, F.array_max(xs)).cast("int"))
    return found.select(*out, pick(F.col("post")).alias("text_lang"), pick(F.col("score")).alias("lang"), (1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))).alias("probability"))
