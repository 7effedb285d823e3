"""N-gram Jaccard join with adaptive multi-match prefixes: the documents whose word shingles overlap, and their groups.

1. Documents of one word sequence (by a cryptographic digest of it) are one class; its smallest id stands for it from
   here on. The same pass counts how many documents have a shingle, in a count sketch of a fixed size: it only ranks
   tokens (keyed 64-bit hashes of shingles) and pivots, so its noise costs time, never a pair.
2. Each set is ordered from rare to frequent. Two sets that are similar enough share at least `l` tokens of their
   prefixes if these are `l - 1` longer than one shared token needs (the multi-match rule); each document picks the
   `l` in 1..4 whose estimated cost, postings read plus candidates to verify, is least. A pair must share at least
   the smaller `l` of the two. Of a pair, the longer set probes with the longer prefix and the shorter is indexed
   with the shorter one that its role allows; sizes and positions bound the overlap further.
3. Tokens with two postings or more form the index. Groups of many near copies are found without their pairs, in
   rounds: every token has one pivot, and each document is verified against the pivot that it shares most tokens
   with. The pivots of the first round are the most central documents (those whose shingles are the most frequent,
   as those of a group's original are); later ones come from a token's smallest group. Rounds end when one links
   nothing. Then all candidates across the components so far are verified: nothing is left out, since a pair within a
   component can't change it. Parity bitmaps of the whole sets bound their difference before a pair is made.
4. Verification makes the sets again from the two texts, of words that are compared byte by byte, not by hash.

Rows of null, empty or wordless text have the empty set and link with nothing. Long texts are used whole; pieces of
about 1 MB or one text are in a worker's memory. Repeated rows are one class. Rows that share a doc_id are one node
of the graph, with all links of all their texts. Rows without a doc_id take part through equal word sequences only
(component_id: the smallest id of those, or null). Ties (of pivots, of counts) go by id or hash, which changes no
result. An empty table gives no rows. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, block_sums, bounded_batches, checked_broadcast, discard, materialize, mix, packed, slices, words
from .components import components

SHINGLE = 4
NUM, DEN = 85, 100
SKETCH_BITS, BLOCKS = 20, 64
MOST_MATCHES = 4
#: Words of 64 bits in a set's parity bitmap: two bitmaps differ in no more bits than their sets in tokens.
BITMAP = 8
#: Ids up to which the texts to verify are found by a broadcast set (8 bytes each).
BROADCAST_IDS = 500_000
#: Verifying a candidate costs about as much as reading so many postings.
VERIFY_COST = 20.0
#: Rounds of pivots at most; what they leave apart is left to the candidates across components.
ROUNDS = 2
_K = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(texts: pa.Array, k: int = SHINGLE, w: Words | None = None, hashes: np.ndarray | None = None) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words has one for its whole sequence."""
    w = w or words(texts)
    h = w.hashes(lower=True) if hashes is None else hashes
    n = len(h)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        if n > j:
            rolled[: n - j] = mix(rolled[: n - j] * _K[0] + h[j:] + np.uint64(j + 1))
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for x in h[a:b]:
                whole = mix((np.array([whole]) * _K[1]) + x)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _joined_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A small number per pair of numbers, the same just for the same pair."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def exact_sets(texts: pa.Array, k: int = SHINGLE, w: Words | None = None, hashes: np.ndarray | None = None) -> list[np.ndarray]:
    """The sorted distinct shingles of each text as numbers that stand for their words, exactly, within this call."""
    w = w or words(texts)
    ids = w.ids(w.hashes(lower=True) if hashes is None else hashes, lower=True)
    grams, size = ids, 1
    while size < k and len(grams) > 1:
        step = min(size, k - size)
        grams = _joined_ids(grams[:-step], grams[step:])
        size += step
    short: dict[tuple, int] = {}
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(np.array([-1 - short.setdefault(tuple(ids[a:b].tolist()), len(short))]))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def need(n: int | np.ndarray, num: int = NUM, den: int = DEN):
    """The least overlap of a set of n with any that is similar enough."""
    return -(-num * n // den)


def need_equal(n, num: int = NUM, den: int = DEN):
    """The least overlap of a set of n with any that is similar enough and at least as large."""
    return -(-2 * num * n // (num + den))


def _classes(batches, k: int):
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    names = ["doc_id", "n", "digest", "i", "v"]
    for batch in batches:
        for part in slices(batch, "t"):
            texts = part.column("t")
            w = words(texts)
            h = w.hashes(lower=True)
            sets = shingle_sets(texts, k, w, h)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            sketch += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
            sizes = [len(s) for s in exact_sets(texts, k, w, h)]
            raw = w.data.tobytes()
            digests = [hashlib.blake2b(b" ".join(raw[a:b].lower().split()), digest_size=16).digest() for a, b in zip(w.text_start.tolist(), w.text_end.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    if sketch.any():
        parts = [packed(x.astype("<i8")) for x in np.split(sketch, BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.binary()), pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names)


def sketch_of(rows: DataFrame) -> np.ndarray:
    """The counters, 8 MB whatever the input. Summed per block on the executors."""
    out = np.zeros((BLOCKS, (1 << SKETCH_BITS) // BLOCKS), np.int64)
    for i, v in block_sums(rows.where("i is not null"), "<i8").items():
        out[i] = v
    return out.ravel()


def choose_matches(df: np.ndarray, n: int, num: int, den: int) -> int:
    """The l of least estimated cost; df: the estimated postings of the tokens, rare first."""
    base = n - int(need(n, num, den))
    most = max(1, min(MOST_MATCHES, int(need(n, num, den))))
    sums = np.cumsum(df[: base + most])
    costs = [sums[min(base + l, n) - 1] * (1 + VERIFY_COST / l) for l in range(1, most + 1)]
    return 1 + int(np.argmin(costs))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Bit i tells whether the number of tokens with hash i (modulo the size) is odd."""
    odd = np.bincount((s >> np.uint64(8)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(sketch, k: int, num: int, den: int):
    def run(batches):
        counts = sketch.value
        level = counts.mean()
        for batch in batches:
            for part in slices(batch, "t"):
                ids, ns, ls, cents, lists, maps = [], [], [], [], [], []
                for doc, s in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("t"), k)):
                    n = len(s)
                    if not n or doc is None:
                        continue
                    c = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    order = np.argsort(c, kind="stable")
                    some = np.maximum(c[order] - level, 1)
                    l = choose_matches(some, n, num, den)
                    ids.append(doc), ns.append(n), ls.append(l), cents.append(float(np.log(some).mean())), maps.append(bitmap(s).tolist())
                    lists.append(s[order[: n - int(need(n, num, den)) + l]].view(np.int64))
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) for x in lists], out=offsets[1:])
                values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ls, pa.int32()), pa.array(cents, pa.float32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(maps, pa.list_(pa.int64()))], ["doc_id", "n", "l", "cent", "tokens", "bits"])

    return run


def _verify(k: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "tx"):
                for piece in slices(part, "ty"):
                    n = len(piece)
                    texts = pa.concat_arrays([piece.column("tx"), piece.column("ty")]).dictionary_encode()
                    sets, which = exact_sets(texts.dictionary, k), texts.indices.to_numpy()
                    good = []
                    for x, y in zip(which[:n].tolist(), which[n:].tolist()):
                        a, b = sets[x], sets[y]
                        both = len(a) if x == y else len(np.intersect1d(a, b, assume_unique=True))
                        good.append(both > 0 and den * both >= num * (len(a) + len(b) - both))
                    yield piece.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, as a table in the shared folder.

    Texts of a meet their pairs where they are read, as long as the pairs can be broadcast; then they travel once, to
    the texts of b, which are fewer.
    """
    ids = materialize(pairs.select(F.col("b").alias("id")).distinct(), "pair-ids")
    ty = texts.join(checked_broadcast(ids, BROADCAST_IDS), F.col("doc_id") == F.col("id"), "left_semi").select(F.col("doc_id").alias("ib"), F.col("t").alias("ty"))
    tx = texts.join(checked_broadcast(pairs, BROADCAST_IDS), F.col("doc_id") == F.col("a")).select("a", "b", F.col("t").alias("tx"))
    both = tx.join(ty, F.col("b") == F.col("ib")).select("a", "b", "tx", "ty")
    return materialize(both.mapInArrow(_verify(k, num, den), "a long, b long"), "verified").distinct()


def _possible(num: int, den: int) -> str:
    """Of postings x (the larger set) and y: sizes and positions leave room for enough overlap."""
    return f"{den} * ny >= {num} * nx and ({num} + {den}) * (1 + least(px, py) + least(nx - 1 - px, ny - 1 - py)) >= {num} * (nx + ny)"


def _as_side(df: DataFrame, s: str) -> DataFrame:
    return df.select(F.col("token").alias(f"t{s}"), F.col("doc_id").alias(f"i{s}"), F.col("n").alias(f"n{s}"), F.col("pos").alias(f"p{s}"), F.col("l").alias(f"l{s}"), *[F.col(c).alias(f"{c}{s}") for c in ("comp", "bits", "rest") if c in df.columns])


def _mixed(index: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The postings of tokens that documents of two components or more have, with their component `comp`."""
    if labels is None:
        return index.withColumn("comp", F.col("doc_id"))
    own = index.join(labels, F.col("doc_id") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("node", "component")
    tokens = own.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select(F.col("token").alias("mt"))
    return own.join(tokens, (F.col("token") == F.col("mt")) & (F.hash("token") == F.hash("mt")), "left_semi")


def pivot_candidates(index: DataFrame, labels: DataFrame | None, num: int, den: int) -> DataFrame:
    """(a, b): each document a with the pivot b, of another component, that it shares most tokens with.

    A token's pivot is its most central document; once there are components (labels), that of the smallest one.
    """
    own = _mixed(index, labels)
    top = F.max(F.struct("cent", (-F.col("doc_id")).alias("neg"), "doc_id", "n", "pos", "l", "comp"))
    if labels is None:
        pivots = own.groupBy("token").agg(top.alias("m"))
    else:
        pivots = own.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"), top.alias("top")).groupBy("token").agg(F.min(F.struct("size", "comp", "top"))["top"].alias("m"))
    pivots = _as_side(pivots.select("token", "m.*"), "v")
    found = _as_side(own, "u").join(pivots, (F.col("tu") == F.col("tv")) & (F.hash("tu") == F.hash("tv"))).where("compu <> compv")
    # named as the larger and the smaller set
    for c in "npi":
        found = found.withColumn(f"{c}x", F.expr(f"if(nu >= nv, {c}u, {c}v)")).withColumn(f"{c}y", F.expr(f"if(nu >= nv, {c}v, {c}u)"))
    found = found.where(_possible(num, den)).groupBy("iu", "iv").agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("lu", "lv")).alias("l")).where("shared >= l")
    best = found.groupBy("iu").agg(F.max(F.struct("shared", (-F.col("iv")).alias("neg"))).alias("m"))
    return best.select(F.col("iu").alias("a"), (-F.col("m.neg")).alias("b"))


def _linked_roles(num: int, den: int) -> str:
    """Of postings u and v: whichever set is larger is x; the other must be indexed with this token, and all bounds must hold.

    Bitmaps differ in at most as many bits as the sets may differ in tokens.
    """
    apart = " + ".join(f"bit_count(bitsu[{i}] ^ bitsv[{i}])" for i in range(BITMAP))
    sizes = f"{den} * least(nu, nv) >= {num} * greatest(nu, nv)"
    spot = f"({num} + {den}) * (1 + least(pu, pv) + least(nu - 1 - pu, nv - 1 - pv)) >= {num} * (nu + nv)"
    indexed = lambda y: f"p{y} < n{y} - ceil(2 * {num} * n{y} / ({num} + {den})) + l{y}"
    return f"{sizes} and {spot} and if(nu > nv or (nu = nv and iu > iv), {indexed('v')}, {indexed('u')}) and {apart} <= nu + nv - 2 * ceil({num} * (nu + nv) / ({num} + {den}))"


def cross_candidates(index: DataFrame, bits: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): all pairs of different components that share enough prefix tokens."""
    own = _mixed(index, labels).select("token", "doc_id", "n", "pos", "l", "comp")
    own = materialize(own.join(bits.select(F.col("doc_id").alias("bd"), "bits"), F.col("doc_id") == F.col("bd")).drop("bd"), "cross-postings")
    # of each token's postings those outside its most frequent component look for partners among all
    counts = own.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("token").agg(F.max(F.struct("m", "comp"))["comp"].alias("main"))
    main = counts.select(F.col("token").alias("mt"), "main")
    marked = own.join(main, (F.col("token") == F.col("mt")) & (F.hash("token") == F.hash("mt"))).withColumn("rest", F.col("comp") != F.col("main")).drop("mt", "main")
    marked = materialize(marked, "marked-postings")
    u, v = _as_side(marked.where("rest"), "u"), _as_side(marked, "v")
    found = u.join(v, (F.col("tu") == F.col("tv")) & (F.col("compu") != F.col("compv")) & F.expr("not restv or iu > iv") & F.expr(_linked_roles(num, den)))
    x_is_u = F.expr("nu > nv or (nu = nv and iu > iv)")
    pairs = found.select(F.when(x_is_u, F.col("iu")).otherwise(F.col("iv")).alias("a"), F.when(x_is_u, F.col("iv")).otherwise(F.col("iu")).alias("b"), F.least("lu", "lv").alias("l"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("l").alias("l")).where("shared >= l").select("a", "b")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id), a row per row of docs.

    class_id is the smallest id with the same word sequence. Components are those of all links: pivots only join some of
    them early, and whatever they pass over is a candidate as long as it joins two components. Links are not counted,
    since those within a component found so far aren't all verified.
    """
    spark = docs.sparkSession
    texts = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = materialize(texts.mapInArrow(lambda it: _classes(it, k), "doc_id long, n long, digest binary, i int, v binary"), "shingle-classes")
    each = rows.where("i is null").select("doc_id", "n", "digest")
    classes = materialize(each.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    sketch = spark.sparkContext.broadcast(sketch_of(rows))
    # an id is a copy if the texts of all its rows have smaller ids too; the classes of one id are linked
    classed = each.where("doc_id is not null").join(classes, (each["digest"] == classes["digest"]) & (F.hash(each["digest"]) == F.hash(classes["digest"])))
    held = materialize(classed.groupBy("doc_id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("doc_id <> lo"), "held-ids")
    copies = held.where("doc_id <> hi").select(F.col("doc_id").alias("copy"))
    several = held.where("lo <> hi").select(F.col("doc_id").alias("sd"))
    same_id = materialize(classed.join(checked_broadcast(several, BROADCAST_IDS), F.col("doc_id") == F.col("sd")).select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")).distinct(), "links-of-one-id")
    whole = texts.join(checked_broadcast(copies, BROADCAST_IDS), F.col("doc_id") == F.col("copy"), "left_anti")
    prefixes = whole.mapInArrow(_prefixes(sketch, k, num, den), "doc_id long, n long, l int, cent float, tokens array<long>, bits array<long>")
    postings = materialize(prefixes.select("doc_id", "n", "l", "cent", "bits", F.posexplode("tokens").alias("pos", "token")).withColumn("bits", F.when(F.col("pos") == 0, F.col("bits"))), "postings")
    often = postings.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("token").alias("mt"))
    bits = postings.where("pos = 0").select("doc_id", "bits").distinct()
    index = materialize(postings.drop("bits").join(often, (F.col("token") == F.col("mt")) & (F.hash("token") == F.hash("mt")), "left_semi"), "index")
    links, labels = same_id, None
    for _ in range(ROUNDS):
        found = verified(materialize(pivot_candidates(index, labels, num, den), "pivot-pairs"), whole, k, num, den)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = materialize(components(links), "labels")
    if labels is None:
        labels = materialize(components(links), "labels")
    rest = verified(materialize(cross_candidates(index, bits, labels, num, den), "cross-pairs"), whole, k, num, den)
    labels = materialize(components(links.unionByName(rest)), "labels")
    discard(spark, *(p.rsplit("/", 1)[0] for df in (postings, index) for p in df.inputFiles()[:1]))
    known = classes.join(labels, F.col("class_id") == F.col("node"), "left")
    known = known.select(F.col("digest").alias("cd"), "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = each.join(known, (F.col("digest") == F.col("cd")) & (F.hash("digest") == F.hash("cd")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that another stands for: of each component the row of the smallest id stays."""
    gone = ngram_join(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = materialize(gone, "dropped-links")
    return docs.join(checked_broadcast(gone, BROADCAST_IDS), docs[id_col] == gone["gone_id"], "left_anti")
