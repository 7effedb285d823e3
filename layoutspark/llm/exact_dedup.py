"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: after a sentence end or a line break once a chunk has MIN_CHARS,
at MAX_CHARS at the latest. Its recipe is the ordered list of the identifiers of its chunks. Chunks are first
deduplicated to identifiers that are verified by content: an identifier is the chunk's 64-bit hash, and the
dictionary of distinct chunks is checked for two chunks with one hash. Where there are such chunks (none, as a
rule), their identifier also carries a SHA-256. So two recipes are equal just when the texts are, and only
recipes travel from then on, never a long text again.

Null texts count as empty and have the empty recipe. Rows that share a doc_id share the verdict: every row of a
group whose doc_id is the group's largest stays. A null doc_id is smaller than any other; if a group has only
null ids, all its rows stay. Long texts are cut like others and travel once, as chunks of MAX_CHARS at most; an empty
table gives no rows. Other columns are not read, so their names may clash with ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, materialize

MIN_CHARS, MAX_CHARS = 256, 2048
#: Dropped rows up to which they are broadcast (an id and a digest each, some 20 MB at most).
BROADCAST_COPIES = 200_000


def chunk_pattern(least: int = MIN_CHARS, most: int = MAX_CHARS) -> str:
    return rf"(?s).{{{least},{most}}}?(?:(?<=[.!?]\s)|(?<=\n))|.{{1,{most}}}"


def chunks(text: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def colliding(pieces: DataFrame, chunk: str = "chunk", hashed=F.xxhash64) -> DataFrame:
    """The hashes (column `bad`) that stand for two or more different chunks."""
    return pieces.select(chunk).distinct().groupBy(hashed(F.col(chunk)).alias("bad")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bad")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHARS, most: int = MAX_CHARS, hashed=F.xxhash64) -> DataFrame:
    """(doc_id, recipe array<string or long>, sha binary, n_chunks int) of every row, as a table in the shared folder.

    `hashed` is replaced only by tests that force collisions.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    cut = base.select("doc_id", chunks(F.col("t"), least, most).alias("cs"), F.unhex(F.sha2("t", 256)).alias("sha"))
    bad = materialize(colliding(cut.select(F.explode("cs").alias("chunk")), hashed=hashed), "colliding-chunks")
    if bad.isEmpty():
        return materialize(cut.select("doc_id", F.transform("cs", lambda c: hashed(c)).alias("recipe"), "sha", F.size("cs").alias("n_chunks")), "recipes")
    # The identifiers of the chunks in question get the SHA-256 of the chunk too; the others stay as they are.
    row = cut.select(F.monotonically_increasing_id().alias("row"), "*")
    row = materialize(row.select("row", "doc_id", "sha", F.transform("cs", lambda c: F.struct(hashed(c).alias("h"), F.sha2(c, 256).alias("s"))).alias("ids")), "chunk-ids")
    part = row.select("row", F.posexplode("ids").alias("pos", "c")).select("row", "pos", F.col("c.h").alias("h"), F.col("c.s").alias("s"))
    part = part.join(bad, F.col("h") == F.col("bad"), "left").select("row", F.struct("pos", F.when(F.col("bad").isNull(), F.col("h").cast("string")).otherwise(F.concat_ws(":", F.col("h").cast("string"), "s")).alias("id")).alias("c"))
    lists = part.groupBy("row").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["id"]).alias("recipe"))
    joined = row.join(lists, "row", "left").select("doc_id", F.coalesce("recipe", F.array().cast("array<string>")).alias("recipe"), "sha", F.size("ids").alias("n_chunks"))
    return materialize(joined, "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_chunks), a row per row of docs."""
    each = recipes(docs, id_col, text_col, **options).withColumn("rh", F.xxhash64("recipe"))
    groups = each.groupBy("rh", "recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Joined on another key than it was grouped by, so both sides are dealt anew and a hot recipe's rows can be split.
    groups = groups.select(F.col("rh").alias("gh"), F.col("recipe").alias("grecipe"), "keep_id", "group_size")
    found = each.join(groups, (F.hash("recipe") == F.hash("grecipe")) & (F.col("recipe") == F.col("grecipe")))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_chunks",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_dedup drops; all columns as they were."""
    gone = exact_dedup(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_sha"))
    gone = checked_broadcast(materialize(gone, "dropped-copies"), BROADCAST_COPIES)
    same = docs[id_col].eqNullSafe(gone["gone_id"]) & (F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)) == gone["gone_sha"])
    return docs.join(gone, same, "left_anti")


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
