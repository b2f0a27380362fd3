"""Exact deduplication by 128-bit content hash with byte comparison.

Texts are equal when they are identical after each run of ASCII white space becomes one
space. Rows are grouped by hash and by the text itself, so bytes are compared within each
hash group, and partial aggregation leaves one row per task of a group of any size. Of
equal texts the row with the smallest id stays; of repeated rows with that id, one. Null
text counts as empty, and a null id as larger than any other. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def mark_duplicates(docs: DataFrame, hash_of=content_hash, key: str = "doc_id", row: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, row``.

    ``row`` names a column that tells the rows apart; by default they are numbered.

    Texts move once, in the grouping; ids and hashes are stored and joined to its result
    by hash. Where texts share a hash (``hash_of`` may be any function), their rows are
    joined by hash and text instead.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    texts = docs.select(F.col(key).alias("doc_id"), normalised(text_of()).alias("_text"), number.alias("_row"))
    hashed = hash_of(F.col("_text")).alias("_hash")
    rows = stored(
        texts.select(
            "doc_id", hashed, F.sha2("_text", 256).alias("text_sha256"), "_row"
        ),
        "hashes",
    )
    groups = stored(
        texts.groupBy(hashed, "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("_hash", "keep_id", "group_size"),
        "groups",
    )
    colliding = stored(groups.groupBy("_hash").count().filter("count > 1").select("_hash"), "collisions")
    marked = rows.join(groups.join(colliding, "_hash", "left_anti"), "_hash")
    if colliding.limit(1).count():
        clash = texts.select("*", hashed).join(colliding, "_hash").withColumn("text_sha256", F.sha2("_text", 256))
        split = (
            clash.groupBy("_hash", "_text", "text_sha256")
            .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .select("_hash", "text_sha256", "keep_id", "group_size")
        )
        marked = marked.unionByName(rows.join(split, ["_hash", "text_sha256"]))
    first = marked.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("_hash", "text_sha256").agg(
        F.min("_row").alias("_row")
    )
    kept = first.select("_row", F.lit(True).alias("_first"))
    return marked.join(kept, "_row", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("_first", F.lit(False)).alias("kept"), "text_sha256",
        F.col("_row").alias("row"),
    )
