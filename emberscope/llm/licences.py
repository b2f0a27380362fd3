"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, lines that state a copyright removed,
equivalent spellings made one, punctuation and white space runs one space. Its digest is
joined to the digests of known licences. Entire units are compared, never parts of them:
the whole document, each of its paragraphs (between blank lines) and each of its lines.

Null and empty texts have no units and no licences. Units repeated in a document count
once. Repeated rows and null ids keep their rows, an empty table gives an empty result,
extra columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of
from emberscope.session import broadcast_if_small

KNOWN_MAX = 10_000

# Spellings that count as one.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "non commercial": "noncommercial",
    "organisation": "organization",
    "authorised": "authorized",
    "favour": "favor",
    "merchantibility": "merchantability",
    "per cent": "percent",
    "copyright holder": "copyright owner",
    "https": "http",
}

# A line that states a copyright: the word with a mark or year, or the mark itself.
OWNER_LINE = r"(?m)^[^\p{L}\n©(]*(copyright\s*(\(c\)|©|[0-9]{4})|\(c\)|©)[^\n]*$"

# Short notices by which works name their licence.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)


def canonical(text: Column) -> Column:
    no_owner = F.regexp_replace(F.lower(text), OWNER_LINE, " ")
    words = F.concat(F.lit(" "), F.regexp_replace(no_owner, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for a, b in SPELLINGS.items():
        words = F.replace(words, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(words)


def known_digests(known: DataFrame) -> DataFrame:
    """``digest, licence_id`` of known texts (``licence_id, text``); the least id of equal texts."""
    digest = F.sha2(canonical(F.col("text")), 256)
    return (
        known.filter(canonical(F.col("text")) != "").groupBy(digest.alias("digest")).agg(F.min("licence_id").alias("licence_id"))
    )


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "licence_id string, text string")


def known_licences(spark: SparkSession) -> DataFrame:
    """The notices, and the full texts and standard headers in ``licence_texts/<licence_id>``."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*/*.txt"))
    texts = [(f.parent.name, f.read_text(encoding="utf-8")) for f in files]
    return spark.createDataFrame([*NOTICES, *texts], "licence_id string, text string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, sorted ``licences`` (id) and ``levels`` at which they were found.

    The known table is broadcast up to ``KNOWN_MAX`` digests; beyond, the join shuffles
    digests only. Units meet it as soon as they are made; only hits are grouped by document.
    """
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), text_of().alias("_text"))
    table = broadcast_if_small(stored(known_digests(known), "licences"), KNOWN_MAX)
    level = lambda name, texts: F.transform(texts, lambda t: F.struct(F.lit(name).alias("level"), t.alias("unit")))
    units = F.concat(
        level("document", F.array("_text")),
        level("paragraph", F.split("_text", r"\n[\x20\x09-\x0D]*\n", -1)),
        level("line", F.split("_text", "\n", -1)),
    )
    hits = (
        rows.select("doc_id", "_row", F.explode(units).alias("u"))
        .select("doc_id", "_row", "u.level", F.sha2(canonical(F.col("u.unit")), 256).alias("digest"))
        .join(table, "digest")
        .groupBy("_row")
        .agg(F.collect_set("licence_id").alias("licences"), F.collect_set("level").alias("levels"))
    )
    ids = rows.select("doc_id", "_row")
    none = F.array().cast("array<string>")
    return ids.join(hits, "_row", "left").select(
        "doc_id",
        F.sort_array(F.coalesce("licences", none)).alias("licences"),
        F.sort_array(F.coalesce("levels", none)).alias("levels"),
    )
