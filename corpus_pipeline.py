"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``docs``. Rows are told apart by their place in the stored files, so null or repeated
ids lose no rows, and a scan split another way finds the same rows (stage 3 decides by id: rows sharing one stay or go together). Empty
tables pass through; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.llm import exact_dedup, jaccard_join, packing, quality
from emberscope.llm import secret_scan as scans
from emberscope.llm.queries import CAPACITY, vocabulary
from emberscope.llm.storage import documents, fresh, placed, stored, text_of
from emberscope.session import broadcast_if_small

# Marked rows that are sent to every task; each carries the name of its file.
FEW = 50_000


def _without(docs: DataFrame, rows: DataFrame, at: str) -> DataFrame:
    """``docs`` without the given rows; they are broadcast only if measured to be few."""
    return docs.join(broadcast_if_small(stored(rows, "dropped"), FEW), at, "left_anti").drop(at)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits and the robust estimate keep."""
    at = fresh(docs, "__row")
    rows = placed(docs, at)
    return _without(rows, quality.judge(rows, at).filter(~F.col("kept")).select(F.col("row").alias(at)), at)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id."""
    at = fresh(docs, "__row")
    rows = placed(docs, at)
    marks = exact_dedup.mark_duplicates(rows, row=at)
    return _without(rows, marks.filter(~F.col("kept")).select(F.col("row").alias(at)), at)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id."""
    found = jaccard_join.link_documents(docs).filter(F.col("doc_id") != F.col("component_id"))
    dropped = stored(found.select("doc_id").distinct(), "dropped")
    return docs.join(broadcast_if_small(dropped), "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every finding masked; ``n_chars`` follows the text."""
    at, found = fresh(docs, "__row"), fresh(docs, "__spans")
    rows = placed(docs, at)
    versions = rows.select(F.col(at).alias("path"), "text")
    spans = scans.scan_versions(versions)[0].filter(F.size("spans") > 0)
    spans = stored(spans.select(F.col("path").alias(at), F.col("spans").alias(found)), "spans")
    marked = rows.join(broadcast_if_small(spans, FEW), at, "left")
    none = F.col(found).isNull()
    clean = F.when(none, F.col("text")).otherwise(scans.masked(text_of(), F.col(found)))
    out = marked.withColumn("text", clean)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(none, F.col("n_chars")).otherwise(size))
    return out.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token piece in sequences of ``CAPACITY`` tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), CAPACITY, end_id=0, keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# Robust estimates, shingle components and packing are beyond SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
