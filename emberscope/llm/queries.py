"""The registered queries of this subpackage: whole tables in, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.llm import bpe, chat, exact_dedup, fingerprints, jaccard_join, lexical_search, licences, line_dedup
from emberscope.llm import packing, quality, secret_scan, spelling, token_files
from emberscope.llm.storage import documents, text_of
from emberscope.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
CAPACITY = 2048


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir), licences.known_licences(spark))
    return found.select(
        "doc_id",
        F.array_join("licences", ",").alias("licences"),
        F.array_join("levels", ",").alias("levels"),
        F.size("licences").cast("long").alias("n_licences"),
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    back = chat.read_back(chat.format_conversations(given.unionByName(more)))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), CAPACITY, end_id=0, keep_ids=False
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir)).drop("row")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256")
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs of three lines, shorter ones of many words, and whole short documents."""
    cut = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(text_of(), 256).alias("text_sha256"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that the whole of ``op6_line_dedup`` had at first."""
    return op6_line_dedup(spark, sf_dir)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = documents(spark, sf_dir).select(F.col("doc_id").alias("path"), "text")
    found, _, _ = secret_scan.scan_versions(versions)
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(kinds))
    return found.select(
        F.col("path").alias("doc_id"),
        *(count(k).alias(f"n_{k}") for k in kinds),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.read_documents(spark, path)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir), items, k=50)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_licence_scan, op2_chat_format, op3_best_fit_packing, op4_exact_dedup, op5_bpe, op6_line_dedup,
        op6_passage_dedup, op7_jaccard_join, op8_secret_scan, op9_quality_rules, op10_token_files, op11_lexical_search,
        op12_spelling_variants, op13_fingerprints, pipeline,
    )
}
