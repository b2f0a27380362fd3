"""Settlement dumps and country codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.schemas import SETTLEMENT_DUMP
from emberscope.session import broadcast_if_small


def scan_settlements(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Name and position of every settlement of a headerless 19-column dump."""
    return (
        spark.read.schema(SETTLEMENT_DUMP)
        .option("sep", sep)
        .option("quote", "")
        .option("header", False)
        .csv(path)
        .select("name", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    )


def with_alpha2(
    df: DataFrame, codes: DataFrame, alpha3: str = "country_id", out: str = "country_iso2"
) -> DataFrame:
    """Add the two-letter code by lookup in ``codes`` (alpha3, alpha2)."""
    lookup = codes.select(F.col("alpha3").alias(alpha3), F.col("alpha2").alias(out))
    return df.join(broadcast_if_small(lookup), alpha3, "left")


def unknown_codes(df: DataFrame, codes: DataFrame, alpha3: str = "country_id") -> DataFrame:
    """Country codes the list does not have, with their row counts."""
    lookup = codes.select(F.col("alpha3").alias(alpha3))
    return (
        df.join(broadcast_if_small(lookup), alpha3, "left_anti")
        .groupBy(alpha3)
        .agg(F.count("*").alias("n_rows"))
    )
