"""File sinks and reading earlier outputs back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else df


def write_csv(df: DataFrame, path: str, order: list[str] = ()) -> None:
    """Headed CSV parts; ``order`` sorts the rows across the parts."""
    in_order(df, order).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, date: str = "acq_date") -> None:
    df.hint("rebalance", date).write.mode("overwrite").partitionBy(date).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def serialize(df: DataFrame, out: str = "record") -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def deserialize(df: DataFrame, schema, column: str = "record") -> DataFrame:
    return df.select(F.from_json(column, schema).alias("r")).select("r.*")
