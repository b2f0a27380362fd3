"""Data audits: each returns a small report frame or raises."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class AuditError(AssertionError):
    pass


def has_more_rows_than(df: DataFrame, threshold: int = 1) -> bool:
    """True when the count exceeds the threshold; reads no more rows than needed."""
    return df.limit(threshold + 1).count() > threshold


def require_rows(df: DataFrame, name: str, threshold: int = 1) -> DataFrame:
    if not has_more_rows_than(df, threshold):
        raise AuditError(f"{name}: {threshold} rows or fewer")
    return df


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` whose rows are counted by the job that reads it, and the count to come."""
    metrics = Observation(name)
    return df.observe(metrics, F.count("*").alias("n_rows")), metrics


def require_metrics(metrics: dict[str, int], name: str, threshold: int = 1) -> None:
    """Fail unless more rows than ``threshold`` were counted; no second read."""
    if metrics.get("n_rows", 0) <= threshold:
        raise AuditError(f"{name}: {threshold} rows or fewer")


def duplicate_keys(df: DataFrame, grain: list[str]) -> DataFrame:
    """Keys of the declared grain that occur more than once."""
    return df.groupBy(*grain).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def missing_days(df: DataFrame, start, end, date: str = "acq_date") -> DataFrame:
    """Days of the closed range ``start..end`` without rows."""
    days = day_list(df.sparkSession, start, end, date)
    return days.join(df.select(date).distinct(), date, "left_anti")


def day_list(spark, start, end, name: str = "acq_date") -> DataFrame:
    """All days from start to end, both included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(name)
    )
