"""Stored tables: daily replacement, upserts, full refresh."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.session import cut_lineage

DATE = "acq_date"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def replace_days(df: DataFrame, path: str, date: str = DATE) -> None:
    """Write ``df`` so that each of its days replaces that day in the table.

    Days not in ``df`` stay. The rebalance hint makes files of even size and
    splits a day that is far larger than the others.
    """
    (
        df.hint("rebalance", date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )


def replace_interval(
    df: DataFrame, path: str, start: datetime.date, end: datetime.date, date: str = DATE
) -> None:
    """Replace the closed interval: days without new rows are emptied, others stay.

    ``df`` must not read the table. The driver lists the days of the interval only.
    """
    spark = df.sparkSession
    new = cut_lineage(df.filter(F.col(date).between(F.lit(start), F.lit(end))))
    filled = {r[0] for r in new.select(date).distinct().collect()}
    if filled:
        replace_days(new, path, date)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for n in range((end - start).days + 1):
        day = start + datetime.timedelta(days=n)
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{date}={day.isoformat()}")
        fs = folder.getFileSystem(conf)
        if day not in filled and fs.exists(folder):
            fs.delete(folder, True)


def held_days(new: DataFrame, path: str, date: str = DATE) -> DataFrame:
    """What the table holds of the days of ``new``; other partitions are not listed.

    The first and last day are literals, so they prune; the days between that ``new``
    lacks go by the join.
    """
    first, last = new.agg(F.min(date), F.max(date)).first()
    days = new.select(date).distinct()
    return read_interval(new.sparkSession, path, first, last, date).join(days, date, "left_semi")


def read_interval(
    spark: SparkSession, path: str, start: datetime.date, end: datetime.date, date: str = DATE
) -> DataFrame:
    """Rows of the closed interval; only those day folders are read."""
    return spark.read.parquet(path).filter(F.col(date).between(F.lit(start), F.lit(end)))


def merge_by_key(current: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """New rows plus the current rows whose key they do not carry."""
    return current.join(new.select(key), key, "left_anti").unionByName(new)


def lookback_start(end: datetime.date, days: int) -> datetime.date:
    return end - datetime.timedelta(days=days)


def upsert_days(new: DataFrame, path: str, key: str | list[str], date: str = DATE) -> None:
    """Upsert by key into a table stored by day, touching only the days of ``new``.

    A key keeps its date, so its old row can only be in a day that ``new`` has.
    The rows to keep are cut off before their days are replaced.
    """
    spark = new.sparkSession
    merged = new
    if path_exists(spark, path):
        new = cut_lineage(new)
        held = held_days(new, path, date)
        merged = cut_lineage(merge_by_key(held.select(*new.columns), new, key))
    replace_days(merged, path, date)


def table_names(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))
