"""Tables written to the shared folder, so that a lost executor never repeats earlier stages."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores added as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def placed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name`` that tells its rows apart: file and place in the file.

    It is the same in every later job, however the scan is split then. That needs rows that
    stand in Parquet files; any other frame is stored first.
    """
    nodes = re.findall(r"^[\s:+-]*(\w+)", df._jdf.queryExecution().analyzed().toString(), re.M)
    if not set(nodes) <= {"Relation", "Project", "Filter"} or "_metadata" in df.columns:
        df = stored(df, "placed")
    return df.withColumn(name, F.struct("_metadata.file_path", "_metadata.row_index"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text"):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
