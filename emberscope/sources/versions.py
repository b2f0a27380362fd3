"""Stored tables whose writes show all at once or not at all.

A write goes to a folder of its own below ``data``. When it is complete and has passed its
audits, a small manifest below ``_versions`` names the folders that now make up the table,
by day or as a whole. Readers take the newest manifest, so a run that breaks off before
it, or fails an audit, leaves the table as it was. Two writers that start from the same
version cannot both commit. The rows are counted by the writing job itself.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberscope.operators.audits import observed, require_metrics

DATE = "acq_date"
WHOLE = ""  # key of a table that is not stored by day


class CommitConflict(RuntimeError):
    """Another writer has committed the next version."""


def _files(spark: SparkSession, path: str):
    """File system and path of a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/_versions") if n.endswith(".json")]


def _manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """A manifest, or None when its writer broke off inside it."""
    fs, at = _files(spark, f"{path}/_versions/{version:010d}.json")
    stream = fs.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def newest(spark: SparkSession, path: str) -> dict | None:
    for version in reversed(versions(spark, path)):
        found = _manifest(spark, path, version)
        if found is not None:
            return found
    return None


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Write the manifest of a version; a file that is there already is left alone."""
    fs, at = _files(spark, f"{path}/_versions/{version:010d}.json")
    try:
        out = fs.create(at, False)
    except Exception as e:
        raise CommitConflict(f"{path}: version {version} is taken") from e
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()


def _write(df: DataFrame, path: str, date: str | None, replaced, min_rows: int | None) -> dict[str, int]:
    spark = df.sparkSession
    known = versions(spark, path)
    before = newest(spark, path) or {"parts": {}}
    run = uuid.uuid4().hex
    target = f"{path}/data/run={run}"
    laid_out = df.hint("rebalance", date) if date else df
    # Observed last, so that the tasks that write are those that count.
    counted, metrics = observed(laid_out, f"write-{run}")
    writer = counted.write.partitionBy(date) if date else counted.write
    writer.parquet(target)
    found = metrics.get
    if min_rows is not None:
        require_metrics(found, path, min_rows)
    if date:
        days = {n.removeprefix(f"{date}=") for n in _names(spark, target) if n.startswith(f"{date}=")}
        gone = days | {d.isoformat() for d in replaced}
        parts = {d: r for d, r in before["parts"].items() if d not in gone and d != WHOLE} | dict.fromkeys(days, run)
    else:
        parts = {WHOLE: run}
    manifest = {"schema": df.schema.json(), "date": date, "parts": parts}
    _commit(spark, path, max(known, default=0) + 1, manifest)
    return {"n_rows": found.get("n_rows", 0)}


def refresh(df: DataFrame, path: str, min_rows: int | None = None) -> dict[str, int]:
    """The table becomes ``df``. With ``min_rows`` it must have more rows than that."""
    return _write(df, path, None, (), min_rows)


def replace_days(
    df: DataFrame,
    path: str,
    interval: tuple[datetime.date, datetime.date] | None = None,
    date: str = DATE,
    min_rows: int | None = None,
) -> dict[str, int]:
    """The days of ``df`` replace those of the table; with an interval all its days do.

    Days of the interval without new rows end up empty, rows outside it are not written.
    """
    days = []
    if interval:
        start, end = interval
        df = df.filter(F.col(date).between(F.lit(start), F.lit(end)))
        days = [start + datetime.timedelta(days=n) for n in range((end - start).days + 1)]
    return _write(df, path, date, days, min_rows)


def read_table(
    spark: SparkSession, path: str, start: datetime.date | None = None, end: datetime.date | None = None
) -> DataFrame:
    """The newest version; of a table stored by day only the folders of the interval."""
    manifest = newest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"{path} has no version yet")
    schema, date = T.StructType.fromJson(json.loads(manifest["schema"])), manifest["date"]
    low, high = start.isoformat() if start else "", end.isoformat() if end else "~"
    parts = [
        f"{path}/data/run={run}" + (f"/{date}={day}" if date else "")
        for day, run in sorted(manifest["parts"].items())
        if not date or low <= day <= high
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*parts).select(*schema.names)


def drop_unused(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete folders that none of the newest ``keep`` versions names.

    For a quiet table: a write under way is not named yet.
    """
    named = set()
    for version in versions(spark, path)[-keep:]:
        named |= set((_manifest(spark, path, version) or {"parts": {}})["parts"].values())
    for name in _names(spark, f"{path}/data"):
        if name.removeprefix("run=") not in named:
            fs, at = _files(spark, f"{path}/data/{name}")
            fs.delete(at, True)
