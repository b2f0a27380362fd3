"""From detection files to the stored detection table."""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.functions.scalars import stable_detection_id
from emberscope.operators.numbering import number_rows_per_interval
from emberscope.operators.spatial import clip_to_union
from emberscope.sources import detections as src
from emberscope.sources.tables import replace_days, replace_interval


def ingest(
    spark: SparkSession,
    paths: str | list[str],
    admin: DataFrame,
    country_id: str,
    strict: bool = False,
    cell_deg: float = 0.1,
) -> tuple[DataFrame, DataFrame | None]:
    """(raw detections inside the country, rejected records or None when strict)."""
    raw = src.scan_detections(spark, paths)
    if strict:
        valid, rejected = src.require_valid(raw), None
    else:
        valid, rejected = src.check_records(raw)
    inside = clip_to_union(valid, admin, cell_deg, "longitude", "latitude")
    return src.to_raw_table(inside, country_id), rejected


def detection_table(
    raw: DataFrame, start: datetime.date, end: datetime.date, ids: str = "stable"
) -> DataFrame:
    """id, acq_date and position of the raw rows of a closed interval.

    ``ids='stable'`` hashes the record's identity; ``ids='interval'`` numbers the
    rows of each day from 1 in time and place order.
    """
    rows = raw.filter(F.col("acq_date").between(F.lit(start), F.lit(end))).select(
        "acq_date",
        "acq_time",
        F.col("longitude").alias("lon"),
        F.col("latitude").alias("lat"),
        "satellite",
    )
    if ids == "stable":
        numbered = rows.withColumn("id", stable_detection_id())
    elif ids == "interval":
        numbered = number_rows_per_interval(rows, tie_breakers=["satellite"])
    else:
        raise ValueError("ids must be 'stable' or 'interval'")
    return numbered.select("id", "acq_date", "lon", "lat")


def load_days(
    spark: SparkSession,
    paths,
    admin: DataFrame,
    country_id: str,
    table: str,
    interval: tuple[datetime.date, datetime.date] | None = None,
    strict: bool = False,
) -> None:
    """Ingest files and replace their days in the raw table.

    With an interval, its days without records are emptied as well. Rejected records go to
    ``<table>-rejected`` unless ``strict``, which fails on them: one folder for each set of
    paths, so a load that is run again replaces its own and no others.
    """
    raw, rejected = ingest(spark, paths, admin, country_id, strict)
    if rejected is not None:
        named = "\n".join(sorted([paths] if isinstance(paths, str) else paths))
        load = hashlib.md5(named.encode()).hexdigest()
        rejected.write.mode("overwrite").parquet(f"{table}-rejected/load={load}")
    if interval:
        replace_interval(raw, table, *interval)
    else:
        replace_days(raw, table)
