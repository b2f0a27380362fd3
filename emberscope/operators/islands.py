"""Events: detections of one area chained by date gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_islands(
    days: DataFrame, group: str = "area_id", date: str = "acq_date", max_gap: int = 2
) -> DataFrame:
    """Distinct (group, date) rows numbered by event.

    A new event starts at the first date of the group and wherever more than
    ``max_gap`` days have passed. The windows run on distinct dates, so their
    partitions hold at most one row per calendar day however hot a group is.
    """
    ordered = Window.partitionBy(group).orderBy(F.col(date).asc_nulls_last())
    gap = F.datediff(F.col(date), F.lag(date).over(ordered))
    return (
        days.select(group, date)
        .distinct()
        .withColumn("prev_date", F.lag(date).over(ordered))
        .withColumn("date_gap", gap)
        .withColumn(
            "starts_event",
            F.when(F.col("date_gap").isNull() | (F.col("date_gap") > max_gap), 1).otherwise(0),
        )
        .withColumn("event_no", F.sum("starts_event").over(ordered).cast("int"))
    )


def assign_events(
    detections: DataFrame, group: str = "area_id", date: str = "acq_date", max_gap: int = 2
) -> DataFrame:
    """Add ``event_no`` to every detection."""
    islands = date_islands(detections, group, date, max_gap).select(group, date, "event_no")
    return detections.join(islands, [group, date])
