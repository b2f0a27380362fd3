"""Events: validated detections grouped by area and date gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.operators.extent import event_extent
from emberscope.operators.islands import assign_events

EVENT_KEYS = ["area_id", "event_no"]


def event_centroids(detections: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the distinct positions of an event."""
    return (
        detections.select(*keys, "lon", "lat")
        .distinct()
        .groupBy(*keys)
        .agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    )


def event_measures(detections: DataFrame, keys: list[str]) -> DataFrame:
    """Dates, most frequent image dates, shares and counts per event.

    All aggregates combine on the map side, so a hot event sends one small state
    per task. Ties of the most frequent date go to the earliest one.
    """
    return detections.groupBy(*keys).agg(
        F.min("acq_date").alias("start_date"),
        F.max("acq_date").alias("end_date"),
        F.mode("before_date", True).alias("before_date"),
        F.mode("after_date", True).alias("after_date"),
        F.avg(F.col("burn_scar_detected").cast("int")).alias("burn_scar_detected"),
        F.avg("burnt_pixel_count").alias("burnt_pixel_count"),
        F.avg("burnt_building_count").alias("burnt_building_count"),
        F.avg(F.col("no_data").cast("int")).alias("no_data"),
        F.avg(F.col("too_cloudy").cast("int")).alias("too_cloudy"),
        F.count("*").alias("event_count"),
    )


def cluster_events(
    detections: DataFrame,
    max_gap: int = 2,
    max_pair_distance_m: float | None = None,
    axis_order: str = "lonlat",
    cross_area: bool = False,
) -> DataFrame:
    """One row per (area_id, event_no).

    ``detections`` are validated detections joined with their areas (one row per
    detection and area); they are read three times, so pass a stored table or a
    checkpointed frame. ``max_pair_distance_m`` looks only at pairs that close;
    ``cross_area`` credits pairs that reach into other areas (see
    :mod:`emberscope.operators.pairs`).
    """
    numbered = assign_events(detections, "area_id", "acq_date", max_gap)
    if cross_area:
        from emberscope.operators.pairs import extent_across_areas

        extent = extent_across_areas(numbered, axis_order=axis_order)
    elif max_pair_distance_m is not None:
        from emberscope.operators.pairs import extent_within

        extent = extent_within(numbered, EVENT_KEYS, max_pair_distance_m, axis_order=axis_order)
    else:
        extent = event_extent(numbered, EVENT_KEYS, axis_order=axis_order)
    return (
        event_measures(numbered, EVENT_KEYS)
        .join(event_centroids(numbered, EVENT_KEYS), EVENT_KEYS)
        .join(extent, EVENT_KEYS, "left")
        .withColumn("max_distance", F.coalesce("max_distance", F.lit(0.0)))
    )


def on_event_days(detections: DataFrame, events: DataFrame) -> DataFrame:
    """Join detections with the event of their area whose dates cover theirs.

    Events of one area never overlap, so unfolding them into days turns the range
    condition into an equality on (area, day), which also spreads a hot area.
    """
    days = events.withColumn(
        "acq_date", F.explode(F.expr("sequence(start_date, end_date, interval 1 day)"))
    ).select(*EVENT_KEYS, "acq_date")
    return detections.join(days, ["area_id", "acq_date"])
