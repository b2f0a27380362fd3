"""Final tables: detections and events with settlement and administrative names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.operators.nearest import nearest_settlement
from emberscope.operators.spatial import PolygonCover, points_in_polygons
from emberscope.plans.events import EVENT_KEYS, on_event_days

DETECTION_RESULTS = [
    "before_date",
    "after_date",
    "no_data",
    "too_cloudy",
    "validation_try",
    "burn_scar_detected",
    "burnt_pixel_count",
    "burnt_building_count",
]


def admin_columns(level: int) -> list[str]:
    if level not in (1, 2, 3):
        raise ValueError("gadm_level must be 1, 2 or 3")
    return ["country_id", "gadm_1", "gadm_2", "gadm_3"][: level + 1]


def detection_mart(
    validated: DataFrame,
    include: PolygonCover,
    events: DataFrame,
    places: DataFrame,
    admin: PolygonCover,
    level: int,
    max_settlement_distance_m: float | None = 10_000.0,
) -> DataFrame:
    """One row per validated detection, area, event and admin polygon it touches."""
    in_areas = points_in_polygons(validated, include)
    in_events = on_event_days(in_areas, events)
    in_admin = points_in_polygons(in_events, admin)
    return nearest_settlement(in_admin, places, max_settlement_distance_m).select(
        "firms_id",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "acq_date",
        *admin_columns(level),
        "settlement_name",
        "settlement_distance",
        F.col("area_id").alias("area_include_id"),
        "event_no",
        *DETECTION_RESULTS,
    )


def event_mart(
    events: DataFrame,
    places: DataFrame,
    admin: PolygonCover,
    level: int,
    max_settlement_distance_m: float | None = 10_000.0,
    settlement_per: str = "event",
) -> DataFrame:
    """One row per event and admin polygon its centre touches.

    An event whose centre lies outside all admin polygons drops out.
    ``settlement_per='area'`` shares the settlement closest to any event of the
    area among all its events, as the original keyed it on the area alone.
    """
    if settlement_per == "event":
        named = nearest_settlement(events, places, max_settlement_distance_m)
    elif settlement_per == "area":
        shared = (
            nearest_settlement(
                events.select("area_id", "lon", "lat"), places, max_settlement_distance_m
            )
            .groupBy("area_id")
            .agg(
                F.expr("min(struct(settlement_distance, settlement_name))"
                       " FILTER (WHERE settlement_name IS NOT NULL)").alias("s")
            )
            .select(
                "area_id",
                F.col("s.settlement_name").alias("settlement_name"),
                F.col("s.settlement_distance").alias("settlement_distance"),
            )
        )
        named = events.join(shared, "area_id", "left")
    else:
        raise ValueError("settlement_per must be 'event' or 'area'")
    measures = [c for c in events.columns if c not in (*EVENT_KEYS, "lon", "lat")]
    return points_in_polygons(named, admin).select(
        F.col("area_id").alias("area_include_id"),
        "event_no",
        *measures,
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        *admin_columns(level),
        "settlement_name",
        "settlement_distance",
    )
