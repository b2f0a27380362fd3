"""A whole run by its settings: every table stored, audited as it is written."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.config import Config
from emberscope.operators.nearest import nearest_settlement
from emberscope.operators.spatial import points_in_polygons, polygon_cover
from emberscope.plans import marts
from emberscope.plans import validation as val
from emberscope.plans.events import cluster_events
from emberscope.plans.export import export
from emberscope.session import join_by_measured_size
from emberscope.sources import polygons, versions

# The tables that must not be empty, in the order they are built.
AUDITED = (
    "detections",
    "to_validate",
    "validated",
    "clustered",
    "nearest_places",
    "detection_mart",
    "event_mart",
)


@dataclass(frozen=True)
class Inputs:
    """Tables of a run. Areas left out are read from the paths of the settings."""

    detections: DataFrame  # firms_id, acq_date, lon, lat
    admin: DataFrame
    places: DataFrame
    scenes: DataFrame
    pixels: DataFrame
    buildings: DataFrame | None = None
    include: DataFrame | None = None  # area_id, rings and box
    exclude: DataFrame | None = None  # exclude_id, rings and box


def _areas(spark: SparkSession, given: DataFrame | None, path: str | None, key: str, rejects: str) -> DataFrame:
    """Areas as given, or read from ``path``; rejected ones of a read are kept in ``rejects``."""
    if given is not None:
        return given
    usable, rejected = polygons.read_areas(spark, path)
    if path is not None:
        versions.refresh(rejected, rejects)
    return usable.withColumnRenamed("id", key)


def build(
    cfg: Config,
    inputs: Inputs,
    path: str,
    start: datetime.date,
    end: datetime.date,
    as_of: datetime.date,
    audit_rows: int = 1,
) -> DataFrame:
    """Build all tables below ``path`` and return table_name and n_rows of each.

    Every table is counted by the job that writes it and shows only if it has more than
    ``audit_rows`` rows; a failing audit ends the run and leaves the table and those after
    it as they were. Detections outside ``start .. end`` stay in the stored tries.
    """
    spark = inputs.detections.sparkSession
    join_by_measured_size(spark)
    counts: list[tuple[str, int]] = []

    def store(df: DataFrame, name: str, by_day: bool = False) -> DataFrame:
        table = f"{path}/{name}"
        if by_day:
            done = versions.replace_days(df, table, (start, end), min_rows=audit_rows)
            stored = versions.read_table(spark, table)
        else:
            done = versions.refresh(df, table, audit_rows)
            stored = versions.read_table(spark, table)
        counts.append((name, done["n_rows"]))
        return stored

    areas = _areas(spark, inputs.include, cfg.path_include, "area_id", f"{path}/include_rejected")
    excluded = _areas(spark, inputs.exclude, cfg.path_exclude, "exclude_id", f"{path}/exclude_rejected")
    include = polygon_cover(areas, ["area_id"], cfg.cell_deg)
    admin = polygon_cover(inputs.admin, cfg_names(cfg), cfg.cell_deg)

    held = store(inputs.detections, "detections", by_day=True)
    candidates = store(val.to_validate(held, include), "to_validate")
    val.run_tries(
        candidates, areas, inputs.scenes, inputs.pixels, inputs.buildings, cfg.imagery, f"{path}/tries",
        start, end, as_of, cfg.retry_ages_days, cfg.validation_lookback_days,
    )
    first, last = candidates.agg(F.min("acq_date"), F.max("acq_date")).first()
    tries = val.held_tries(spark, f"{path}/tries", first, last, len(cfg.retry_ages_days))
    positions = candidates.select(*val.KEY, "lon", "lat").distinct()
    cover = polygon_cover(excluded, ["exclude_id"], cfg.cell_deg)
    validated = store(val.combine_tries([t for t in tries if t is not None], positions, cover), "validated")
    in_areas = points_in_polygons(validated, include)
    clustered = store(
        cluster_events(in_areas, cfg.cluster_max_date_gap, cfg.cluster_max_distance_m), "clustered"
    )
    store(
        nearest_settlement(validated.select(*val.KEY, "lon", "lat"), inputs.places, cfg.settlement_max_distance_m)
        .filter("settlement_name IS NOT NULL"),
        "nearest_places",
    )
    reach = cfg.settlement_max_distance_m
    detections = store(
        marts.detection_mart(validated, include, clustered, inputs.places, admin, cfg.gadm_level, reach),
        "detection_mart",
    )
    events = store(
        marts.event_mart(clustered, inputs.places, admin, cfg.gadm_level, reach), "event_mart"
    )
    if cfg.path_output:
        export(detections, events, cfg.path_output, add_links=True, date_buffer_days=cfg.link_date_buffer_days)
    return spark.createDataFrame(counts, "table_name string, n_rows long")


def cfg_names(cfg: Config) -> list[str]:
    return ["country_id", *cfg.admin_columns]
