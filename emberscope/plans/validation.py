"""Imagery validation of a batch, the timed retries and their combination."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.config import ImageryParams
from emberscope.operators import imagery
from emberscope.operators.spatial import (
    PolygonCover,
    outside_polygons,
    points_in_polygons,
    touching_every_polygon,
)
from emberscope.session import cut_lineage
from emberscope.sources.tables import lookback_start, path_exists, read_interval, upsert_days

# Ids are 64-bit hashes; with the date, equal hashes of different days stay apart.
KEY = ["firms_id", "acq_date"]

RESULT_COLUMNS = [
    "firms_id",
    "acq_date",
    "before_date",
    "after_date",
    "burn_scar_detected",
    "burnt_pixel_count",
    "burnt_building_count",
    "no_data",
    "too_cloudy",
]


def to_validate(detections: DataFrame, include: PolygonCover) -> DataFrame:
    """Detections inside an include area, one row per (detection, area)."""
    return points_in_polygons(
        detections.selectExpr("firms_id", "acq_date", "lon", "lat"), include
    )


def due_for_try(
    candidates: DataFrame,
    as_of: datetime.date,
    min_age_days: int,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Candidates old enough, and for a retry those the previous try left open."""
    due = candidates.filter(
        F.col("acq_date") < F.lit(as_of - datetime.timedelta(days=min_age_days))
    )
    if previous is None:
        return due
    left_open = previous.filter("no_data OR too_cloudy").select(*KEY)
    return due.join(left_open, KEY, "left_semi")


def one_area_each(candidates: DataFrame) -> DataFrame:
    """A detection in several areas is checked for the smallest area id."""
    return candidates.groupBy(*KEY).agg(
        F.min("area_id").alias("area_id"), *[F.first(c).alias(c) for c in ("lon", "lat")]
    )


def results_of(
    judged: DataFrame, pixels: DataFrame, buildings: DataFrame | None, params: ImageryParams
) -> DataFrame:
    """Results of detections whose scenes are chosen, by one pass over the pixels.

    ``judged`` is cut off; it may hold the rows of several tries. The burnt pixels
    are checkpointed, as counting reads them more than once.
    """
    looks = imagery.looks_of(judged, params)
    burnt = cut_lineage(imagery.burnt_pixels(pixels, looks, params))
    counts = imagery.burnt_counts(looks, burnt, buildings, params)
    threshold = params.burnt_pixel_count_threshold
    tries = ["validation_try"] if "validation_try" in judged.columns else []
    return (
        judged.join(counts, imagery.LOOK, "left")
        .selectExpr(
            "firms_id",
            "acq_date",
            "before_date",
            "after_date",
            f"coalesce(burnt_pixel_count, 0) > {threshold} AS burn_scar_detected",
            "coalesce(burnt_pixel_count, 0) AS burnt_pixel_count",
            "coalesce(burnt_building_count, 0) AS burnt_building_count",
            "no_data",
            "too_cloudy",
            *tries,
        )
    )


def _days_of(checks: DataFrame) -> tuple[datetime.date | None, datetime.date | None]:
    return tuple(checks.agg(F.min("acq_date"), F.max("acq_date")).first())


def validate_batch(
    candidates: DataFrame,
    areas: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    buildings: DataFrame | None,
    params: ImageryParams,
) -> DataFrame:
    """Check a batch against imagery: one result row per firms_id.

    Order as in the checks themselves: no scenes around the date, only cloudy
    scenes around the date, then the pixels of the nearest clear scenes.
    """
    checks = cut_lineage(one_area_each(candidates))
    used = areas.join(checks.select("area_id").distinct(), "area_id", "left_semi")
    known = imagery.scenes_of_days(scenes, *_days_of(checks), params)
    judged = cut_lineage(imagery.judge(checks, used, known, params))
    return results_of(judged, pixels, buildings, params)


def judge_tries(
    checks: DataFrame,
    areas: DataFrame,
    scenes: DataFrame,
    params: ImageryParams,
    as_of: datetime.date,
    ages_days: tuple[int, ...] = (11, 16, 21),
    held: list[DataFrame | None] | None = None,
) -> DataFrame:
    """Scene choices of all tries that are due, one row per detection and try; cut off.

    Whether a try leaves a detection open depends on scenes alone, so all tries are
    known before any pixel is read: the choices of every try are found together, once
    per scene group and date, and the row of a detection runs through its tries.
    ``checks`` have one area each and are cut off. A column ``known_from`` of the
    scenes names the first try that knows them. ``held`` are stored results of earlier
    runs; a detection judged now counts as judged, else as stored.
    """
    n = len(ages_days)
    used = areas.join(checks.select("area_id").distinct(), "area_id", "left_semi")
    known = imagery.scenes_of_days(scenes, *_days_of(checks), params)
    if "known_from" in known.columns:
        known = known.filter(f"known_from < {n}").selectExpr(
            "*", f"explode(sequence(CAST(known_from AS INT), {n - 1})) AS scene_try"
        )
    groups, days = imagery.scene_calendar(used, known, params)
    grouped = checks.join(groups, "area_id", "left")
    outcomes = imagery.outcomes_by_try(imagery.scene_choice(grouped, days, params), n)
    rows = grouped.join(outcomes, ["scene_group", "acq_date"], "left")
    # Without any scenes: no data, and nothing else.
    nothing = ", ".join(
        f"{value} AS {name}"
        for name, value in zip(imagery.OUTCOME, ("true", "false", *["CAST(NULL AS DATE)"] * 2, *["NULL"] * 2))
    )
    left_open = "false"
    for try_no, age in enumerate(ages_days):
        limit = as_of - datetime.timedelta(days=age)
        due = f"acq_date < DATE'{limit}'" + (f" AND {left_open}" if try_no else "")
        rows = rows.withColumn(f"_due_{try_no}", F.expr(due)).withColumn(
            f"_found_{try_no}", F.expr(f"coalesce(outcome_{try_no}, struct({nothing}))")
        )
        stored = "false"
        if held and held[try_no] is not None:
            flags = held[try_no].selectExpr(*KEY, f"no_data OR too_cloudy AS _held_{try_no}")
            rows, stored = rows.join(flags, KEY, "left"), f"coalesce(_held_{try_no}, false)"
        left_open = f"IF(_due_{try_no}, _found_{try_no}.no_data OR _found_{try_no}.too_cloudy, {stored})"
    tries = ", ".join(
        f"IF(_due_{t}, struct({t} AS validation_try, _found_{t} AS found), NULL)" for t in range(n)
    )
    return cut_lineage(
        rows.selectExpr(*checks.columns, f"inline(array_compact(array({tries})))").selectExpr(
            *checks.columns, "found.*", "validation_try"
        )
    )


def validate_all_tries(
    candidates: DataFrame,
    areas: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    buildings: DataFrame | None,
    params: ImageryParams,
    as_of: datetime.date,
    ages_days: tuple[int, ...] = (11, 16, 21),
) -> DataFrame:
    """Results of all tries together, by one pass over the pixels for all of them."""
    checks = cut_lineage(one_area_each(candidates))
    judged = judge_tries(checks, areas, scenes, params, as_of, ages_days)
    return results_of(judged, pixels, buildings, params)


def validate_tries(
    candidates: DataFrame,
    check: Callable[[DataFrame, int], DataFrame],
    as_of: datetime.date,
    ages_days: tuple[int, ...] = (11, 16, 21),
) -> list[DataFrame]:
    """Results of every try; try n takes what try n-1 left open.

    ``check(batch, try_no)`` validates a batch. Every try's result is cut off,
    as the next try and the combination both read it.
    """
    results: list[DataFrame] = []
    for try_no, age in enumerate(ages_days):
        due = due_for_try(candidates, as_of, age, results[-1] if results else None)
        results.append(
            cut_lineage(check(due, try_no).withColumn("validation_try", F.lit(try_no)))
        )
    return results


def try_table(path: str, try_no: int) -> str:
    return f"{path}/try-{try_no}"


def held_tries(
    spark: SparkSession, path: str, start: datetime.date, end: datetime.date, n_tries: int = 3
) -> list[DataFrame | None]:
    """Stored results of every try in a closed interval, None where a try has none yet."""
    tables = [try_table(path, n) for n in range(n_tries)]
    return [read_interval(spark, t, start, end) if path_exists(spark, t) else None for t in tables]


def run_tries(
    candidates: DataFrame,
    areas: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    buildings: DataFrame | None,
    params: ImageryParams,
    path: str,
    start: datetime.date,
    end: datetime.date,
    as_of: datetime.date,
    ages_days: tuple[int, ...] = (11, 16, 21),
    lookback_days: int = 60,
) -> None:
    """One run over the detections of an interval, its results kept for later runs.

    Every try has a table below ``path``, stored by day. A run takes the interval and
    ``lookback_days`` before it, judges those days anew with the scenes known by now, and
    replaces the results it has; results of detections that are not due any more, and all
    other days, stay. Only the days of the look-back are read from the tables. A run that
    breaks off between two tries is mended by running it again.
    """
    spark = candidates.sparkSession
    first = lookback_start(start, lookback_days)
    batch = candidates.filter(F.col("acq_date").between(F.lit(first), F.lit(end)))
    checks = cut_lineage(one_area_each(batch))
    held = held_tries(spark, path, first, end, len(ages_days))
    judged = judge_tries(checks, areas, scenes, params, as_of, ages_days, held)
    results = cut_lineage(results_of(judged, pixels, buildings, params))
    for try_no in range(len(ages_days)):
        done = results.filter(F.col("validation_try") == try_no)
        if not done.isEmpty():
            upsert_days(done, try_table(path, try_no), KEY)


def latest_try(results: list[DataFrame]) -> DataFrame:
    """The result of the last try of every detection."""
    every = reduce(lambda a, b: a.unionByName(b), results)
    rest = [c for c in every.columns if c not in KEY]
    return (
        every.groupBy(*KEY)
        .agg(F.max_by(F.struct(*rest), "validation_try").alias("r"))
        .select(*KEY, *[f"r.{c}" for c in rest])
    )


def combine_tries(
    results: list[DataFrame],
    detections: DataFrame,
    exclude: PolygonCover | None = None,
    exclude_polygons: DataFrame | None = None,
    mode: str = "intent",
) -> DataFrame:
    """Latest result per detection with its position, minus exclusion areas.

    ``mode='intent'`` drops detections touching any exclusion area;
    ``mode='literal'`` keeps only those touching every one.
    """
    key = [c for c in KEY if c in detections.columns]
    placed = latest_try(results).join(detections.select(*key, "lon", "lat"), key)
    if exclude is None:
        return placed
    if mode == "intent":
        return outside_polygons(placed, exclude)
    if mode == "literal":
        return touching_every_polygon(placed, exclude_polygons, exclude, "firms_id")
    raise ValueError("mode must be 'intent' or 'literal'")
