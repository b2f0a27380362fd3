"""Imagery checks, retries, combination and the final tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.config import Config, ImageryParams
from emberscope.operators import imagery, regions
from emberscope.operators.spatial import points_in_polygons, polygon_cover
from emberscope.plans import marts, project
from emberscope.plans import validation as val
from emberscope.plans.events import cluster_events
from emberscope.session import cut_lineage, scratch_path
from emberscope.workload.catalog import cte, haversine, query
from emberscope.workload.event_queries import event_sql, rounded_events
from emberscope.workload.views import AOI_BUFFER_M, AS_OF, PIXEL_HALF_SIZE, Views

# Scenes are a cell wide here and hold seven pixels, so squares and blocks are
# larger than for real imagery and one burnt pixel is enough.
PARAMS = ImageryParams(
    buffer_distance_m=AOI_BUFFER_M,
    burnt_pixel_count_threshold=1,
    pixel_half_size_deg=PIXEL_HALF_SIZE,
    block_deg=0.02,
    scene_cell_deg=0.1,
)

cte(
    "burnt_cell",
    """
    SELECT DISTINCT l_orderkey // 100 AS bs, l_orderkey % 2 AS sa, l_partkey % 25 AS px,
           (l_orderkey // 2) % 20 AS py FROM lineitem""",
)
cte(
    "reach",
    """
    SELECT bs, sa, px, py, py * 25 + px AS region FROM burnt_cell
    UNION SELECT c.bs, c.sa, c.px, c.py, r.region FROM reach r JOIN burnt_cell c
      ON c.bs = r.bs AND c.sa = r.sa AND abs(c.px - r.px) + abs(c.py - r.py) = 1""",
)
cte(
    "sc",
    """
    SELECT o_orderkey AS scene_id, o_custkey AS cell,
           DATE '2023-12-01' + CAST(o_orderkey % 92 AS INTEGER) AS sdate,
           (o_orderkey % 60) * 100000000 + o_orderkey AS ord,
           (o_orderkey * 17) % 40 < 10 AS clear FROM orders""",
)
cte(
    "px",
    """
    SELECT l_orderkey AS scene_id, l_linenumber AS px, o_custkey AS cell,
           (200000 + 1000 * (o_custkey % 100) + 125 * l_linenumber) / CAST(10000 AS DOUBLE) AS plon,
           (1000 * (o_custkey // 100) + 125 * ((l_linenumber * 3) % 7 + 1)) / CAST(10000 AS DOUBLE) AS plat,
           avg(l_extendedprice) AS b8, avg(l_quantity) * 2000 AS b12
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""",
)
cte(
    "nbr",
    "SELECT *, (b8 - b12) / nullif(b8 + b12, 0) AS nbr FROM px",
)
cte(
    "bld",
    """
    SELECT p_partkey AS building_id, p_partkey % (SELECT count(*) FROM customer) AS cell,
           p_size % 7 + 1 AS px FROM part WHERE p_size >= 38""",
)


def _try_ctes(k: int | None, due: str, scenes: str) -> None:
    """Views choice, look and result of one batch, suffixed."""
    s = "" if k is None else str(k)
    cte(f"due{s}", due)
    cte(
        f"choice{s}",
        f"""
        SELECT d.firms_id, d.acq_date, d.cell, d.lon, d.lat,
               coalesce(min(sdate) < d.acq_date AND d.acq_date < max(sdate), false) AS avail,
               coalesce(min(sdate) FILTER (WHERE clear) < d.acq_date
                        AND d.acq_date < max(sdate) FILTER (WHERE clear), false) AS clear_avail,
               max(sdate) FILTER (WHERE clear AND sdate < d.acq_date) AS b,
               min(sdate) FILTER (WHERE clear AND sdate > d.acq_date) AS a
        FROM due{s} d LEFT JOIN (SELECT * FROM sc WHERE {scenes}) x
          ON x.cell = d.cell AND sdate >= d.acq_date - 30 AND sdate < d.acq_date + 30
        GROUP BY d.firms_id, d.acq_date, d.cell, d.lon, d.lat""",
    )
    cte(
        f"firstclear{s}",
        f"""
        SELECT cell, sdate, min(ord) % 100000000 AS scene_id
        FROM sc WHERE clear AND {scenes} GROUP BY ALL""",
    )
    cte(
        f"pair{s}",
        f"""
        SELECT c.*, f.scene_id AS bs, g.scene_id AS sa
        FROM choice{s} c JOIN firstclear{s} f ON f.cell = c.cell AND f.sdate = c.b
        JOIN firstclear{s} g ON g.cell = c.cell AND g.sdate = c.a
        WHERE avail AND clear_avail""",
    )
    cte(
        f"burntpx{s}",
        f"""
        SELECT p.firms_id, p.cell, y.px FROM pair{s} p
        JOIN nbr x ON x.scene_id = p.bs JOIN nbr y ON y.scene_id = p.sa AND y.px = x.px
        WHERE x.nbr - y.nbr >= 0.15::DOUBLE AND y.nbr <= -0.10::DOUBLE
          AND abs(y.plat - p.lat) <= {AOI_BUFFER_M} / CAST(111320 AS DOUBLE)
          AND abs(y.plon - p.lon) <= {AOI_BUFFER_M} / (111320 * cos(radians(p.lat)))""",
    )
    cte(
        f"result{s}",
        f"""
        SELECT c.firms_id, c.acq_date, c.lon, c.lat, c.cell,
               CASE WHEN avail AND clear_avail THEN b END AS before_date,
               CASE WHEN avail AND clear_avail THEN a END AS after_date,
               coalesce(np, 0) > 1 AS burn_scar_detected, coalesce(np, 0) AS burnt_pixel_count,
               coalesce(nb, 0) AS burnt_building_count, NOT avail AS no_data,
               avail AND NOT clear_avail AS too_cloudy
        FROM choice{s} c
        LEFT JOIN (SELECT firms_id, count(*) AS np FROM burntpx{s} GROUP BY ALL) n
          ON n.firms_id = c.firms_id
        LEFT JOIN (SELECT firms_id, count(*) AS nb FROM burntpx{s} JOIN bld USING (cell, px) GROUP BY ALL) m
          ON m.firms_id = c.firms_id""",
    )


_try_ctes(None, "SELECT * FROM hits", "true")
_try_ctes(0, "SELECT * FROM hits WHERE acq_date < DATE '2024-01-25'", "scene_id % 4 <= 1")
_try_ctes(
    1,
    """SELECT * FROM hits WHERE acq_date < DATE '2024-01-20'
       AND firms_id IN (SELECT firms_id FROM result0 WHERE no_data OR too_cloudy)""",
    "scene_id % 4 <= 2",
)
_try_ctes(
    2,
    """SELECT * FROM hits WHERE acq_date < DATE '2024-01-15'
       AND firms_id IN (SELECT firms_id FROM result1 WHERE no_data OR too_cloudy)""",
    "scene_id % 4 <= 3",
)
cte(
    "latest",
    """
    SELECT *, 'A' || lpad(CAST(cell AS VARCHAR), 9, '0') AS area_id
    FROM (SELECT *, row_number() OVER (PARTITION BY firms_id ORDER BY validation_try DESC) AS rn
          FROM (SELECT *, 0 AS validation_try FROM result0 UNION
                SELECT *, 1 FROM result1 UNION SELECT *, 2 FROM result2))
    WHERE rn = 1""",
)
cte(
    "kept",
    """
    SELECT l.* FROM latest l JOIN det d USING (firms_id)
    WHERE NOT (l.cell % 10 = 0 AND d.dx BETWEEN 5 AND 445 AND d.dy BETWEEN 5 AND 445)""",
)
cte(
    "kept_ev",
    """
    SELECT * EXCLUDE (gap),
           CAST(sum(CASE WHEN gap > 2 OR gap IS NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY area_id ORDER BY acq_date) AS INTEGER) AS event_no
    FROM (SELECT *, acq_date - lag(acq_date) OVER (PARTITION BY area_id ORDER BY acq_date) AS gap
          FROM kept)""",
)
cte("event_rows", event_sql("kept_ev", "c.lon, c.lat"))
# Scenes known from the start settle in the first try all that later tries could.
cte(
    "kept_once",
    """
    SELECT h.* FROM hits h JOIN det d USING (firms_id)
    WHERE h.acq_date < DATE '2024-01-25'
      AND NOT (h.cell % 10 = 0 AND d.dx BETWEEN 5 AND 445 AND d.dy BETWEEN 5 AND 445)""",
)
cte(
    "once_ev",
    """
    SELECT * EXCLUDE (gap),
           CAST(sum(CASE WHEN gap > 3 OR gap IS NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY area_id ORDER BY acq_date) AS INTEGER) AS event_no
    FROM (SELECT *, acq_date - lag(acq_date) OVER (PARTITION BY area_id ORDER BY acq_date) AS gap
          FROM kept_once)""",
)
cte("once_events", "SELECT DISTINCT area_id, event_no FROM once_ev")
_NEAR = f"""
    SELECT {{key}}, arg_min(name, (dist, name)) AS settlement_name,
           round(min(dist), 3) AS settlement_distance
    FROM (SELECT {{key}}, name, {haversine('{lon}', '{lat}', 'plon', 'plat')} AS dist
          FROM {{source}} JOIN places ON abs(plat - {{lat}}) < 0.1 AND abs(plon - {{lon}}) < 0.2)
    WHERE dist <= 10000 GROUP BY ALL"""


def _candidates(v: Views) -> DataFrame:
    return val.to_validate(v.detections(), v.include_cover())


def _known(v: Views, part: int) -> DataFrame:
    """Scenes keep coming in: a further quarter of them is known each time."""
    return v.scenes().filter(f"scene_id % 4 <= {part}")


def _tries(v: Views) -> tuple[DataFrame, DataFrame]:
    """Candidates and the results of three tries."""
    candidates = cut_lineage(_candidates(v))
    tries = val.validate_all_tries(
        candidates,
        v.areas(),
        v.scenes().selectExpr("*", "greatest(scene_id % 4 - 1, 0) AS known_from"),
        v.pixels(),
        v.buildings(),
        PARAMS,
        AS_OF,
    )
    return candidates, tries


def validated(v: Views) -> DataFrame:
    """Three tries, latest result each, exclusion areas left out; checkpointed."""
    candidates, tries = _tries(v)
    exclude = polygon_cover(v.areas_exclude(), ["exclude_id"], small_edges=None)
    positions = candidates.select("firms_id", "acq_date", "lon", "lat").distinct()
    return cut_lineage(val.combine_tries([tries], positions, exclude))


RESULT = ", ".join(val.RESULT_COLUMNS)


@query(
    "SRC13 JOIN6 AGG7 AGG8 AGG10 FLT3",
    """
    SELECT DISTINCT 'A' || lpad(CAST(cell AS VARCHAR), 9, '0') AS area_id, acq_date,
           avail AS available, clear_avail AS clear_available,
           CASE WHEN avail AND clear_avail THEN b END AS before_date,
           CASE WHEN avail AND clear_avail THEN a END AS after_date FROM choice""",
    "choice",
)
def scene_availability(v: Views) -> DataFrame:
    checks = v.in_areas().select("area_id", "acq_date").distinct()
    judged = imagery.judge(checks, v.areas(), v.scenes(), PARAMS)
    return judged.selectExpr(
        "area_id",
        "acq_date",
        "NOT no_data AS available",
        "NOT no_data AND NOT too_cloudy AS clear_available",
        "before_date",
        "after_date",
    )


@query(
    "AGG9",
    """
    SELECT 'A' || lpad(CAST(cell AS VARCHAR), 9, '0') AS area_id, sdate AS scene_date,
           CAST(scene_id AS BIGINT) AS clear_scene FROM firstclear""",
    "firstclear",
)
def first_clear_scenes(v: Views) -> DataFrame:
    sets = imagery.footprint_sets(v.areas(), v.scenes(), PARAMS)
    days = imagery.group_scene_days(sets, v.scenes(), PARAMS)
    return days.filter("clear_scene IS NOT NULL").withColumnRenamed("scene_group", "area_id")


@query(
    "SCL3",
    "SELECT scene_id, CAST(px AS BIGINT) AS px, round(nbr, 9) AS nbr FROM nbr",
    "nbr",
)
def burn_ratio(v: Views) -> DataFrame:
    return imagery.nbr_pixels(v.pixels()).select("scene_id", "px", F.round("nbr", 9).alias("nbr"))


@query(
    "SCL4 SCL5 FLT9",
    """
    SELECT DISTINCT p.bs AS before_scene, p.sa AS after_scene, CAST(y.px AS BIGINT) AS px,
           round(x.nbr - y.nbr, 9) AS nbr_difference
    FROM burntpx i JOIN pair p USING (firms_id)
    JOIN nbr x ON x.scene_id = p.bs AND x.px = i.px JOIN nbr y ON y.scene_id = p.sa AND y.px = i.px""",
    "burntpx pair nbr",
)
def burnt_pixel_mask(v: Views) -> DataFrame:
    """Burnt pixels lying in the square of some detection."""
    looks, burnt = _looks_and_burnt(v)
    marks = burnt.join(
        looks.selectExpr(*imagery.PAIR, "aoi_xmin", "aoi_xmax", "aoi_ymin", "aoi_ymax"), imagery.PAIR
    ).filter("lon BETWEEN aoi_xmin AND aoi_xmax AND lat BETWEEN aoi_ymin AND aoi_ymax")
    return marks.select(
        *imagery.PAIR, "px", F.round("nbr_difference", 9).alias("nbr_difference")
    ).distinct()


def _looks_and_burnt(v: Views) -> tuple[DataFrame, DataFrame]:
    checks = val.one_area_each(_candidates(v))
    judged = imagery.judge(checks, v.areas(), v.scenes(), PARAMS)
    looks = cut_lineage(imagery.looks_of(judged, PARAMS))
    return looks, imagery.burnt_pixels(v.pixels(), looks, PARAMS)


@query("PIPE4 SRC14 SCL6 AGG11 AGG12 JOIN11 FLT7", f"SELECT {RESULT} FROM result", "result")
def imagery_validation(v: Views) -> DataFrame:
    return val.validate_batch(
        _candidates(v), v.areas(), v.scenes(), v.pixels(), v.buildings(), PARAMS
    )


@query("PIPE4 SRC13 AGG11", f"SELECT {RESULT} FROM result", "result")
def validation_of_stored_pixels(v: Views) -> DataFrame:
    """The pixel table laid out by scene day and tile before it is read."""
    path = scratch_path(v.spark, "pixels")
    imagery.store_pixels(v.pixels(), v.scenes(), path, PARAMS)
    pixels = imagery.stored_pixels(v.spark, path)
    return val.validate_batch(_candidates(v), v.areas(), v.scenes(), pixels, v.buildings(), PARAMS)


# (first and last day, clock, known quarters of the scenes) of three runs, ten days of look-back.
RUNS = [
    (datetime.date(2024, 1, 1), datetime.date(2024, 1, 14), datetime.date(2024, 1, 22), 1),
    (datetime.date(2024, 1, 15), datetime.date(2024, 1, 20), datetime.date(2024, 1, 29), 2),
    (datetime.date(2024, 1, 21), datetime.date(2024, 1, 31), datetime.date(2024, 2, 8), 3),
]
LOOKBACK = 10


def _run_ctes() -> str:
    """Tables of every try after every run; returns the union of the last ones."""
    for r, (start, end, as_of, part) in enumerate(RUNS):
        for t, age in enumerate((11, 16, 21)):
            k = 100 + 10 * r + t
            due = (
                f"SELECT * FROM hits WHERE acq_date BETWEEN DATE '{start}' - {LOOKBACK} AND DATE '{end}'"
                f" AND acq_date < DATE '{as_of}' - {age}"
            )
            if t:
                due += f" AND firms_id IN (SELECT firms_id FROM held{k - 1} WHERE no_data OR too_cloudy)"
            _try_ctes(k, due, f"scene_id % 4 <= {part}")
            older = f"UNION ALL SELECT * FROM held{k - 10} WHERE firms_id NOT IN (SELECT firms_id FROM due{k})"
            cte(f"held{k}", f"SELECT * FROM result{k} {older if r else ''}")
    return " UNION ALL ".join(f"SELECT *, {t} AS validation_try FROM held{120 + t}" for t in range(3))


cte("held_tries", _run_ctes())


@query(
    "PIPE3 INC2 INC3",
    f"""
    SELECT {RESULT}, validation_try
    FROM (SELECT *, row_number() OVER (PARTITION BY firms_id ORDER BY validation_try DESC) AS rn FROM held_tries)
    WHERE rn = 1""",
    "held_tries",
)
def retries_over_three_runs(v: Views) -> DataFrame:
    """The clock moves on, scenes come in, and every run goes on from the stored tries."""
    path = scratch_path(v.spark, "tries")
    candidates = cut_lineage(_candidates(v))
    for start, end, as_of, part in RUNS:
        val.run_tries(
            candidates, v.areas(), _known(v, part), v.pixels(), v.buildings(), PARAMS, path,
            start, end, as_of, lookback_days=LOOKBACK,
        )
    held = val.held_tries(v.spark, path, RUNS[0][0], RUNS[-1][1])
    return val.latest_try([h for h in held if h is not None])


@query(
    "PIPE12",
    """
    SELECT bs AS before_scene, sa AS after_scene, count(*) AS n_pixels, CAST(min(px) AS BIGINT) AS px_min,
           CAST(max(px) AS BIGINT) AS px_max, CAST(1 AS BIGINT) AS py_min, CAST(1 AS BIGINT) AS py_max
    FROM (SELECT *, px - row_number() OVER (PARTITION BY bs, sa ORDER BY px) AS island
          FROM (SELECT DISTINCT p.bs, p.sa, y.px FROM pair p
                JOIN nbr x ON x.scene_id = p.bs JOIN nbr y ON y.scene_id = p.sa AND y.px = x.px
                WHERE x.nbr - y.nbr >= 0.15::DOUBLE AND y.nbr <= -0.10::DOUBLE))
    GROUP BY bs, sa, island""",
    "pair nbr",
)
def burnt_regions(v: Views) -> DataFrame:
    """Regions of all burnt pixels of every scene pair in use."""
    checks = val.one_area_each(_candidates(v))
    judged = imagery.judge(checks, v.areas(), v.scenes(), PARAMS)
    pairs = judged.filter("before_scene IS NOT NULL").select(*imagery.PAIR).distinct()
    # Whole scenes: one look per pair that spans the scene.
    footprints = v.scenes().selectExpr(
        "scene_id AS after_scene", "xmin AS aoi_xmin", "ymin AS aoi_ymin", "xmax AS aoi_xmax",
        "ymax AS aoi_ymax", "xmin AS lon", "ymin AS lat",
    )
    looks = cut_lineage(pairs.join(footprints, "after_scene"))
    return regions.region_summary(imagery.burnt_pixels(v.pixels(), looks, PARAMS))


@query(
    "PIPE12",
    """
    SELECT bs AS before_scene, sa AS after_scene, count(*) AS n_pixels, min(px) AS px_min, max(px) AS px_max,
           min(py) AS py_min, max(py) AS py_max
    FROM (SELECT bs, sa, px, py, min(region) AS region FROM reach GROUP BY bs, sa, px, py)
    GROUP BY bs, sa, region""",
    "reach",
)
def burnt_regions_over_rows(v: Views) -> DataFrame:
    """Regions that reach over several pixel rows, with bends and holes."""
    return regions.region_summary(v.burnt_cells())


@query(
    "PIPE3 FLT1 FLT2 JOIN5 AGG6 INC2",
    f"SELECT {RESULT}, validation_try FROM latest",
    "latest",
)
def latest_results_of_three_tries(v: Views) -> DataFrame:
    return val.latest_try([_tries(v)[1]])


@query(
    "PIPE5 SET1 JOIN1 JOIN4 WIN4",
    f"SELECT {RESULT}, validation_try, lon, lat FROM kept",
    "kept",
)
def validated_detections(v: Views) -> DataFrame:
    return validated(v)


@query(
    "PIPE8 JOIN1 JOIN2 JOIN3 JOIN9 PRJ2 PRJ4",
    f"""
    SELECT k.firms_id, k.lat AS latitude, k.lon AS longitude, k.acq_date, 'XXX' AS country_id,
           gadm_1, gadm_2, settlement_name, settlement_distance, area_id AS area_include_id, event_no,
           before_date, after_date, no_data, too_cloudy, validation_try, burn_scar_detected,
           burnt_pixel_count, burnt_building_count
    FROM kept_ev k
    LEFT JOIN ({_NEAR.format(key='firms_id', source='kept', lon='lon', lat='lat')}) n USING (firms_id)
    JOIN adm ON k.lon BETWEEN x1 AND x2 AND k.lat BETWEEN y1 AND y2""",
    "kept kept_ev places adm",
)
def detection_mart(v: Views) -> DataFrame:
    results, include = validated(v), v.include_cover()
    events = cluster_events(cut_lineage(points_in_polygons(results, include)))
    mart = marts.detection_mart(
        results, include, events, v.settlements(), v.admin_cover(), level=2
    )
    return mart.withColumn("settlement_distance", F.round("settlement_distance", 3))


def _event_mart(v: Views, settlement_per: str) -> DataFrame:
    events = cluster_events(cut_lineage(points_in_polygons(validated(v), v.include_cover())))
    mart = marts.event_mart(
        cut_lineage(events), v.settlements(), v.admin_cover(), 2, settlement_per=settlement_per
    )
    mart = rounded_events(mart.withColumnsRenamed({"longitude": "lon", "latitude": "lat"}))
    return mart.withColumnsRenamed({"lon": "longitude", "lat": "latitude"}).withColumn(
        "settlement_distance", F.round("settlement_distance", 3)
    )


_EVENT_MART = """
    SELECT e.* EXCLUDE (area_id, lon, lat), e.area_id AS area_include_id,
           round(e.lat, 6) AS latitude, round(e.lon, 6) AS longitude, 'XXX' AS country_id, gadm_1, gadm_2, settlement_name, settlement_distance
    FROM event_rows e
    LEFT JOIN ({near}) n USING ({key})
    JOIN adm ON e.lon BETWEEN x1 AND x2 AND e.lat BETWEEN y1 AND y2"""


@query(
    "PIPE9 PRJ3 JOIN2 JOIN9",
    _EVENT_MART.format(
        near=_NEAR.format(key="area_id, event_no", source="event_rows", lon="lon", lat="lat"),
        key="area_id, event_no",
    ),
    "event_rows places adm",
)
def event_mart(v: Views) -> DataFrame:
    return _event_mart(v, "event")


@query(
    "PIPE9 JOIN9",
    _EVENT_MART.format(
        near=_NEAR.format(key="area_id", source="event_rows", lon="lon", lat="lat"), key="area_id"
    ),
    "event_rows places adm",
)
def event_mart_settlement_per_area(v: Views) -> DataFrame:
    return _event_mart(v, "area")


@query(
    "AUD1 AUD3 INC5",
    f"""
    SELECT 'detections' AS table_name, count(*) AS n_rows FROM det
    UNION ALL SELECT 'to_validate', count(*) FROM hits
    UNION ALL SELECT 'validated', count(*) FROM kept_once
    UNION ALL SELECT 'clustered', count(*) FROM once_events
    UNION ALL SELECT 'nearest_places', count(*) FROM ({_NEAR.format(key='firms_id', source='kept_once', lon='lon', lat='lat')})
    UNION ALL SELECT 'detection_mart', count(*) FROM kept_once k
      JOIN adm ON k.lon BETWEEN x1 AND x2 AND k.lat BETWEEN y1 AND y2
    UNION ALL SELECT 'event_mart', count(*) FROM (
      SELECT avg(lon) AS lon, avg(lat) AS lat FROM (SELECT DISTINCT area_id, event_no, lon, lat FROM once_ev)
      GROUP BY area_id, event_no) e JOIN adm ON e.lon BETWEEN x1 AND x2 AND e.lat BETWEEN y1 AND y2""",
    "det hits kept_once once_ev once_events places adm",
)
def audited_tables(v: Views) -> DataFrame:
    """The seven tables of a whole run, counted by the jobs that write them."""
    cfg = Config("XXX", gadm_level=2, cell_deg=0.1, imagery=PARAMS, cluster_max_date_gap=3)
    inputs = project.Inputs(
        v.detections().select("firms_id", "acq_date", "lon", "lat"), v.admin(), v.settlements(), v.scenes(),
        v.pixels(), v.buildings(), v.areas(), v.areas_exclude(),
    )
    return project.build(cfg, inputs, scratch_path(v.spark, "project"), datetime.date(2024, 1, 1), AS_OF, AS_OF)
