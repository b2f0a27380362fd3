"""Spatial predicates, measures, joins and nearest places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.operators import spatial
from emberscope.operators.nearest import nearest_settlement
from emberscope.session import scratch_path
from emberscope.sources import polygons
from emberscope.workload.catalog import haversine, query
from emberscope.workload.views import Views


@query(
    "PRJ1 PRJ2 JOIN2 GEO1 GEO9 GEO10 PIPE3",
    """
    SELECT d.firms_id, d.acq_date, d.lon AS longitude, d.lat AS latitude,
           'A' || lpad(CAST(d.cell AS VARCHAR), 9, '0') AS area_id
    FROM det d JOIN edges e ON e.cell = d.cell
    GROUP BY ALL
    HAVING count(*) FILTER (WHERE (e.y1 <= d.dy) != (e.y2 <= d.dy)
             AND d.dx < e.x1 + CAST(d.dy - e.y1 AS DOUBLE) * (e.x2 - e.x1) / (e.y2 - e.y1)) % 2 = 1""",
    "det edges",
)
def detections_in_areas(v: Views) -> DataFrame:
    return v.in_areas().select(
        "firms_id",
        "acq_date",
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
        "area_id",
    )


@query(
    "JOIN2 GEO1 GEO10",
    """
    SELECT area_id, count(*) AS n_detections, CAST(sum(firms_id) AS BIGINT) AS sum_ids
    FROM hits GROUP BY area_id""",
    "hits",
)
def detections_in_split_areas(v: Views) -> DataFrame:
    """Same join with polygons cut into cells finer than themselves."""
    cover = spatial.polygon_cover(v.areas(), ["area_id"], 0.02, small_edges=3)
    hits = spatial.points_in_polygons(v.detections().select("firms_id", "lon", "lat"), cover)
    return hits.groupBy("area_id").agg(
        F.count("*").alias("n_detections"), F.sum("firms_id").alias("sum_ids")
    )


@query(
    "GEO2 PIPE1",
    """
    SELECT firms_id, lon, lat FROM det
    WHERE lon > 20 AND lon < 30 AND lat > 0 AND lat < 15""",
    "det",
)
def detections_in_country(v: Views) -> DataFrame:
    points = v.detections().select("firms_id", "lon", "lat")
    return spatial.clip_to_union(points, v.admin(2), cell_deg=0.5, small_edges=None)


@query(
    "GEO2",
    """
    SELECT firms_id, lon, lat FROM det
    WHERE lon > 20 AND lon < 30 AND lat > 0 AND lat < 15""",
    "det",
)
def country_with_uneven_borders(v: Views) -> DataFrame:
    """Neighbours whose corners lie on the middle of each other's borders."""
    points = v.detections().select("firms_id", "lon", "lat")
    return spatial.clip_to_union(points, v.admin_uneven(), cell_deg=0.5, small_edges=None)


@query(
    "GEO3 GEO9",
    """
    SELECT min(x1) AS min_x, min(y1) AS min_y, max(x2) AS max_x, max(y2) AS max_y
    FROM (SELECT CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
                 CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM adm)""",
    "adm",
)
def country_extent(v: Views) -> DataFrame:
    return spatial.polygon_extent(v.admin(2))


@query(
    "JOIN2 PRJ4 SRC4",
    """
    SELECT d.firms_id, 'XXX' AS country_id, a.gadm_1, a.gadm_2
    FROM det d JOIN adm a ON d.lon BETWEEN a.x1 AND a.x2 AND d.lat BETWEEN a.y1 AND a.y2""",
    "det adm",
)
def detections_by_admin(v: Views) -> DataFrame:
    """A detection on the border of several areas gives one row for each."""
    points = v.detections().select("firms_id", "lon", "lat")
    return spatial.points_in_polygons(points, v.admin_cover()).drop("lon", "lat")


@query(
    "JOIN4",
    """
    SELECT firms_id, lon, lat FROM hits
    WHERE NOT (cell % 10 = 0 AND dx BETWEEN 5 AND 445 AND dy BETWEEN 5 AND 445)""",
    "hits",
)
def detections_outside_excluded(v: Views) -> DataFrame:
    excluded = spatial.polygon_cover(v.areas_exclude(), ["exclude_id"], small_edges=None)
    return spatial.outside_polygons(v.in_areas().select("firms_id", "lon", "lat"), excluded)


@query(
    "JOIN4",
    """
    SELECT d.firms_id, d.lon, d.lat FROM det d
    LEFT JOIN adm a ON a.gadm_1 = (SELECT min(gadm_1) FROM adm) AND a.y1 = 0
      AND NOT (d.lon BETWEEN a.x1 AND a.x2 AND d.lat BETWEEN a.y1 AND a.y2)
    WHERE a.gadm_1 IS NULL""",
    "det adm",
)
def detections_in_every_excluded(v: Views) -> DataFrame:
    """Literal reading of the exclusion join, over one excluded band."""
    band = v.admin(2).filter("ymin = 0").withColumn(
        "first", F.min("gadm_1").over(_everything())
    ).filter("gadm_1 = first")
    cover = spatial.polygon_cover(band, ["gadm_2"], small_edges=None)
    points = v.detections().select("firms_id", "lon", "lat")
    return spatial.touching_every_polygon(points, band, cover, "firms_id")


@query(
    "JOIN4",
    """
    SELECT d.firms_id, d.lon, d.lat FROM det d
    LEFT JOIN (SELECT r_regionkey AS k FROM region) e
      ON NOT (d.lon BETWEEN (200 + 3 * k) / CAST(10 AS DOUBLE) AND 26 AND d.lat BETWEEN 0 AND 15)
    WHERE k IS NULL""",
    "det",
)
def detections_in_overlapping_excluded(v: Views) -> DataFrame:
    """Literal reading of the exclusion join, over strips that overlap."""
    strips = g.with_bounds(v.excluded_strips())
    cover = spatial.polygon_cover(strips, ["exclude_id"], 0.5, small_edges=None)
    points = v.detections().select("firms_id", "lon", "lat")
    return spatial.touching_every_polygon(points, strips, cover, "firms_id")


def _everything():
    from pyspark.sql import Window

    # Five bands at most: one per region.
    return Window.partitionBy("country_id")


@query(
    "JOIN8 GEO5 GEO6 WIN5 PIPE7",
    f"""
    SELECT d.firms_id, arg_min(name, (dist, name)) AS settlement_name,
           round(min(dist), 3) AS settlement_distance
    FROM det d LEFT JOIN (
      SELECT firms_id, name, {haversine('lon', 'lat', 'plon', 'plat')} AS dist
      FROM det JOIN places ON abs(plat - lat) < 0.1 AND abs(plon - lon) < 0.2) n
      ON n.firms_id = d.firms_id AND dist <= 10000
    GROUP BY d.firms_id""",
    "det places",
)
def nearest_settlements(v: Views) -> DataFrame:
    source = v.detections().select("firms_id", "lon", "lat")
    return nearest_settlement(source, v.settlements(), 10_000.0).select(
        "firms_id", "settlement_name", F.round("settlement_distance", 3).alias("settlement_distance")
    )


@query(
    "JOIN8 GEO4 WIN5",
    """
    SELECT lon, lat, round(min(dist), 6) AS settlement_distance
    FROM (SELECT lon, lat, sqrt((lon - plon) * (lon - plon) + (lat - plat) * (lat - plat)) AS dist
          FROM (SELECT DISTINCT lon, lat FROM hits), places)
    GROUP BY lon, lat""",
    "hits places",
)
def nearest_settlements_no_cutoff(v: Views) -> DataFrame:
    """Planar degrees and no cutoff; names are left out as ties go by rounding."""
    source = v.in_areas().select("lon", "lat").distinct()
    return nearest_settlement(source, v.settlements(), None).select(
        "lon", "lat", F.round("settlement_distance", 6).alias("settlement_distance")
    )


@query(
    "PRJ11",
    """
    SELECT firms_id, round(6378137.0 * radians(lon), 3) AS x, round(6378137.0 * radians(lat), 3) AS y
    FROM det""",
    "det",
)
def projected_detections(v: Views) -> DataFrame:
    x, y = g.equidistant_projection("lon", "lat")
    return v.detections().select("firms_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(
    "GEO7",
    """
    SELECT firms_id, round(lon - 1000 / (111320 * cos(radians(lat))), 9) AS aoi_xmin,
           round(lat - CAST(1000 AS DOUBLE) / 111320, 9) AS aoi_ymin,
           round(lon + 1000 / (111320 * cos(radians(lat))), 9) AS aoi_xmax,
           round(lat + CAST(1000 AS DOUBLE) / 111320, 9) AS aoi_ymax
    FROM det""",
    "det",
)
def detection_squares(v: Views) -> DataFrame:
    boxed = g.with_aoi_bounds(v.detections().select("firms_id", "lon", "lat"), 1000.0)
    return boxed.select(
        "firms_id",
        *[F.round(c, 9).alias(c) for c in ("aoi_xmin", "aoi_ymin", "aoi_xmax", "aoi_ymax")],
    )


@query(
    "SRC7 SRC9 GEO9",
    """
    SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS area_id, 2 AS n_copies FROM customer""",
)
def equal_areas_share_an_id(v: Views) -> DataFrame:
    """Every area twice, as parts of one feature: equal parts get equal content ids."""
    from emberscope.sources.polygons import with_content_id

    parts = v.areas().selectExpr("area_id", "explode(array(rings, rings)) AS rings")
    return (
        with_content_id(parts)
        .groupBy("id")
        .agg(F.min("area_id").alias("area_id"), F.count("*").cast("int").alias("n_copies"))
        .drop("id")
    )


@query(
    "SRC8",
    """
    SELECT c_custkey % 4 AS damage, CASE c_custkey % 4 WHEN 1 THEN 'ring not closed'
             WHEN 2 THEN 'too few positions' WHEN 3 THEN 'no area' END AS problem,
           count(*) AS n_areas FROM customer GROUP BY ALL""",
)
def damaged_areas(v: Views) -> DataFrame:
    """Areas with three kinds of damage, and what the check says of them."""
    from emberscope.sources.polygons import check_polygons

    damaged = v.areas().selectExpr(
        "CAST(substring(area_id, 2) AS BIGINT) % 4 AS damage",
        "transform(slice(rings, 1, 1), r -> CASE CAST(substring(area_id, 2) AS BIGINT) % 4"
        " WHEN 1 THEN concat(slice(r, 1, size(r) - 1), array(r[1], r[2]))"
        " WHEN 2 THEN slice(r, 1, 3)"
        " WHEN 3 THEN array(r[0], r[1], r[0], r[1], r[0])"
        " ELSE r END) AS rings",
    )
    good, bad = check_polygons(damaged)
    return (
        good.selectExpr("damage", "CAST(NULL AS STRING) AS problem")
        .unionByName(bad.select("damage", "problem"))
        .groupBy("damage", "problem")
        .agg(F.count("*").alias("n_areas"))
    )


@query(
    "SRC8",
    """
    SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS area_id
    FROM customer WHERE c_custkey % 3 != 1 AND c_custkey % 2 = 0""",
)
def self_crossing_areas(v: Views) -> DataFrame:
    """Even cells have two corners of their rectangle swapped into a bow tie."""
    from emberscope.sources.polygons import self_crossings

    bent = v.areas().withColumn(
        "rings",
        F.expr(
            "IF(CAST(substring(area_id, 2) AS BIGINT) % 2 = 0,"
            " transform(rings, r -> IF(size(r) = 5, array(r[0], r[2], r[1], r[3], r[0]), r)), rings)"
        ),
    )
    return self_crossings(bent, "area_id")


@query(
    "SRC5 SRC7 SRC9 SRC10 GEO9",
    """
    SELECT (200000 + 1000 * (c_custkey % 100) + 5) / CAST(10000 AS DOUBLE) AS xmin,
           (1000 * (c_custkey // 100) + 5) / CAST(10000 AS DOUBLE) AS ymin,
           (200000 + 1000 * (c_custkey % 100) + CASE part WHEN 0 THEN 895 ELSE 445 END) / CAST(10000 AS DOUBLE) AS xmax,
           (1000 * (c_custkey // 100) + CASE WHEN part = 1 THEN 445 WHEN c_custkey % 3 = 1 THEN 885 ELSE 895 END)
             / CAST(10000 AS DOUBLE) AS ymax,
           CAST(CASE WHEN part = 0 AND c_custkey % 3 = 2 THEN 2 ELSE 1 END AS INTEGER) AS n_rings,
           2 - part AS n_parts, true AS dated
    FROM customer, (VALUES (0), (1)) p(part)""",
)
def areas_from_wkb(v: Views) -> DataFrame:
    """Areas of a Parquet feature table, by content id: parts of one or more features."""
    path = scratch_path(v.spark, "area-features")
    v.area_features().select("wkb").write.parquet(path)
    usable, _ = polygons.read_areas(v.spark, path)
    return (
        usable.groupBy("id")
        .agg(
            *[F.min(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
            F.min(F.size("rings")).alias("n_rings"),
            F.count("*").cast("int").alias("n_parts"),
            (F.min("file_mtime") > 0).alias("dated"),
        )
        .drop("id")
    )


@query(
    "SRC5 SRC7 SRC8",
    """
    SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS area_id, problem
    FROM customer JOIN (VALUES (0, NULL), (1, 'empty'), (2, 'empty'), (3, 'empty'), (4, 'ring not closed'),
                               (5, 'crosses itself'), (6, NULL), (6, 'ring not closed')) d(damage, problem)
      ON c_custkey % 7 = damage""",
)
def rejected_polygons(v: Views) -> DataFrame:
    """Every part of every feature, with the reason why it is set aside or none."""
    usable, rejected = polygons.checked_areas(v.damaged_features())
    none = F.lit(None).cast("string").alias("problem")
    return usable.select("area_id", none).unionByName(rejected.select("area_id", "problem"))


@query(
    "SRC4 JOIN2",
    """
    SELECT d.firms_id, 'XXX' AS country_id, a.gadm_1, a.gadm_2, NULL AS problem
    FROM det d JOIN adm a ON d.lon BETWEEN a.x1 AND a.x2 AND d.lat BETWEEN a.y1 AND a.y2 AND a.y1 != 3
    UNION ALL SELECT NULL, 'XXX', gadm_1, gadm_2, 'no polygon' FROM adm WHERE y1 = 3""",
    "det adm",
)
def admin_from_wkb(v: Views) -> DataFrame:
    """Detections by areas of a Parquet feature table, and the areas that cannot be decoded."""
    path = scratch_path(v.spark, "admin-features")
    v.admin_features().write.parquet(path)
    areas, rejected = polygons.read_admin(v.spark, path, 2)
    names = ["country_id", "gadm_1", "gadm_2"]
    cover = spatial.polygon_cover(areas, names, small_edges=None)
    points = v.detections().select("firms_id", "lon", "lat")
    found = spatial.points_in_polygons(points, cover).select("firms_id", *names)
    return found.withColumn("problem", F.lit(None).cast("string")).unionByName(
        rejected.select(F.lit(None).cast("long").alias("firms_id"), *names, "problem")
    )
