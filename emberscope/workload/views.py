"""Input tables of the library derived from the star-schema test tables.

Coordinates are computed in whole thousandths or ten-thousandths of a degree and
divided once, so another engine reaches the same doubles.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.operators.spatial import PolygonCover, points_in_polygons, polygon_cover
from emberscope.session import ship_package, spread
from emberscope.sources.wkb import encode_wkb

AS_OF = datetime.date(2024, 2, 5)
PIXEL_HALF_SIZE = 0.0005
AOI_BUFFER_M = 4000.0

RECTANGLE = ((5, 5), (895, 5), (895, 895), (5, 895), (5, 5))
TRIANGLE = ((5, 5), (895, 5), (5, 885), (5, 5))
HOLE = ((305, 305), (305, 605), (605, 605), (605, 305), (305, 305))
QUARTER = ((5, 5), (445, 5), (445, 445), (5, 445), (5, 5))
BOW = ((5, 5), (895, 895), (895, 5), (5, 445), (5, 5))


class Views:
    """Lazy views over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A source table; its file schema is looked up once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def _with_cell(self, df: DataFrame, key: str) -> DataFrame:
        """Add ``cell = key % number of customers``."""
        n = self.table("customer").selectExpr("count(*) AS n").scalar()
        return df.withColumn("n_cells", n).selectExpr("*", f"({key}) % n_cells AS cell")

    def detections(self) -> DataFrame:
        """firms_id, acq_date, acq_time (HHMM), lon, lat and the coded columns."""
        return self._with_cell(self.table("events"), "user_id * 10 + event_id % 10").selectExpr(
            "event_id AS firms_id",
            "to_date(ts) AS acq_date",
            "CAST(hour(ts) * 100 + minute(ts) AS INT) AS acq_time",
            "(20000 + 100 * (cell % 100) + (event_id * 31) % 100) / 1000D AS lon",
            "(100 * (cell DIV 100) + (event_id * 53) % 100) / 1000D AS lat",
            "element_at(array('N', 'N20', 'N21'), CAST(event_id % 3 AS INT) + 1) AS satellite",
            "'VIIRS' AS instrument",
            "CASE event_id % 7 WHEN 0 THEN 'h' WHEN 1 THEN 'l' ELSE 'n' END AS confidence",
            "'2.0NRT' AS version",
            "(30 + event_id % 20) / 100D AS scan",
            "(30 + event_id % 15) / 100D AS track",
            "(3000 + event_id % 600) / 10D AS bright_ti4",
            "(2800 + event_id % 300) / 10D AS bright_ti5",
            "value AS frp",
            "CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS daynight",
        )

    def feed(self) -> DataFrame:
        """Detections with the column names and order of the CSV feed."""
        return self.detections().selectExpr(
            "lat AS latitude",
            "lon AS longitude",
            "bright_ti4",
            "scan",
            "track",
            "acq_date",
            "CAST(acq_time AS STRING) AS acq_time",
            "satellite",
            "instrument",
            "confidence",
            "version",
            "bright_ti5",
            "frp",
            "daynight",
        )

    def _cells(self) -> DataFrame:
        """``c_custkey`` of every cell, over all cores: few bytes, but polygons come of them."""
        return spread(self.table("customer").select("c_custkey"), "c_custkey")

    def areas(self, id_name: str = "area_id") -> DataFrame:
        """One area in every cell: rectangle, triangle or rectangle with a hole."""
        rect, hole = _ring("c_custkey", RECTANGLE), _ring("c_custkey", HOLE)
        box, low = _box("c_custkey", RECTANGLE), _box("c_custkey", TRIANGLE)
        return self._cells().selectExpr(
            f"{area_name('c_custkey')} AS {id_name}",
            f"CASE c_custkey % 3 WHEN 0 THEN array({rect})"
            f" WHEN 1 THEN array({_ring('c_custkey', TRIANGLE)})"
            f" ELSE array({rect}, {hole}) END AS rings",
            f"{box['xmin']} AS xmin",
            f"{box['ymin']} AS ymin",
            f"{box['xmax']} AS xmax",
            f"IF(c_custkey % 3 = 1, {low['ymax']}, {box['ymax']}) AS ymax",
        )

    def areas_exclude(self, id_name: str = "exclude_id") -> DataFrame:
        """Lower-left quarter of every tenth cell."""
        return (
            self._cells()
            .filter("c_custkey % 10 = 0")
            .selectExpr(
                f"{area_name('c_custkey')} AS {id_name}",
                f"array({_ring('c_custkey', QUARTER)}) AS rings",
                *[f"{v} AS {k}" for k, v in _box("c_custkey", QUARTER).items()],
            )
        )

    def area_features(self) -> DataFrame:
        """Two features of each area: with its lower-left quarter as a second part, and alone."""
        areas = _with_wkb(self.areas(), wkb="rings", quarter=f"array({_ring(_CELL, QUARTER)})")
        return areas.selectExpr(
            "area_id",
            f"explode(array({_multi_wkb('wkb', 'quarter')}, wkb)) AS wkb",
        )

    def damaged_features(self) -> DataFrame:
        """Areas with a geometry that is fine, or has one of six kinds of damage, by cell."""
        opened = "transform(rings, r -> concat(slice(r, 1, size(r) - 1), array(r[1])))"
        made = _with_wkb(
            self.areas(), wkb="rings", opened=opened, bow=f"array({_ring(_CELL, BOW)})"
        )
        return made.selectExpr(
            "area_id",
            f"CASE {_CELL} % 7 WHEN 0 THEN wkb WHEN 2 THEN substring(wkb, 1, length(wkb) - 1)"
            f" WHEN 3 THEN {POINT_WKB} WHEN 4 THEN opened WHEN 5 THEN bow"
            f" WHEN 6 THEN {_multi_wkb('wkb', 'opened')} END AS wkb",
        )

    def admin_features(self) -> DataFrame:
        """GID_0, NAME_1, NAME_2 and wkb of the bands; those from 3 to 6 degrees are cut short."""
        return _with_wkb(self.admin(2), wkb="rings").selectExpr(
            "country_id AS GID_0",
            "gadm_1 AS NAME_1",
            "gadm_2 AS NAME_2",
            f"CASE WHEN ymin = 3 THEN substring(wkb, 1, 40) WHEN ymin = 6 THEN {_multi_wkb('wkb')} ELSE wkb END AS wkb",
        )

    def admin(self, level: int = 2) -> DataFrame:
        """Strips of 2 degrees by region, cut into bands of 3 degrees by nation."""
        regions = self.table("region").selectExpr("r_regionkey", "r_name AS gadm_1")
        # r_regionkey and n_nationkey number the regions and nations from 0.
        if level == 1:
            boxes = regions.selectExpr("*", "0 AS lo", "15 AS hi")
            names = ["gadm_1"]
        else:
            boxes = (
                self.table("nation")
                .selectExpr(
                    "n_regionkey AS r_regionkey",
                    "n_name AS gadm_2",
                    "rank() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS band",
                )
                .join(regions, "r_regionkey")
                .selectExpr("*", "band * 3 AS lo", "band * 3 + 3 AS hi")
            )
            names = ["gadm_1", "gadm_2"]
        x1, x2 = "(20 + 2 * r_regionkey)", "(22 + 2 * r_regionkey)"
        ring = _points((x1, "lo"), (x2, "lo"), (x2, "hi"), (x1, "hi"), (x1, "lo"))
        return g.with_bounds(
            boxes.selectExpr("'XXX' AS country_id", *names, f"array({ring}) AS rings")
        )

    def admin_uneven(self) -> DataFrame:
        """The same strips; every other one has its inner borders a degree lower."""
        regions = self.table("region").selectExpr("r_regionkey", "r_regionkey % 2 AS odd")
        boxes = (
            self.table("nation")
            .selectExpr(
                "n_regionkey AS r_regionkey",
                "rank() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS band",
                "count(*) OVER (PARTITION BY n_regionkey) AS bands",
            )
            .join(regions, "r_regionkey")
            .selectExpr(
                "*",
                "IF(band = 0, 0, band * 3 - odd) AS lo",
                "IF(band = bands - 1, 3 * bands, band * 3 + 3 - odd) AS hi",
            )
        )
        x1, x2 = "(20 + 2 * r_regionkey)", "(22 + 2 * r_regionkey)"
        ring = _points((x1, "lo"), (x2, "lo"), (x2, "hi"), (x1, "hi"), (x1, "lo"))
        return g.with_bounds(boxes.selectExpr(f"array({ring}) AS rings"))

    def excluded_strips(self) -> DataFrame:
        """One strip for each region up to 26 degrees, each starting 0.3 degrees later."""
        x = "(200 + 3 * r_regionkey) / 10D"
        ring = _points((x, "0"), ("26", "0"), ("26", "15"), (x, "15"), (x, "0"))
        return self.table("region").selectExpr("r_regionkey AS exclude_id", f"array({ring}) AS rings")

    def settlements(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_name AS name",
            "(2000 + (s_suppkey * 37) % 1000) / 100D AS lon",
            "((s_suppkey * 53) % 1500) / 100D AS lat",
        )

    def scenes(self) -> DataFrame:
        """scene_id, ts_ms, cloud_pct and a footprint of one cell.

        Scene days run from 2023-12-01, which is day 19692 since the epoch.
        """
        x0, y0 = "(200000 + 1000 * (o_custkey % 100))", "(1000 * (o_custkey DIV 100))"
        return self.table("orders").selectExpr(
            "o_orderkey AS scene_id",
            "((19692 + o_orderkey % 92) * 86400 + 36000 + (o_orderkey % 60) * 60) * 1000 AS ts_ms",
            "CAST((o_orderkey * 17) % 40 AS DOUBLE) AS cloud_pct",
            f"{x0} / 10000D AS xmin",
            f"{y0} / 10000D AS ymin",
            f"({x0} + 1000) / 10000D AS xmax",
            f"({y0} + 1000) / 10000D AS ymax",
        )

    def pixels(self) -> DataFrame:
        """At most seven pixels per scene, placed by the cell of the scene."""
        values = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.avg("l_extendedprice").alias("b8"), F.avg("l_quantity").alias("quantity"))
            .withColumnsRenamed({"l_orderkey": "scene_id", "l_linenumber": "px"})
        )
        cells = self.table("orders").selectExpr("o_orderkey AS scene_id", "o_custkey AS cell")
        return values.join(cells, "scene_id").selectExpr(
            "scene_id",
            "CAST(px AS BIGINT) AS px",
            "1L AS py",
            *_pixel_place("cell", "px"),
            "b8",
            "quantity * 2000 AS b12",
        )

    def burnt_cells(self) -> DataFrame:
        """Burnt pixels of made-up scene pairs, a fifth to half of 25 by 20 pixels each."""
        return self.table("lineitem").selectExpr(
            "l_orderkey DIV 100 AS before_scene",
            "l_orderkey % 2 AS after_scene",
            "l_partkey % 25 AS px",
            "(l_orderkey DIV 2) % 20 AS py",
        ).distinct()

    def buildings(self) -> DataFrame:
        """Small squares centred on a pixel of the cell."""
        placed = self._with_cell(self.table("part"), "p_partkey").selectExpr(
            "p_partkey AS building_id",
            "p_size / 50D AS confidence",
            *_pixel_place("cell", "(p_size % 7 + 1)"),
        )
        boxed = placed.selectExpr(
            "building_id",
            "confidence",
            "lon - 2e-4D AS xmin",
            "lat - 2e-4D AS ymin",
            "lon + 2e-4D AS xmax",
            "lat + 2e-4D AS ymax",
        )
        ring = _points(
            ("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")
        )
        return boxed.selectExpr("*", f"array({ring}) AS rings")

    def include_cover(self, keep: tuple[str, ...] = ("area_id",)) -> PolygonCover:
        return polygon_cover(self.areas(), list(keep), small_edges=None)

    def admin_cover(self, level: int = 2) -> PolygonCover:
        names = ["country_id", "gadm_1", "gadm_2"][: level + 1]
        return polygon_cover(self.admin(level), names, small_edges=None)

    def in_areas(self) -> DataFrame:
        """Detections with the areas they touch."""
        return points_in_polygons(
            self.detections().select("firms_id", "acq_date", "lon", "lat"), self.include_cover()
        )

    def sample_results(self) -> DataFrame:
        """Detections in areas with results of every kind, from the detection number."""
        empty = "firms_id % 11 = 0 OR firms_id % 7 = 0"
        return self.in_areas().selectExpr(
            "*",
            "firms_id % 11 = 0 AS no_data",
            "firms_id % 11 != 0 AND firms_id % 7 = 0 AS too_cloudy",
            f"IF({empty}, NULL, date_sub(acq_date, CAST(firms_id % 5 + 1 AS INT))) AS before_date",
            f"IF({empty}, NULL, date_add(acq_date, CAST(firms_id % 3 + 1 AS INT))) AS after_date",
            "firms_id % 4 = 0 AS burn_scar_detected",
            "firms_id % 50 AS burnt_pixel_count",
            "firms_id % 6 AS burnt_building_count",
        )


_CELL = "CAST(substring(area_id, 2) AS BIGINT)"
# Little-endian WKB of the position (0, 0).
POINT_WKB = "unhex(concat('0101000000', repeat('00', 16)))"


def _with_wkb(polygons: DataFrame, **rings: str) -> DataFrame:
    """Add a WKB column for each expression that gives rings."""
    ship_package(polygons.sparkSession)
    return polygons.withColumns({name: encode_wkb(F.expr(value)) for name, value in rings.items()})


def _multi_wkb(*parts: str) -> str:
    """A multipolygon of up to 255 parts that are WKB columns."""
    return f"concat(unhex('0106000000{len(parts):02x}000000'), {', '.join(parts)})"


def area_name(key: str) -> str:
    return f"concat('A', lpad(CAST({key} AS STRING), 9, '0'))"


def _points(*corners: tuple[str, str]) -> str:
    structs = ", ".join(
        f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))" for x, y in corners
    )
    return f"array({structs})"


def _ring(cell: str, corners) -> str:
    return _points(
        *[
            (
                f"(200000 + 1000 * ({cell} % 100) + {dx}) / 10000D",
                f"(1000 * ({cell} DIV 100) + {dy}) / 10000D",
            )
            for dx, dy in corners
        ]
    )


def _box(cell: str, corners) -> dict[str, str]:
    """Bounds of a ring of the cell, from the same whole numbers as its corners."""
    xs, ys = [dx for dx, _ in corners], [dy for _, dy in corners]
    x0, y0 = f"200000 + 1000 * ({cell} % 100)", f"1000 * ({cell} DIV 100)"
    return {
        "xmin": f"({x0} + {min(xs)}) / 10000D",
        "ymin": f"({y0} + {min(ys)}) / 10000D",
        "xmax": f"({x0} + {max(xs)}) / 10000D",
        "ymax": f"({y0} + {max(ys)}) / 10000D",
    }


def _pixel_place(cell: str, px: str) -> list[str]:
    return [
        f"(200000 + 1000 * ({cell} % 100) + 125 * {px}) / 10000D AS lon",
        f"(1000 * ({cell} DIV 100) + 125 * (({px} * 3) % 7 + 1)) / 10000D AS lat",
    ]
