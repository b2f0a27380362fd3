"""Polygon tables: GeoPackage scan, WKB, parts, ids, checks, area and admin views."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from emberscope.functions import geometry as g
from emberscope.schemas import AREA
from emberscope.session import cut_lineage, ship_package
from emberscope.sources.wkb import decode, decode_wkb, encode_wkb

GEOPACKAGE_SCHEMA_COLUMNS = "file_mtime double, wkb binary"


class _RowidRange(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class GeoPackageReader(DataSourceReader):
    """Splits a feature table by row id; every task opens the file read-only."""

    def __init__(self, schema, options):
        self.path = options["path"]
        self.layer = options["layer"]
        self.geometry = options.get("geometry", "geom")
        self.rows_per_task = int(options.get("rowsPerTask", "10000"))
        self.columns = [f.name for f in schema.fields if f.name not in ("wkb", "file_mtime")]

    def _connect(self):
        import sqlite3

        if not os.path.exists(self.path):
            raise FileNotFoundError(self.path)
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        with self._connect() as con:
            low, high = con.execute(
                f'SELECT min(rowid), max(rowid) FROM "{self.layer}"'
            ).fetchone()
        if low is None:
            return [_RowidRange(0, 0)]
        return [
            _RowidRange(start, min(start + self.rows_per_task, high + 1))
            for start in range(low, high + 1, self.rows_per_task)
        ]

    def read(self, partition):
        mtime = os.path.getmtime(self.path)
        names = "".join(f'"{c}", ' for c in self.columns)
        with self._connect() as con:
            for *values, blob in con.execute(
                f'SELECT {names}"{self.geometry}" FROM "{self.layer}" WHERE rowid >= ? AND rowid < ?',
                (partition.low, partition.high),
            ):
                yield (*values, mtime, wkb_of_geopackage(blob))


class GeoPackageSource(DataSource):
    """``spark.read.format("geopackage")``: attribute columns, file_mtime, wkb.

    Options: path, layer, columns (comma separated text columns), geometry,
    rowsPerTask.
    """

    @classmethod
    def name(cls):
        return "geopackage"

    def schema(self):
        columns = [c for c in self.options.get("columns", "").split(",") if c]
        return ", ".join([*[f"{c} string" for c in columns], GEOPACKAGE_SCHEMA_COLUMNS])

    def reader(self, schema):
        return GeoPackageReader(schema, self.options)


def wkb_of_geopackage(blob: bytes | None) -> bytes | None:
    """Drop the GeoPackage header (magic, version, flags, srs id, optional box)."""
    if blob is None:
        return None
    envelope = (blob[3] >> 1) & 0b111
    return bytes(blob[8 + (0, 32, 48, 48, 64)[envelope] :])


def parts_of_wkb(wkb: bytes) -> list[list[list[dict[str, float]]]]:
    """One polygon or multipolygon as parts of rings of {x, y}."""
    (parts,) = decode(pa.array([wkb], pa.binary())).to_pylist()
    if parts is None:
        raise ValueError("not a polygon geometry")
    return [part["rings"] for part in parts]


def read_geopackage(
    spark: SparkSession, path: str, layer: str, columns: list[str] = (), **options: str
) -> DataFrame:
    """Feature table with its attributes, ``file_mtime`` and ``wkb``."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    ship_package(spark)
    spark.dataSource.register(GeoPackageSource)
    reader = spark.read.format("geopackage").option("path", path).option("layer", layer)
    for key, value in {"columns": ",".join(columns), **options}.items():
        reader = reader.option(key, value)
    return reader.load()


def features_at(spark: SparkSession, path: str, layer: str, columns: list[str] = ()) -> DataFrame:
    """Feature table with ``wkb`` and ``file_mtime``: Parquet, or a layer of a GeoPackage.

    Parquet is read by every executor, so it is the form for a cluster.
    """
    if path.endswith(".gpkg") or ".gpkg." in path:
        return read_geopackage(spark, path, layer, columns)
    changed = F.unix_micros("_metadata.file_modification_time") / 1e6
    return spark.read.parquet(path).select(*columns, changed.alias("file_mtime"), "wkb")


def single_polygons(features: DataFrame, wkb: str = "wkb", content_id: str | None = None) -> DataFrame:
    """One row per part of each (multi)polygon: other columns, rings and box.

    ``content_id`` names a column for the md5 of the part's WKB. A geometry that is null or
    cannot be decoded keeps a row without rings, which :func:`check_polygons` rejects.
    """
    ship_package(features.sparkSession)
    rest = [c for c in features.columns if c != wkb]
    parts = features.select(*rest, F.explode_outer(decode_wkb(wkb)).alias("part"))
    ids = [] if content_id is None else [F.md5("part.wkb").alias(content_id)]
    return g.with_bounds(parts.select(*rest, *ids, F.col("part.rings").alias("rings")))


def with_content_id(polygons: DataFrame, out: str = "id") -> DataFrame:
    """md5 over the polygon's WKB: equal polygons share one id."""
    ship_package(polygons.sparkSession)
    return polygons.withColumn(out, F.md5(encode_wkb("rings")))


_AREA_COLUMNS = ("id", "rings", "xmin", "ymin", "xmax", "ymax", "file_mtime")


def area_polygons(spark: SparkSession, path: str | None, layer: str = "areas") -> DataFrame:
    """Include or exclude areas; no path means no areas. See :func:`read_areas` for the rejected ones."""
    return read_areas(spark, path, layer)[0]


def read_areas(spark: SparkSession, path: str | None, layer: str = "areas") -> tuple[DataFrame, DataFrame]:
    """(usable areas, rejected ones with a ``problem``) of a feature table."""
    if path is None:
        none = spark.createDataFrame([], AREA)
        return none, none.withColumn("problem", F.lit(None).cast("string"))
    usable, rejected = checked_areas(features_at(spark, path, layer))
    return usable.select(*_AREA_COLUMNS), rejected.select(*_AREA_COLUMNS[1:], "problem")


def checked_areas(features: DataFrame, wkb: str = "wkb") -> tuple[DataFrame, DataFrame]:
    """(usable polygons with their content id, rejected ones with a ``problem``).

    Takes any table with a WKB column. Together the two hold every part of every
    feature; polygons that cross themselves are rejected as well. Features are decoded
    once: both halves come from the stored parts.
    """
    parts = cut_lineage(single_polygons(features, wkb, "id"))
    valid, rejected = check_polygons(parts)
    crossing = cut_lineage(self_crossings(valid, "id"))
    crossed = valid.join(crossing, "id", "left_semi").withColumn("problem", F.lit("crosses itself"))
    return valid.join(crossing, "id", "left_anti"), rejected.unionByName(crossed).drop("id")


def admin_polygons(spark: SparkSession, path: str, level: int) -> DataFrame:
    """Administrative areas of one level with the names down to it."""
    return read_admin(spark, path, level)[0]


def read_admin(spark: SparkSession, path: str, level: int) -> tuple[DataFrame, DataFrame]:
    """(administrative areas, rejected ones with a ``problem``) of a feature table."""
    if level not in (1, 2, 3):
        raise ValueError("gadm_level must be 1, 2 or 3")
    names = [f"NAME_{n}" for n in range(1, level + 1)]
    return admin_areas(features_at(spark, path, f"ADM_ADM_{level}", ["GID_0", *names]), level)


def admin_areas(features: DataFrame, level: int, wkb: str = "wkb") -> tuple[DataFrame, DataFrame]:
    """(areas with their names, rows whose geometry is missing, empty or no polygon).

    Takes any table with ``GID_0``, ``NAME_1`` and on, and a WKB column.
    """
    ship_package(features.sparkSession)
    parts = features.select(
        F.col("GID_0").alias("country_id"),
        *[F.col(f"NAME_{n}").alias(f"gadm_{n}") for n in range(1, level + 1)],
        F.flatten(F.transform(decode_wkb(wkb), lambda p: p["rings"])).alias("rings"),
    )
    # Parts of one area do not overlap, so even-odd counting over all their rings
    # keeps the area one row.
    boxed = cut_lineage(g.with_bounds(parts))
    usable = F.coalesce(F.size("rings"), F.lit(0)) > 0
    rejected = boxed.filter(~usable).withColumn(
        "problem", F.when(F.col("rings").isNull(), "no polygon").otherwise("empty")
    )
    return boxed.filter(usable), rejected


def self_crossings(
    polygons: DataFrame, key: str, max_edges: int = 64, max_splits: int = 20
) -> DataFrame:
    """Keys of polygons with two edges crossing away from their ends.

    Edges meet through grid cells sized to the polygon and its edge count. A cell
    with more than ``max_edges`` edges is split in four, again and again, so an
    edge is compared with a short list even where a border is very detailed.
    """
    cells = polygons.selectExpr(
        key,
        "xmin",
        "ymin",
        "greatest(xmax - xmin, ymax - ymin) / pow(2D, ceil(log2(sqrt(greatest(1,"
        " aggregate(rings, 0, (s, r) -> s + size(r))))))) AS step",
        "rings",
    ).filter("step > 0D")
    cells = cells.select(key, "xmin", "ymin", "step", F.posexplode(g.ring_edges()).alias("n", "e"))
    for axis in ("x", "y"):
        low, high = f"least(e.{axis}1, e.{axis}2)", f"greatest(e.{axis}1, e.{axis}2)"
        cells = cells.selectExpr(
            "*",
            f"explode(sequence(CAST(floor(({low} - {axis}min) / step) AS BIGINT),"
            f" CAST(floor(({high} - {axis}min) / step) AS BIGINT))) AS i{axis}",
        )
    cell = [key, "step", "ix", "iy"]
    short = None
    for depth in range(max_splits + 1):
        crowded = (
            cells.groupBy(*cell)
            .agg(F.count("*").alias("n_edges"))
            .filter(f"n_edges > {max_edges}")
            .select(*cell)
        )
        last = depth == max_splits or crowded.limit(1).count() == 0
        done = cells if last else cells.join(crowded, cell, "left_anti")
        short = done if short is None else short.unionByName(done)
        if last:
            break
        # A hair of slack keeps edges that run along the line between two parts.
        box = [
            f"({axis}min + ({i} + {side}) * step {sign} step * 1e-6D)"
            for side, sign in (("0", "-"), ("1", "+"))
            for axis, i in (("x", "ix"), ("y", "iy"))
        ]
        cells = cut_lineage(
            cells.join(crowded, cell, "left_semi")
            .selectExpr(key, "xmin", "ymin", "step / 2D AS step", "n", "e", "ix AS cx", "iy AS cy",
                        "explode(array(0, 1, 2, 3)) AS part")
            .selectExpr(key, "xmin", "ymin", "step", "n", "e", "cx * 2 + part % 2 AS ix",
                        "cy * 2 + part DIV 2 AS iy")
            .filter(g.edge_meets_box_sql("e", *box))
        )
    other = short.select(*cell, F.col("n").alias("m"), F.col("e").alias("f"))

    def turn(e: str, x: str, y: str) -> str:
        return f"sign(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"

    crossing = (
        f"{turn('e', 'f.x1', 'f.y1')} * {turn('e', 'f.x2', 'f.y2')} < 0"
        f" AND {turn('f', 'e.x1', 'e.y1')} * {turn('f', 'e.x2', 'e.y2')} < 0"
    )
    return short.join(other, cell).filter(f"n < m AND {crossing}").select(key).distinct()


def check_polygons(polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable polygons, rejected ones with a ``problem``).

    Rings must be closed, have four positions or more and enclose an area.
    Nothing is repaired; self crossings are listed by :func:`self_crossings`.
    """
    judged = polygons.withColumn(
        "problem",
        F.expr(
            "CASE WHEN rings IS NULL OR size(rings) = 0 THEN 'empty'"
            " WHEN exists(rings, r -> size(r) < 4) THEN 'too few positions'"
            " WHEN exists(rings, r -> r[0] != r[size(r) - 1]) THEN 'ring not closed'"
            " WHEN exists(rings, r -> aggregate(zip_with(slice(r, 1, size(r) - 1),"
            " slice(r, 2, size(r) - 1), (a, b) -> a.x * b.y - b.x * a.y), 0D, (s, t) -> s + t) = 0D)"
            " THEN 'no area' END"
        ),
    )
    return judged.filter("problem IS NULL").drop("problem"), judged.filter("problem IS NOT NULL")
