"""Point-in-polygon joins over a grid of cells.

A spatial predicate alone would plan as a nested loop, so polygons are turned
into a *cover*: one row per grid cell they touch. A point has one cell, the join
is an equality join on the cell, and the exact test runs on the rows that meet.

Polygons with few edges keep all edges in every cover row. Polygons with many
edges are cut up: a cell row holds only the edges passing through that cell plus
whether the cell's reference position is inside, so neither the row size nor the
work per point grows with the length of the whole border.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.schemas import EDGES
from emberscope.session import cut_lineage

SMALL_POLYGON_EDGES = 64
# Edges times cells up to which a polygon is cut up within its row.
FEW_EDGE_CELLS = 4096
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
_ROW_BYTES, _EDGE_BYTES = 160, 32
# Place of the reference position inside a cell, kept off round fractions so that
# polygon vertices do not fall on its row or column.
_REF_SHARE_X, _REF_SHARE_Y = 0.41421356, 0.31830988

_COVER_COLUMNS = ("cov_ix", "cov_iy", "cov_ref_x", "cov_ref_y", "cov_ref_inside", "cov_edges")
_BOX_COLUMNS = ("cov_xmin", "cov_ymin", "cov_xmax", "cov_ymax")


@dataclass
class PolygonCover:
    """Cover rows with the grid they were made for."""

    frame: DataFrame
    cell_deg: float
    keep: tuple[str, ...]
    _fits: bool | None = field(default=None, repr=False)

    def fits_broadcast(self, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
        """Measure the cover once; reading stops as soon as it is too large."""
        if self._fits is None:
            max_rows = max_bytes // _ROW_BYTES
            rows, edges = (
                self.frame.select(F.size("cov_edges").alias("n"))
                .limit(max_rows + 1)
                .selectExpr("count(*)", "coalesce(sum(n), 0)")
                .first()
            )
            self._fits = rows <= max_rows and rows * _ROW_BYTES + edges * _EDGE_BYTES <= max_bytes
        return self._fits

    def stored(self) -> PolygonCover:
        """The same cover, checkpointed; worth it where it is costly to build."""
        return PolygonCover(cut_lineage(self.frame), self.cell_deg, self.keep)

    def side(self) -> DataFrame:
        """The cover as a join side: broadcast when measured small, else shuffled
        (adaptive execution then splits hot cells)."""
        return F.broadcast(self.frame) if self.fits_broadcast() else self.frame


# Cells along the side of a grid cell where corners are looked up on edges.
CORNER_CELLS = 4


def explode_cells(df: DataFrame, cell_deg: float, prefix: str = "cov_") -> DataFrame:
    """One row per grid cell of the row's box (xmin, ymin, xmax, ymax)."""
    xs = f"sequence({g.cell_sql('xmin', cell_deg)}, {g.cell_sql('xmax', cell_deg)})"
    ys = f"sequence({g.cell_sql('ymin', cell_deg)}, {g.cell_sql('ymax', cell_deg)})"
    return df.selectExpr("*", f"explode({xs}) AS {prefix}ix").selectExpr(
        "*", f"explode({ys}) AS {prefix}iy"
    )


def _edge_in_cell(edge: str, cell_deg: float) -> str:
    """Edge passes through the cell, with a hair of slack so none is missed."""
    slack, s = f"{cell_deg * 1e-6!r}D", f"{float(cell_deg)!r}D"
    return g.edge_meets_box_sql(
        edge,
        f"(cov_ix * {s} - {slack})",
        f"(cov_iy * {s} - {slack})",
        f"((cov_ix + 1) * {s} + {slack})",
        f"((cov_iy + 1) * {s} + {slack})",
    )


def polygon_cover(
    polygons: DataFrame,
    keep: list[str],
    cell_deg: float = 0.1,
    small_edges: int | None = SMALL_POLYGON_EDGES,
) -> PolygonCover:
    """Cover of a polygon table (rings, xmin, ymin, xmax, ymax and ``keep``).

    Polygons of more than ``small_edges`` edges are cut up. ``None`` keeps all
    whole; use it for tables known to hold simple shapes only, as it leaves the
    cut-up out of the plan.
    """
    base = polygons.select(
        *keep, "xmin", "ymin", "xmax", "ymax", g.ring_edges().alias("cov_edges")
    )
    boxes = [f"{c[4:]} AS {c}" for c in _BOX_COLUMNS]
    small = base if small_edges is None else base.filter(f"size(cov_edges) <= {small_edges}")
    cover = explode_cells(small, cell_deg).selectExpr(
        *keep,
        "cov_ix",
        "cov_iy",
        "CAST(NULL AS DOUBLE) AS cov_ref_x",
        "CAST(NULL AS DOUBLE) AS cov_ref_y",
        "CAST(NULL AS BOOLEAN) AS cov_ref_inside",
        "cov_edges",
        *boxes,
    )
    if small_edges is not None:
        large = base.filter(f"size(cov_edges) > {small_edges}")
        (x0, x1), (y0, y1) = ((g.cell_sql(f"{c}min", cell_deg), g.cell_sql(f"{c}max", cell_deg)) for c in "xy")
        few = f"CAST(size(cov_edges) AS DOUBLE) * ({x1} - {x0} + 1) * ({y1} - {y0} + 1) <= {FEW_EDGE_CELLS}"
        many = large.filter(f"NOT coalesce({few}, false)").withColumn("cov_id", F.expr("md5(to_json(cov_edges))"))
        for cut in (_cut_in_row(large.filter(few), keep, cell_deg), _cut_up(many, keep, cell_deg, "cov_id")):
            cover = cover.unionByName(cut.selectExpr(*keep, *_COVER_COLUMNS, *boxes))
    return PolygonCover(cover, cell_deg, tuple(keep))


def _reference(cell_deg: float) -> tuple[str, str]:
    s = f"{float(cell_deg)!r}D"
    return f"((cov_ix + {_REF_SHARE_X}D) * {s})", f"((cov_iy + {_REF_SHARE_Y}D) * {s})"


def _flip_cell(ref_y: str, cell_deg: float) -> str:
    """The first cell of a grid row whose reference position is right of the edge ``e``."""
    return (
        f"CAST(floor((e.x1 + ({ref_y} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)) / {float(cell_deg)!r}D"
        f" - {_REF_SHARE_X}D) AS BIGINT) + 1"
    )


def _cut_in_row(polygons: DataFrame, keep: list[str], cell_deg: float) -> DataFrame:
    """What ``_cut_up`` makes of polygons with few edges and cells, without moving a row."""
    ref_x, ref_y = _reference(cell_deg)
    (x0, x1), (y0, y1) = ((g.cell_sql(f"{c}min", cell_deg), g.cell_sql(f"{c}max", cell_deg)) for c in "xy")
    spans = lambda c: (
        f"cov_i{c} BETWEEN {g.cell_sql(f'least(e.{c}1, e.{c}2)', cell_deg)}"
        f" AND {g.cell_sql(f'greatest(e.{c}1, e.{c}2)', cell_deg)}"
    )
    box = ["xmin", "ymin", "xmax", "ymax"]
    rows = polygons.selectExpr(*keep, *box, "cov_edges", f"explode(sequence({y0}, {y1})) AS cov_iy").selectExpr(
        *keep, *box, "cov_iy",
        f"filter(cov_edges, e -> {spans('y')}) AS row_edges",
        f"transform(filter(cov_edges, e -> (e.y1 <= {ref_y}) != (e.y2 <= {ref_y})),"
        f" e -> {_flip_cell(ref_y, cell_deg)}) AS flips",
    )
    # One array of cells, so that no filter is moved to where edges are tested again.
    cells = (
        f"filter(transform(sequence({x0}, {x1}), cov_ix -> named_struct('cov_ix', cov_ix,"
        f" 'cov_edges', filter(row_edges, e -> {spans('x')} AND {_edge_in_cell('e', cell_deg)}),"
        " 'cov_ref_inside', size(filter(flips, f -> f <= cov_ix)) % 2 = 1)),"
        " c -> size(c.cov_edges) > 0 OR c.cov_ref_inside)"
    )
    return rows.selectExpr(*keep, *box, "cov_iy", f"inline({cells})").selectExpr(
        "*", f"{ref_x} AS cov_ref_x", f"{ref_y} AS cov_ref_y"
    )


def _cut_up(large: DataFrame, keep: list[str], cell_deg: float, id_col: str) -> DataFrame:
    """Per cell: the edges passing through and the parity of the reference position."""
    ref_x, ref_y = _reference(cell_deg)
    # Equal content is built once, the labels bring the copies back.
    unique = large.groupBy(id_col).agg(
        *[F.first(c).alias(c) for c in ("cov_edges", "xmin", "ymin", "xmax", "ymax")]
    )
    edges = unique.select(id_col, F.explode("cov_edges").alias("e"))
    edge_boxes = edges.selectExpr(
        id_col,
        "e",
        "least(e.x1, e.x2) AS xmin",
        "greatest(e.x1, e.x2) AS xmax",
        "least(e.y1, e.y2) AS ymin",
        "greatest(e.y1, e.y2) AS ymax",
    )
    edge_cells = (
        explode_cells(edge_boxes, cell_deg)
        .filter(_edge_in_cell("e", cell_deg))
        .groupBy(id_col, "cov_ix", "cov_iy")
        .agg(F.collect_list("e").alias("cov_edges"))
    )
    # An edge flips the parity of all reference positions to its right in each
    # grid row whose reference height it spans.
    rows = f"sequence({g.cell_sql('ymin', cell_deg)}, {g.cell_sql('ymax', cell_deg)})"
    flips = (
        edge_boxes.selectExpr(id_col, "e", f"explode({rows}) AS cov_iy")
        .filter(f"(e.y1 <= {ref_y}) != (e.y2 <= {ref_y})")
        .selectExpr(
            id_col,
            "cov_iy",
            f"{_flip_cell(ref_y, cell_deg)} AS cov_ix",
        )
        .groupBy(id_col, "cov_ix", "cov_iy")
        .agg(F.count("*").alias("n_flips"))
    )
    along_row = Window.partitionBy(id_col, "cov_iy").orderBy("cov_ix")
    return (
        explode_cells(unique.drop("cov_edges"), cell_deg)
        .join(flips, [id_col, "cov_ix", "cov_iy"], "left")
        .withColumn(
            "cov_ref_inside", F.sum(F.expr("coalesce(n_flips, 0)")).over(along_row) % 2 == 1
        )
        .join(edge_cells, [id_col, "cov_ix", "cov_iy"], "left")
        .filter("cov_edges IS NOT NULL OR cov_ref_inside")
        .selectExpr(
            id_col,
            "xmin",
            "ymin",
            "xmax",
            "ymax",
            "cov_ix",
            "cov_iy",
            f"{ref_x} AS cov_ref_x",
            f"{ref_y} AS cov_ref_y",
            "cov_ref_inside",
            f"coalesce(cov_edges, CAST(array() AS {EDGES})) AS cov_edges",
        )
        .join(large.select(id_col, *keep), id_col)
    )


def _same_cell(cell_deg: float, lon: str, lat: str) -> str:
    return f"{g.cell_sql(lon, cell_deg)} = cov_ix AND {g.cell_sql(lat, cell_deg)} = cov_iy"


def points_in_polygons(
    points: DataFrame,
    cover: PolygonCover,
    how: str = "inner",
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """Join points with the polygons they touch.

    ``inner`` gives one row per (point, polygon) with the cover's kept columns;
    ``left_semi`` / ``left_anti`` keep or drop points that touch any polygon.
    """
    touches = g.touches_polygon_sql(
        lon, lat, "cov_edges", "cov_ref_x", "cov_ref_y", "cov_ref_inside"
    )
    on = F.expr(
        f"{_same_cell(cover.cell_deg, lon, lat)}"
        f" AND {lon} BETWEEN cov_xmin AND cov_xmax AND {lat} BETWEEN cov_ymin AND cov_ymax"
        f" AND ({touches})"
    )
    joined = points.join(cover.side(), on, how)
    return joined.drop(*_COVER_COLUMNS, *_BOX_COLUMNS) if how == "inner" else joined


def outside_polygons(
    points: DataFrame, cover: PolygonCover, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Points touching none of the polygons (exclusion areas as documented)."""
    return points_in_polygons(points, cover, "left_anti", lon, lat)


def touching_every_polygon(
    points: DataFrame,
    polygons: DataFrame,
    cover: PolygonCover,
    key: str,
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """Points touching all polygons, or all points when there are none.

    The literal reading of an exclusion written as a left join on "does not
    intersect" followed by a null test.
    """
    hits = (
        points_in_polygons(points.select(key, lon, lat).distinct(), cover, "inner", lon, lat)
        .groupBy(key)
        .agg(F.count("*").alias("n_hit"))
    )
    total = polygons.agg(F.count("*").alias("n")).scalar()
    return (
        points.join(hits, key, "left")
        .filter(F.coalesce("n_hit", F.lit(0)) == total)
        .drop("n_hit")
    )


def polygon_extent(polygons: DataFrame) -> DataFrame:
    """One row: the box around all polygons."""
    return polygons.selectExpr(
        "min(xmin) AS min_x", "min(ymin) AS min_y", "max(xmax) AS max_x", "max(ymax) AS max_y"
    )


def clip_to_union(
    points: DataFrame,
    polygons: DataFrame,
    cell_deg: float = 0.1,
    lon: str = "lon",
    lat: str = "lat",
    small_edges: int | None = SMALL_POLYGON_EDGES,
) -> DataFrame:
    """Points strictly inside the union of the polygons.

    Borders between polygons belong to the union, also where only one side has a corner
    on them; points on its outline are dropped.
    """
    cover = polygon_cover(polygons, [], cell_deg, small_edges)
    inside = points_in_polygons(points, cover, "left_semi", lon, lat)
    cells = (
        explode_cells(union_outline(polygons, cell_deg), cell_deg)
        .filter(_edge_in_cell("e", cell_deg))
        .groupBy("cov_ix", "cov_iy")
        .agg(F.collect_list(F.struct("e", "xmin", "ymin", "xmax", "ymax")).alias("cov_edges"))
    )
    border = PolygonCover(cells, cell_deg, ())
    on = F.expr(
        f"{_same_cell(cell_deg, lon, lat)} AND {g.on_any_part_sql(lon, lat, 'cov_edges')}"
    )
    return inside.join(border.side(), on, "left_anti")


def union_outline(polygons: DataFrame, cell_deg: float = 0.1) -> DataFrame:
    """Parts of edges that bound the union: the edge ``e`` and the box of the part.

    Edges that two polygons have in common go first. What is left is cut at every corner
    that lies on it, so that a long edge meets the shorter ones of its other side piece by
    piece, and pieces met twice go as well. Corners are looked up by grid cell; only edges
    without an equal take part, on real borders a small share but for the outline itself.
    A part keeps its whole edge, so a position is judged by the same line everywhere.
    """
    single = cut_lineage(
        polygons.select(F.explode(g.ring_edges()).alias("e"))
        .selectExpr(
            "CASE WHEN e.x1 < e.x2 OR (e.x1 = e.x2 AND e.y1 <= e.y2) THEN e"
            " ELSE named_struct('x1', e.x2, 'y1', e.y2, 'x2', e.x1, 'y2', e.y1) END AS e"
        )
        .groupBy("e")
        .agg(F.count("*").alias("n"))
        .filter("n = 1")
        .selectExpr(
            "e", "e.x1 AS xmin", "e.x2 AS xmax", "least(e.y1, e.y2) AS ymin", "greatest(e.y1, e.y2) AS ymax"
        )
    )
    size = cell_deg / CORNER_CELLS
    corners = (
        single.selectExpr("inline(array(struct(e.x1 AS x, e.y1 AS y), struct(e.x2 AS x, e.y2 AS y)))")
        .distinct()
        .selectExpr("x", "y", f"{g.cell_sql('x', size)} AS cov_ix", f"{g.cell_sql('y', size)} AS cov_iy")
    )
    cuts = (
        explode_cells(single, size)
        .filter(_edge_in_cell("e", size))
        .select("e", "cov_ix", "cov_iy")
        .join(corners, ["cov_ix", "cov_iy"])
        .filter(g.inside_edge_sql("e", "x", "y"))
        .groupBy("e")
        .agg(F.collect_set(F.struct("x", "y")).alias("cuts"))
    )
    # Edges run to larger (x, y), so sorted cuts are in order along them.
    nodes = (
        "concat(array(struct(e.x1 AS x, e.y1 AS y)), array_sort(coalesce(cuts, array())),"
        " array(struct(e.x2 AS x, e.y2 AS y)))"
    )
    parts = single.join(cuts, "e", "left").selectExpr("e", f"{nodes} AS nodes").selectExpr(
        "e",
        "explode(transform(sequence(1, size(nodes) - 1), i -> struct(nodes[i - 1] AS a, nodes[i] AS b))) AS part",
    )
    return (
        parts.groupBy("part")
        .agg(F.count("*").alias("n"), F.min("e").alias("e"))
        .filter("n = 1")
        .selectExpr(
            "e", "part.a.x AS xmin", "part.b.x AS xmax",
            "least(part.a.y, part.b.y) AS ymin", "greatest(part.a.y, part.b.y) AS ymax",
        )
    )
