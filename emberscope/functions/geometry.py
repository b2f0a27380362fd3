"""Geometry as columns.

A point is two double columns (lon, lat); a polygon is an array of rings, each a
closed array of {x, y}. The functions take SQL fragments (usually column names)
and build one Catalyst expression from SQL text, so each costs a single call to
the JVM when a plan is put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0  # sphere used for great-circle metres
EQUATOR_RADIUS_M = 6378137.0  # sphere used for the equidistant projection
METRES_PER_DEGREE = 111320.0


def cell_sql(value: str, size: float) -> str:
    """Index of the grid interval that holds ``value``."""
    return f"CAST(floor(({value}) / {float(size)!r}D) AS BIGINT)"


def cell_index(value: str, size: float) -> Column:
    return F.expr(cell_sql(value, size))


def ring_edges(rings: str = "rings") -> Column:
    """All edges of all rings as one array of {x1, y1, x2, y2}."""
    return F.expr(
        f"""flatten(transform(filter({rings}, r -> size(r) > 1), r ->
              zip_with(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1), (a, b) ->
                named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))))"""
    )


def with_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add xmin, ymin, xmax, ymax of a polygon column."""
    flat = f"flatten({rings})"
    return df.selectExpr(
        "*",
        f"array_min(transform({flat}, p -> p.x)) AS xmin",
        f"array_min(transform({flat}, p -> p.y)) AS ymin",
        f"array_max(transform({flat}, p -> p.x)) AS xmax",
        f"array_max(transform({flat}, p -> p.y)) AS ymax",
    )


def ring_area(ring: str) -> Column:
    """Shoelace area of a closed ring, positive when counter-clockwise."""
    return F.expr(
        f"""aggregate(zip_with(slice({ring}, 1, size({ring}) - 1), slice({ring}, 2, size({ring}) - 1),
              (a, b) -> a.x * b.y - b.x * a.y), 0D, (s, t) -> s + t) / 2D"""
    )


def _side(e: str, x: str, y: str) -> str:
    """Side of the edge's line a position lies on (0 = on the line)."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def on_any_edge_sql(x: str, y: str, edges: str) -> str:
    """Position lies on an edge; the cheap range tests come first."""
    return (
        f"exists({edges}, e -> {y} <= greatest(e.y1, e.y2) AND {y} >= least(e.y1, e.y2)"
        f" AND {x} <= greatest(e.x1, e.x2) AND {x} >= least(e.x1, e.x2)"
        f" AND {_side('e', x, y)} = 0D)"
    )


def on_any_part_sql(x: str, y: str, parts: str) -> str:
    """Position lies on a part of an edge: on the line of ``e``, inside the part's own box."""
    return (
        f"exists({parts}, p -> {y} BETWEEN p.ymin AND p.ymax AND {x} BETWEEN p.xmin AND p.xmax"
        f" AND {_side('p.e', x, y)} = 0D)"
    )


def inside_edge_sql(e: str, x: str, y: str) -> str:
    """Position lies on the edge, but is not one of its ends."""
    return (
        f"{y} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2)"
        f" AND {x} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2)"
        f" AND NOT ({x} = {e}.x1 AND {y} = {e}.y1) AND NOT ({x} = {e}.x2 AND {y} = {e}.y2)"
        f" AND {_side(e, x, y)} = 0D"
    )


def touches_polygon_sql(
    x: str, y: str, edges: str, ref_x: str, ref_y: str, ref_inside: str
) -> str:
    """Point inside the polygon or on its boundary; holes are outside.

    With a null ``ref_inside`` the edges are the whole polygon and the even-odd
    count runs along the point's own height. Otherwise the count is relative to a
    reference position of known parity: the path goes vertically to the point's
    height, then across to the point, so only edges meeting that path have to be
    in ``edges``. Both legs judge the turning point with the same side test, so
    rounding there cancels out.
    """
    straddles = f"(e.y1 <= {y}) != (e.y2 <= {y})"
    side = _side("e", x, y)
    # One pass over all edges: 0 / 1 is the parity so far, 2 means on an edge.
    whole = (
        f"aggregate({edges}, 0, (acc, e) -> CASE"
        f" WHEN (e.y1 < {y} AND e.y2 < {y}) OR (e.y1 > {y} AND e.y2 > {y}) OR acc = 2 THEN acc"
        f" WHEN {side} = 0D AND {x} >= least(e.x1, e.x2) AND {x} <= greatest(e.x1, e.x2) THEN 2"
        f" WHEN {straddles} AND ({side} > 0D) != (e.y2 > e.y1) THEN 1 - acc ELSE acc END) != 0"
    )
    turn = f"({_side('e', ref_x, y)} > 0D)"
    vertical = (
        f"((e.x1 <= {ref_x}) != (e.x2 <= {ref_x})"
        f" AND ({_side('e', ref_x, ref_y)} > 0D) != {turn})"
    )
    across = f"({straddles} AND ({side} > 0D) != {turn})"
    return (
        f"CASE WHEN {ref_inside} IS NULL THEN {whole}"
        f" WHEN size({edges}) = 0 THEN {ref_inside}"
        f" WHEN {on_any_edge_sql(x, y, edges)} THEN true"
        f" ELSE aggregate({edges}, {ref_inside}, (acc, e) -> acc != ({vertical} != {across})) END"
    )


def planar_distance_sql(x1: str, y1: str, x2: str, y2: str) -> str:
    """Plain distance in the units of the coordinates (degrees for lon/lat)."""
    return f"sqrt(({x1} - {x2}) * ({x1} - {x2}) + ({y1} - {y2}) * ({y1} - {y2}))"


def haversine_sql(
    lon1: str, lat1: str, lon2: str, lat2: str, axis_order: str = "lonlat"
) -> str:
    """Great-circle metres.

    ``axis_order='latlon'`` reads the first coordinate as latitude, which is what
    the original results did with (lon, lat) points.
    """
    if axis_order == "latlon":
        lon1, lat1, lon2, lat2 = lat1, lon1, lat2, lon2
    elif axis_order != "lonlat":
        raise ValueError("axis_order must be 'lonlat' or 'latlon'")
    half_lat = f"sin(radians({lat2} - {lat1}) / 2D)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2D)"
    return (
        f"({2.0 * EARTH_RADIUS_M!r}D * asin(least(1D, sqrt({half_lat} * {half_lat}"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * {half_lon} * {half_lon}))))"
    )


def distance_sql(
    lon1: str, lat1: str, lon2: str, lat2: str, unit: str = "metres", axis_order: str = "lonlat"
) -> str:
    if unit == "degrees":
        return planar_distance_sql(lon1, lat1, lon2, lat2)
    if unit == "metres":
        return haversine_sql(lon1, lat1, lon2, lat2, axis_order)
    raise ValueError("unit must be 'metres' or 'degrees'")


def with_aoi_bounds(df: DataFrame, buffer_m: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add the bounds of the square around a point buffered by ``buffer_m`` metres."""
    d_lat = f"{buffer_m / METRES_PER_DEGREE!r}D"
    d_lon = f"({float(buffer_m)!r}D / ({METRES_PER_DEGREE!r}D * cos(radians({lat}))))"
    return df.selectExpr(
        "*",
        f"{lon} - {d_lon} AS aoi_xmin",
        f"{lat} - {d_lat} AS aoi_ymin",
        f"{lon} + {d_lon} AS aoi_xmax",
        f"{lat} + {d_lat} AS aoi_ymax",
    )


def equidistant_projection(lon: str, lat: str) -> tuple[Column, Column]:
    """World equidistant cylindrical metres (spherical form)."""
    r = f"{EQUATOR_RADIUS_M!r}D"
    return F.expr(f"{r} * radians({lon})"), F.expr(f"{r} * radians({lat})")


def edge_meets_box_sql(e: str, xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """Segment and closed box share a position (separating axes)."""
    corners = ", ".join(
        _side(e, x, y) for x, y in ((xmin, ymin), (xmin, ymax), (xmax, ymin), (xmax, ymax))
    )
    return (
        f"(least({e}.x1, {e}.x2) <= {xmax} AND greatest({e}.x1, {e}.x2) >= {xmin}"
        f" AND least({e}.y1, {e}.y2) <= {ymax} AND greatest({e}.y1, {e}.y2) >= {ymin}"
        f" AND least({corners}) <= 0D AND greatest({corners}) >= 0D)"
    )
