"""Largest distance between two detections of one event, without listing pairs.

The farthest pair of a point set are corners of its convex hull, and a hull can
be built from the hulls of parts. So the points are reduced step by step with
ordinary aggregations: per meridian only the two end points stay (a meridian is a
great circle), then per narrow strip only the hull corners, then per event. That holds
below a quarter turn; wider events go by bounds between cells, which are made smaller
until the farthest pair is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.session import cut_lineage

# The detection feed gives five decimals, so a strip this wide holds at most a
# thousand distinct longitudes.
STRIP_DEG = 0.01
# Points whose box has sides of less than this together span less than a quarter turn.
HULL_DEG = 90.0
FIRST_CELL_DEG = 32.0
_POINT = "struct<u:double,v:double>"


def _projected(points: str) -> str:
    """Gnomonic image of {u, v} points around the first one, sorted by x.

    Great circles become straight lines, so corners on the sphere and in the
    plane are the same points. Valid while a set spans less than a quarter turn.
    """
    u0, v0 = f"radians({points}[0].u)", f"radians({points}[0].v)"
    du, v = f"(radians(p.u) - {u0})", "radians(p.v)"
    cos_c = f"(sin({v0}) * sin({v}) + cos({v0}) * cos({v}) * cos({du}))"
    x = f"cos({v}) * sin({du}) / {cos_c}"
    y = f"(cos({v0}) * sin({v}) - sin({v0}) * cos({v}) * cos({du})) / {cos_c}"
    return (
        f"array_sort(transform({points}, p ->"
        f" named_struct('x', {x}, 'y', {y}, 'u', p.u, 'v', p.v)))"
    )


def _chain(sorted_points: str, upper: bool) -> str:
    """One side of the hull: a new point drops the corners it overhangs."""
    drop = ">= 0D" if upper else "<= 0D"
    overhangs = (
        "array_position(zip_with(s, slice(s, 2, size(s) - 1), (a, b) ->"
        f" (b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x) {drop}), true)"
    )
    return (
        f"aggregate(slice({sorted_points}, 2, size({sorted_points}) - 1),"
        f" slice({sorted_points}, 1, 1),"
        f" (s, p) -> concat(slice(s, 1, coalesce(nullif(CAST({overhangs} AS INT), 0), size(s))),"
        " array(p)))"
    )


def _hull(df: DataFrame, column: str) -> DataFrame:
    """Replace an array of {u, v} points by its hull corners."""
    return (
        df.withColumn("_s", F.expr(f"CASE WHEN size({column}) > 3 THEN {_projected(column)} END"))
        .withColumn(
            column,
            F.expr(
                f"CASE WHEN _s IS NULL THEN {column} ELSE transform(array_union("
                f"{_chain('_s', True)}, {_chain('_s', False)}),"
                " p -> named_struct('u', p.u, 'v', p.v)) END"
            ),
        )
        .drop("_s")
    )


def _farthest(points: str) -> str:
    distance = g.haversine_sql("a.u", "a.v", "b.u", "b.v")
    return (
        f"CASE WHEN size({points}) < 2 THEN 0D ELSE array_max(transform({points}, a ->"
        f" array_max(transform({points}, b -> {distance})))) END"
    )


def _corners(
    detections: DataFrame, keys: list[str], lon: str, lat: str, axis_order: str
) -> DataFrame:
    """Hull corners per key as an array column ``corners`` of {u, v}."""
    u, v = (lon, lat) if axis_order == "lonlat" else (lat, lon)
    meridians = detections.groupBy(*keys, F.col(u).alias("u")).agg(
        F.min(v).alias("lo"), F.max(v).alias("hi")
    )
    box = [F.min("u0").alias("u0"), F.max("u1").alias("u1"), F.min("v0").alias("v0"), F.max("v1").alias("v1")]
    strips = (
        meridians.withColumn("strip", g.cell_index("u", STRIP_DEG))
        .selectExpr("*", "u AS u0", "u AS u1", "lo AS v0", "hi AS v1")
        .groupBy(*keys, "strip")
        .agg(F.collect_list(F.struct("u", "lo", "hi")).alias("m"), *box)
        .selectExpr(
            *keys, "u0", "u1", "v0", "v1",
            "flatten(transform(m, c -> IF(c.lo = c.hi, array(named_struct('u', c.u, 'v', c.lo)),"
            " array(named_struct('u', c.u, 'v', c.lo), named_struct('u', c.u, 'v', c.hi)))))"
            " AS corners",
        )
    )
    events = (
        _hull(strips, "corners")
        .groupBy(*keys)
        .agg(F.flatten(F.collect_list("corners")).alias("corners"), *box)
        .withColumn("corners", F.expr(f"IF({_wide('u0', 'u1', 'v0', 'v1')}, array(), corners)"))
    )
    return _hull(events, "corners")


def _wide(u0: str, u1: str, v0: str, v1: str) -> str:
    return f"coalesce({u1} - {u0} + {v1} - {v0} >= {HULL_DEG!r}D, false)"


def _cells(points: DataFrame, keys: list[str], step: float, side: str) -> DataFrame:
    """Per cell: one of its points and how many metres the others are away at most."""
    per_degree = g.EARTH_RADIUS_M * 3.141592653589793 / 180.0
    names = [f"{side}{c}" for c in ("i", "j")]
    return (
        points.selectExpr("*", f"{g.cell_sql('u', step)} AS {names[0]}", f"{g.cell_sql('v', step)} AS {names[1]}")
        .groupBy(*keys, *names)
        .agg(
            F.min(F.struct("u", "v")).alias(f"{side}p"),
            F.expr(f"(max(u) - min(u) + max(v) - min(v)) * {per_degree!r}D").alias(f"{side}r"),
        )
    )


def farthest_between(a: DataFrame, b: DataFrame, keys: list[str], node: list[str]) -> DataFrame:
    """keys + ``max_distance`` between the points ``a`` (keys, u, v) and ``b`` (node, u, v).

    ``node`` is some of ``keys``. Right anywhere on the sphere: cell pairs whose upper bound
    is below a distance known already go, the others are cut into cells of a quarter the
    side, until every cell left holds one position.
    """
    a, b = cut_lineage(a.distinct()), cut_lineage(b.distinct())
    step, pairs = FIRST_CELL_DEG, None
    while True:
        one, two = _cells(a, keys, step, "a"), _cells(b, node, step, "b")
        if pairs is None:
            met = one.join(two, node)
        else:
            parents = pairs.select(*keys, "ai", "aj", "bi", "bj").toDF(*keys, "ai0", "aj0", "bi0", "bj0")
            up = lambda side: [f"CAST(floor({side}{c} / 4D) AS BIGINT) AS {side}{c}0" for c in "ij"]
            met = (
                parents.join(one.selectExpr("*", *up("a")), [*keys, "ai0", "aj0"])
                .join(two.selectExpr("*", *up("b")), [*node, "bi0", "bj0"])
                .drop("ai0", "aj0", "bi0", "bj0")
            )
        judged = cut_lineage(met.withColumn("d", F.expr(g.haversine_sql("ap.u", "ap.v", "bp.u", "bp.v"))))
        known = judged.groupBy(*keys).agg(F.max("d").alias("known"))
        pairs = cut_lineage(judged.join(known, keys).filter("d + ar + br + 0.001D >= known"))
        if not pairs.filter("ar + br > 0D").limit(1).count():
            return pairs.groupBy(*keys).agg(F.max("d").alias("max_distance"))
        step /= 4.0


def event_extent(
    detections: DataFrame,
    keys: list[str],
    lon: str = "lon",
    lat: str = "lat",
    axis_order: str = "lonlat",
) -> DataFrame:
    """keys + ``max_distance``: metres between the two farthest detections, 0 if alone."""
    u, v = (lon, lat) if axis_order == "lonlat" else (lat, lon)
    found = cut_lineage(
        _corners(detections, keys, lon, lat, axis_order).selectExpr(
            *keys, f"{_farthest('corners')} AS max_distance", f"{_wide('u0', 'u1', 'v0', 'v1')} AS wide"
        )
    )
    narrow = found.filter("NOT wide").select(*keys, "max_distance")
    wide = found.filter("wide").select(*keys)
    if wide.limit(1).count() == 0:
        return narrow
    points = detections.join(wide, keys, "left_semi").selectExpr(*keys, f"{u} AS u", f"{v} AS v")
    return narrow.unionByName(farthest_between(points, points, keys, keys))
