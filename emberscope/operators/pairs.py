"""Other readings of the event extent: pairs up to a cutoff, pairs across areas."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.operators.extent import _corners, _farthest, _wide, event_extent
from emberscope.session import broadcast_if_small, cut_lineage, scratch_path

# Cells per cutoff: a cell is small against the cutoff, so its points are few and
# most cell pairs are decided by their boxes alone.
CELLS_PER_CUTOFF = 8
# Events up to this many distinct positions are looked at directly.
FEW_POINTS = 64


def _box_gap_m(nearest: bool) -> str:
    """Bounds on the metres between two cells' point boxes (a_*, b_*)."""
    per_degree = math.radians(1.0) * g.EARTH_RADIUS_M
    if nearest:
        dx = "greatest(a_x0 - b_x1, b_x0 - a_x1, 0D)"
        dy = "greatest(a_y0 - b_y1, b_y0 - a_y1, 0D)"
        cos = "cos(radians(least(90D, greatest(abs(a_y0), abs(a_y1), abs(b_y0), abs(b_y1)))))"
        across = f"{2.0 * g.EARTH_RADIUS_M!r}D * asin(least(1D, {cos} * sin(radians({dx}) / 2D)))"
        return f"greatest({dy} * {per_degree!r}D, {across})"
    dx = "greatest(a_x1 - b_x0, b_x1 - a_x0)"
    dy = "greatest(a_y1 - b_y0, b_y1 - a_y0)"
    low = "least(abs(a_y0), abs(a_y1), abs(b_y0), abs(b_y1))"
    cos = f"IF(least(a_y0, b_y0) <= 0D AND greatest(a_y1, b_y1) >= 0D, 1D, cos(radians({low})))"
    return f"({dy} * {per_degree!r}D + {dx} * {per_degree!r}D * {cos})"


def extent_within(
    detections: DataFrame,
    keys: list[str],
    cutoff_m: float,
    lon: str = "lon",
    lat: str = "lat",
    axis_order: str = "lonlat",
) -> DataFrame:
    """Largest distance among pairs of one event that are at most ``cutoff_m`` apart.

    An event narrower than the cutoff is settled by its hull, one with few distinct
    positions by looking at them directly. The others are cut into small cells;
    cell pairs are ruled in or out by their boxes, and only pairs that may still
    raise the event's best known distance look at points. Cells follow the place on
    the sphere, so poles, the date line and swapped axes lose no pair.
    """
    if cutoff_m >= math.pi * g.EARTH_RADIUS_M:
        return event_extent(detections, keys, lon, lat, axis_order)
    if axis_order == "latlon":
        lon, lat = lat, lon
    limit = f"{float(cutoff_m)!r}D"
    points = cut_lineage(
        detections.selectExpr(*keys, f"{lon} AS lon", f"{lat} AS lat").distinct()
    )
    whole = (
        _corners(points, keys, "lon", "lat", "lonlat")
        .selectExpr(*keys, f"IF({_wide('u0', 'u1', 'v0', 'v1')}, double('Infinity'), {_farthest('corners')}) AS diameter")
        .join(points.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    )
    whole = cut_lineage(whole)
    narrow = whole.filter(f"diameter <= {limit}").selectExpr(*keys, "diameter AS max_distance")
    wide = whole.filter(f"diameter > {limit}")
    few = (
        points.join(wide.filter(f"n <= {FEW_POINTS}").select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("lon", "lat")).alias("pts"))
        .selectExpr(*keys, f"{_best('pts', 'pts', limit)} AS max_distance")
    )
    many = wide.filter(f"n > {FEW_POINTS}").select(*keys)
    settled = narrow.unionByName(few)
    if many.limit(1).count() == 0:
        return settled
    return settled.unionByName(_extent_by_cells(points, many, keys, cutoff_m))


def _place_y(v: str) -> str:
    """The latitude on the sphere of an angle that may pass the pole."""
    return f"IF(abs({v}) <= 90D, {v}, degrees(asin(sin(radians({v})))))"


def _place_x(u: str, v: str) -> str:
    """The longitude in [-180, 180) that belongs to ``_place_y``."""
    return f"pmod({u} + IF(cos(radians({v})) < 0D, 180D, 0D) + 180D, 360D) - 180D"


def _row_width(row: str, step: float) -> str:
    return f"greatest(0D, cos(radians(abs(({row} + 0.5D) * {step!r}D))))"


def _best(a: str, b: str, limit: str) -> str:
    """Largest distance up to the limit between two arrays of positions."""
    distance = g.haversine_sql("a.lon", "a.lat", "b.lon", "b.lat")
    return (
        f"array_max(transform({a}, a -> array_max(filter(transform({b}, b -> {distance}),"
        f" d -> d <= {limit}))))"
    )


def _extent_by_cells(
    points: DataFrame, events: DataFrame, keys: list[str], cutoff_m: float
) -> DataFrame:
    limit = f"{float(cutoff_m)!r}D"
    step = cutoff_m / CELLS_PER_CUTOFF / (math.radians(1.0) * g.EARTH_RADIUS_M)
    cells = cut_lineage(
        points.join(events, keys, "left_semi")
        .selectExpr("*", f"{_place_y('lat')} AS y", f"{_place_x('lon', 'lat')} AS x")
        .selectExpr("*", f"{g.cell_sql('y', step)} AS iy")
        # Columns are as wide in metres as rows are high, row by row.
        .selectExpr("*", f"CAST(floor(x * {_row_width('iy', step)} / {step!r}D) AS BIGINT) AS ix")
        .groupBy(*keys, "ix", "iy")
        .agg(
            F.collect_list(F.struct("lon", "lat")).alias("pts"),
            F.min("x").alias("x0"),
            F.max("x").alias("x1"),
            F.min("y").alias("y0"),
            F.max("y").alias("y1"),
        )
    )
    boxes = cells.select(*keys, "ix", "iy", "x0", "x1", "y0", "y1")
    side_a = boxes.withColumnsRenamed({c: f"a_{c}" for c in ("ix", "iy", "x0", "x1", "y0", "y1")})
    side_b = boxes.withColumnsRenamed({c: f"b_{c}" for c in ("ix", "iy", "x0", "x1", "y0", "y1")})
    reach = CELLS_PER_CUTOFF + 1
    # Every row is scaled on its own, so the partner columns are found from the
    # longitudes a circle of the cutoff can reach, row by row; all of them at a pole.
    highest = f"(abs(a_y0) + {(reach + 1) * step!r}D)"
    half = (
        f"IF({highest} >= 90D, 180D, degrees(2D * asin(least(1D, sin({cutoff_m / g.EARTH_RADIUS_M / 2.0!r}D) /"
        f" cos(radians(least({highest}, 89.999999D)))))))"
    )
    column = lambda x: f"CAST(floor({x} * {_row_width('b_iy', step)} / {step!r}D) AS BIGINT)"
    lookups = (
        side_a.selectExpr("*", f"{half} AS half", "explode(array(-360D, 0D, 360D)) AS turn")
        .withColumn("a_x0", F.expr("a_x0 + turn"))
        .withColumn("a_x1", F.expr("a_x1 + turn"))
        .filter("a_x0 - half <= 180D AND a_x1 + half >= -180D")
        .selectExpr("*", f"explode(sequence(a_iy, a_iy + {reach})) AS b_iy")
        .selectExpr(
            "*",
            f"explode(sequence({column('greatest(-180D, a_x0 - half)')}, {column('least(180D, a_x1 + half)')})) AS b_ix",
        )
    )
    cell_pairs = (
        lookups.join(side_b, [*keys, "b_ix", "b_iy"])
        .filter("b_iy > a_iy OR b_ix >= a_ix")
        .selectExpr(
            *keys, "a_ix", "a_iy", "b_ix", "b_iy",
            f"{_box_gap_m(True)} AS at_least",
            f"{_box_gap_m(False)} AS at_most",
            "greatest(a_x1 - b_x0, b_x1 - a_x0) <= 180D AS plain",
        )
        .filter(f"at_least <= {limit} * (1D + 1e-9D)")
    )
    floor_known = cell_pairs.groupBy(*keys).agg(
        F.expr(f"max(at_least) FILTER (WHERE plain AND at_most <= {limit})").alias("known")
    )
    hopeful = (
        cell_pairs.join(floor_known, keys)
        .filter("at_most * (1D + 1e-9D) >= coalesce(known, 0D)")
        .select(*keys, "a_ix", "a_iy", "b_ix", "b_iy")
    )
    pts_a = cells.selectExpr(*keys, "ix AS a_ix", "iy AS a_iy", "pts AS a_pts")
    pts_b = cells.selectExpr(*keys, "ix AS b_ix", "iy AS b_iy", "pts AS b_pts")
    return (
        hopeful.join(pts_a, [*keys, "a_ix", "a_iy"])
        .join(pts_b, [*keys, "b_ix", "b_iy"])
        .selectExpr(*keys, f"{_best('a_pts', 'b_pts', limit)} AS d")
        .groupBy(*keys)
        .agg(F.max("d").alias("max_distance"))
    )


# Side of the first cells, and how many distances per pair of cells are few enough to be
# taken one by one; cells below the smallest side hold one position of the feed.
FIRST_STEP, FEW_DISTANCES, MOST_DISTANCES, SMALLEST_STEP = 16.0, 8, 4096, 1e-6
# Metres a computed distance may be off: close to the antipode the formula loses half its digits.
SLACK_M = 1.0


def _centred(points: DataFrame, keys: list[str], step: float, side: str, *more) -> DataFrame:
    """Per cell of ``step``: the centre of its points' box and how many metres they are off it at most."""
    per_degree = math.radians(1.0) * g.EARTH_RADIUS_M
    i, j, x, y, r, n = (f"{side}{c}" for c in ("i", "j", "x", "y", "r", "n"))
    boxes = (
        points.selectExpr("*", f"{g.cell_sql('x', step)} AS {i}", f"{g.cell_sql('y', step)} AS {j}")
        .groupBy(*keys, i, j)
        .agg(
            *(F.expr(f"{f}({c}) AS {f}_{c}") for f in ("min", "max") for c in ("x", "y")),
            F.count("*").alias(n),
            *more,
        )
    )
    wide = "(max_x - min_x) * cos(radians(greatest(min_y, -max_y, 0D)))"
    return boxes.selectExpr(
        "*",
        f"(min_x + max_x) / 2D AS {x}",
        f"(min_y + max_y) / 2D AS {y}",
        f"sqrt(pow({wide}, 2) + pow(max_y - min_y, 2)) * {per_degree / 2.0!r}D AS {r}",
    ).drop("min_x", "max_x", "min_y", "max_y")


def _cell_pairs(a: DataFrame, b: DataFrame) -> tuple[DataFrame, float]:
    """Per cell of ``a`` the cells of ``b`` that hold its positions' farthest partners; the side of the cells.

    ``best`` is a position of ``b`` that is at least ``d`` metres from every one in the cell,
    with a larger id than all of them. A part of the cell begins with it, so most partners
    go before they meet the others.
    """
    block, step, blocks = ["event_no", "bucket", "ai", "aj"], FIRST_STEP, None
    spark = a.sparkSession
    while True:
        one = _centred(a, ["event_no", "bucket"], step, "a", F.min("id").alias("lo"), F.max("id").alias("hi"))
        two = _centred(
            b, ["event_no"], step, "b", F.max("id").alias("top"), F.expr("max_by(struct(x, y), id) AS last")
        )
        if blocks is None:
            nothing = F.expr("named_struct('d', 0D, 'x', 0D, 'y', 0D, 'id', 0L) AS best")
            met = one.select("*", nothing).join(broadcast_if_small(two), "event_no")
        else:
            up = lambda side: [f"CAST(floor({side}{c} / 2D) AS BIGINT) AS {side}{c}0" for c in "ij"]
            parents = blocks.withColumnsRenamed({"ai": "ai0", "aj": "aj0"})
            kept = parents.selectExpr("event_no", "inline(others)").select("event_no", "bi", "bj").distinct()
            # Far corners are the partners of almost all cells: then few cells are left here.
            two = cut_lineage(
                two.selectExpr("*", *up("b")).join(
                    kept.withColumnsRenamed({"bi": "bi0", "bj": "bj0"}), ["event_no", "bi0", "bj0"], "left_semi"
                )
            )
            still = f"IF(best.id > hi, {g.haversine_sql('ax', 'ay', 'best.x', 'best.y')} - ar, 0D)"
            met = (
                parents.join(one.selectExpr("*", *up("a")), ["event_no", "bucket", "ai0", "aj0"])
                .withColumn("best", F.expr(f"named_struct('d', greatest(0D, {still}), 'x', best.x, 'y', best.y, 'id', best.id)"))
                .selectExpr(
                    *block, "ax", "ay", "ar", "an", "lo", "hi", "best",
                    "inline(transform(filter(others, o -> o.at_most >= best.d), o -> struct(o.bi AS bi0, o.bj AS bj0)))",
                )
                .join(broadcast_if_small(two), ["event_no", "bi0", "bj0"])
            )
        blocks = (
            met.filter("top > lo")
            .selectExpr(
                *block, "bi", "bj", "an * bn AS work", "best",
                f"{g.haversine_sql('ax', 'ay', 'bx', 'by')} + ar + br + {SLACK_M!r}D AS at_most",
                f"named_struct('d', IF(top > hi, {g.haversine_sql('ax', 'ay', 'last.x', 'last.y')} - ar, 0D),"
                " 'x', last.x, 'y', last.y, 'id', top) AS last",
            )
            .filter("at_most >= best.d")
            .groupBy(*block)
            .agg(
                F.collect_list(F.struct("bi", "bj", "work", "at_most")).alias("others"),
                F.max(F.greatest("best", "last")).alias("best"),
            )
            .withColumn("others", F.expr("filter(others, o -> o.at_most >= best.d)"))
        )
        path = scratch_path(spark, "cell-pairs")
        blocks.write.parquet(path)
        blocks = spark.read.parquet(path)
        n, total, most = blocks.selectExpr("inline(others)").agg(F.count("*"), F.sum("work"), F.max("work")).first()
        if not n or (total <= FEW_DISTANCES * n and most <= MOST_DISTANCES) or step <= SMALLEST_STEP:
            return blocks, step
        step /= 2.0


def extent_across_areas(
    detections: DataFrame,
    id_col: str = "firms_id",
    lon: str = "lon",
    lat: str = "lat",
    axis_order: str = "lonlat",
) -> DataFrame:
    """Per (area, event_no): farthest pair a, b with a in the area, b in any area's
    event of the same number, and a's id below b's.

    Two positions make a pair if the smallest id at the first is below the largest at the
    second, so a detection enters once on each side. Both sides are cut into cells, and pairs
    of cells whose distance is at most so large that every position of the first has a
    farther partner go; the others are halved until few positions are left in them. First
    cells are kept apart by how far their ids are from the largest, so that most of a cell's
    positions have the same partners. Cells follow the place on the sphere.
    """
    u, v = (lon, lat) if axis_order == "lonlat" else (lat, lon)
    # What is no number has no distance, like null.
    rows = cut_lineage(
        detections.selectExpr(
            "area_id", "event_no", f"{id_col} AS id",
            f"nanvl(CAST({u} AS DOUBLE), NULL) AS u", f"nanvl(CAST({v} AS DOUBLE), NULL) AS v",
        )
    )
    tops = broadcast_if_small(rows.groupBy("event_no").agg(F.max("id").alias("event_top")))
    paired = (
        rows.groupBy("area_id", "event_no").agg(F.min("id").alias("id")).join(tops, "event_no").filter("id < event_top")
    )
    place = [f"{_place_x('u', 'v')} AS x", f"{_place_y('v')} AS y"]
    placed = rows.filter("u IS NOT NULL AND v IS NOT NULL")
    a = (
        placed.groupBy("area_id", "event_no", "u", "v")
        .agg(F.min("id").alias("id"))
        .join(tops, "event_no")
        .filter("id < event_top")
        .selectExpr(
            "area_id", "event_no", "u", "v", "id",
            "CAST(log2(1D + (CAST(event_top AS DOUBLE) - CAST(id AS DOUBLE))) AS INT) AS bucket", *place,
        )
    )
    b = placed.groupBy("event_no", "u", "v").agg(F.max("id").alias("id")).selectExpr("*", *place)
    # Neighbours lie together, so cells are made mostly within a task.
    near = [F.floor("x"), F.floor("y")]
    a, b = cut_lineage(a.repartition(*near)), cut_lineage(b.repartition(*near))
    blocks, step = _cell_pairs(a, b)
    cells = lambda side: [f"{g.cell_sql(p, step)} AS {side}{c}" for p, c in (("x", "i"), ("y", "j"))]
    kept = blocks.selectExpr("event_no", "inline(others)").select("event_no", "bi", "bj").distinct()
    partners = cut_lineage(
        b.selectExpr("event_no", "u AS bu", "v AS bv", "id AS b_id", *cells("b"))
        .join(kept, ["event_no", "bi", "bj"], "left_semi")
    )
    still = f"IF(best.id > id, {g.haversine_sql('x', 'y', 'best.x', 'best.y')}, 0D)"
    found = (
        blocks.join(a.selectExpr("*", *cells("a")), ["event_no", "bucket", "ai", "aj"])
        .withColumn("still", F.expr(still))
        .selectExpr(
            "area_id", "event_no", "u", "v", "id",
            "inline(transform(filter(others, o -> o.at_most >= still), o -> struct(o.bi, o.bj)))",
        )
        .join(broadcast_if_small(partners), ["event_no", "bi", "bj"])
        .filter("id < b_id")
        .groupBy("area_id", "event_no")
        .agg(F.expr(f"max({g.haversine_sql('u', 'v', 'bu', 'bv')})").alias("max_distance"))
    )
    same = F.expr("p.event_no = f.event_no AND p.area_id <=> f.area_id")
    return paired.alias("p").join(found.alias("f"), same, "left").select("p.area_id", "p.event_no", "f.max_distance")
