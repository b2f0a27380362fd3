"""Nearest place for every position, exact, without pairing everything near.

Places are gathered on demand: only for grid cells that hold positions, and only those
that can be nearest to some spot of the cell, its *candidates*. With a cutoff its reach
says which; without one a pyramid of the cells that hold places does: the smallest
ancestor of a cell with a place in it bounds how far the nearest can be. A cell keeping
more candidates than a bound is split in four, and each part drops the places that are
farther than its own worst case, until the lists are short. A position then looks
through one short list.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import geometry as g
from emberscope.session import BROADCAST_MAX_ROWS, broadcast_if_small, cut_lineage

MAX_CANDIDATES = 64
MAX_SPLITS = 14
CANDIDATE = ("base", "ix", "iy", "plon", "plat", "name")
# Cells without a cutoff: the finest in degrees, and how often it is doubled. Four of the
# largest hold every longitude and latitude.
FINEST_DEG = 0.5
DOUBLINGS = 10


def _box_distance(unit: str, nearest: bool) -> str:
    """Distance from a place (plon, plat) to the closest / farthest spot of a cell box.

    In metres a bound is enough: meridians have the same scale everywhere and
    parallels shrink with the cosine, so the smallest (largest) cosine of the
    latitudes involved bounds the distance from below (above).
    """
    if nearest:
        dx = "greatest(x0 - plon, plon - x1, 0D)"
        dy = "greatest(y0 - plat, plat - y1, 0D)"
    else:
        dx = "greatest(plon - x0, x1 - plon)"
        dy = "greatest(plat - y0, y1 - plat)"
    if unit == "degrees":
        return f"sqrt({dx} * {dx} + {dy} * {dy})"
    per_degree = f"{math.radians(1.0) * g.EARTH_RADIUS_M!r}D"
    if nearest:
        # Below: the larger of the north-south part and the east-west part along
        # the parallel nearest a pole (the chord 2 asin(cos * sin(dx / 2))).
        cos = (
            "least(cos(radians(least(90D, abs(plat)))), cos(radians(least(90D, greatest(abs(y0), abs(y1))))))"
        )
        across = (
            f"2D * {g.EARTH_RADIUS_M!r}D * asin(least(1D, {cos} * sin(radians(least({dx}, 180D)) / 2D)))"
        )
        return f"greatest({dy} * {per_degree}, {across})"
    # Above: walk north-south, then along the parallel.
    return f"({dy} * {per_degree} + {dx} * {per_degree} * cos(radians(plat)))"


def _size(cell: float, depth: int) -> str:
    """Side of a cell: its base tells how often ``cell`` was doubled, its depth how often halved."""
    return f"({float(cell)!r}D * pow(2D, base - {depth}))"


def _cells(seats: DataFrame, cell: float, depth: int) -> DataFrame:
    """Every seat (lon, lat, base) with its cell ix, iy."""
    size = _size(cell, depth)
    return seats.selectExpr(
        "*", f"CAST(floor(lon / {size}) AS BIGINT) AS ix", f"CAST(floor(lat / {size}) AS BIGINT) AS iy"
    )


def _split(candidates: DataFrame, seats: DataFrame, cell: float, depth: int) -> DataFrame:
    """Candidates of the four parts of each cell that hold seats."""
    parts = _cells(seats, cell, depth).select("base", "ix", "iy").distinct()
    parts = parts.selectExpr("base", "ix AS cx", "iy AS cy", "shiftright(ix, 1) AS ix", "shiftright(iy, 1) AS iy")
    return candidates.join(parts, ["base", "ix", "iy"]).selectExpr(
        "base", "cx AS ix", "cy AS iy", "plon", "plat", "name"
    )


def _prune(candidates: DataFrame, cell: float, depth: int, unit: str, limit: float | None) -> DataFrame:
    """Drop places that some other candidate beats everywhere in the cell."""
    s = _size(cell, depth)
    boxed = candidates.selectExpr(
        "*", f"ix * {s} AS x0", f"iy * {s} AS y0", f"(ix + 1) * {s} AS x1", f"(iy + 1) * {s} AS y1"
    ).selectExpr(
        *CANDIDATE, f"{_box_distance(unit, True)} AS at_least", f"{_box_distance(unit, False)} AS at_most"
    )
    bound = boxed.groupBy("base", "ix", "iy").agg(F.min("at_most").alias("bound"))
    slack = "(1D + 1e-9D)"
    kept = boxed.join(bound, ["base", "ix", "iy"]).filter(f"at_least <= bound * {slack} + 1e-12D")
    if limit is not None:
        kept = kept.filter(f"at_least <= {float(limit)!r}D * {slack}")
    return kept.select(*CANDIDATE)


def _start_cell(limit: float, unit: str) -> float:
    return limit if unit == "degrees" else limit / g.METRES_PER_DEGREE


def _around(places: DataFrame, cell: float, limit: float, unit: str) -> DataFrame:
    """Every place under each cell that has a spot within ``limit`` of it."""
    d_lat = limit if unit == "degrees" else limit / (math.radians(1.0) * g.EARTH_RADIUS_M)
    if unit == "degrees":
        d_lon = f"{d_lat!r}D"
    else:
        # Half-width of a circle of that radius at the place's latitude.
        reach = f"sin({limit / g.EARTH_RADIUS_M!r}D) / cos(radians(plat))"
        d_lon = (
            f"IF(abs(plat) + {d_lat!r}D >= 90D OR {reach} >= 1D, 180D,"
            f" degrees(asin(least(1D, {reach}))) * (1D + 1e-9D) + 1e-9D)"
        )
        # A circle reaching over the date line is listed on both sides of it.
        places = places.selectExpr(
            "name",
            "plat",
            f"explode(filter(array(plon, IF(plon - {d_lon} < -180D, plon + 360D, NULL),"
            f" IF(plon + {d_lon} > 180D, plon - 360D, NULL)), l -> l IS NOT NULL)) AS plon",
        )
    sx = f"sequence({g.cell_sql(f'plon - {d_lon}', cell)}, {g.cell_sql(f'plon + {d_lon}', cell)})"
    sy = f"sequence({g.cell_sql(f'plat - {d_lat!r}D', cell)}, {g.cell_sql(f'plat + {d_lat!r}D', cell)})"
    return places.selectExpr("*", f"explode({sx}) AS ix").selectExpr("*", f"explode({sy}) AS iy")


def _spots(places: DataFrame) -> DataFrame:
    """One place per position; the lowest name wins ties."""
    return places.groupBy(F.col("lon").alias("plon"), F.col("lat").alias("plat")).agg(F.min("name").alias("name"))


def _settle(
    seats: DataFrame, candidates: DataFrame, cell: float, unit: str, limit: float | None, max_candidates: int
) -> DataFrame:
    """Seats with the best of the candidates of their cell, once all lists are short."""
    lists, listed = [], 0
    for depth in range(MAX_SPLITS + 1):
        counted = candidates.groupBy("base", "ix", "iy").agg(F.count("*").alias("n"))
        full = F.col("n") > max_candidates
        short, longest = counted.agg(F.sum(F.when(~full, F.col("n"))), F.max("n")).first()
        last = depth == MAX_SPLITS or (longest or 0) <= max_candidates
        listed += (short or 0) if not last or (longest or 0) <= max_candidates else BROADCAST_MAX_ROWS + 1
        here = candidates
        if not last:
            crowded = cut_lineage(counted.filter(full).select("base", "ix", "iy"))
            here = candidates.join(crowded, ["base", "ix", "iy"], "left_anti")
        lists.append(
            here.groupBy("base", "ix", "iy")
            .agg(F.collect_list(F.struct("plon", "plat", "name")).alias("near"))
            .withColumn("depth", F.lit(depth))
        )
        if last:
            break
        rest = candidates.join(crowded, ["base", "ix", "iy"], "left_semi")
        parts = _split(rest, seats, cell, depth + 1)
        candidates = cut_lineage(_prune(parts, cell, depth + 1, unit, limit))

    table = lists[0]
    for more in lists[1:]:
        table = table.unionByName(more)
    # Lists differ in length, so the bound counts their places.
    table = F.broadcast(table) if listed <= BROADCAST_MAX_ROWS else table
    keys = ", ".join(
        f"named_struct('depth', {k}, 'ix', CAST(floor(lon / {_size(cell, k)}) AS BIGINT),"
        f" 'iy', CAST(floor(lat / {_size(cell, k)}) AS BIGINT))"
        for k in range(len(lists))
    )
    distance = g.distance_sql("lon", "lat", "c.plon", "c.plat", unit)
    best = f"array_min(transform(near, c -> named_struct('d', {distance}, 'name', c.name))) AS best"
    # A seat is under one list, or none.
    keyed = seats.selectExpr("lon", "lat", "base", f"explode(array({keys})) AS k").select("lon", "lat", "base", "k.*")
    return keyed.join(table, ["base", "depth", "ix", "iy"]).selectExpr("lon", "lat", best)


def nearest_within(
    positions: DataFrame,
    places: DataFrame,
    limit: float,
    unit: str = "metres",
    max_candidates: int = MAX_CANDIDATES,
) -> DataFrame:
    """``positions`` (distinct lon, lat) + settlement_name, settlement_distance.

    Left-preserving: no place within ``limit`` gives nulls. Equal distances go to
    the lowest name.
    """
    cell = _start_cell(limit, unit)
    positions = cut_lineage(positions)
    seats = positions.selectExpr("lon", "lat", "0 AS base")
    wanted = cut_lineage(_cells(seats, cell, 0).select("ix", "iy").distinct())
    reached = _around(_spots(places), cell, limit, unit).join(broadcast_if_small(wanted), ["ix", "iy"], "left_semi")
    candidates = cut_lineage(reached.selectExpr("0 AS base", *CANDIDATE[1:]))
    best = _settle(seats, candidates, cell, unit, limit, max_candidates)
    return _named(positions, best, f"best.d <= {float(limit)!r}D")


def _named(positions: DataFrame, best: DataFrame, ok: str) -> DataFrame:
    return positions.join(best, ["lon", "lat"], "left").selectExpr(
        *positions.columns,
        f"IF({ok}, best.name, NULL) AS settlement_name",
        f"IF({ok}, best.d, NULL) AS settlement_distance",
    )


def nearest_any(positions: DataFrame, places: DataFrame, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """Nearest place in planar degrees with no cutoff, in one search for all positions.

    A cell searches from its smallest ancestor that holds a place: that place is within the
    ancestor's diagonal of every position, so the nearest is at most two such cells away.
    """
    positions = cut_lineage(positions)
    spots = cut_lineage(_spots(places))
    levels = f"explode(sequence(0, {DOUBLINGS})) AS base"

    def level_cells(lon: str, lat: str) -> list[str]:
        return [f"{g.cell_sql(lon, FINEST_DEG)} AS cx", f"{g.cell_sql(lat, FINEST_DEG)} AS cy"]

    above = ["shiftright(cx, base) AS ix", "shiftright(cy, base) AS iy"]
    held = spots.selectExpr(*level_cells("plon", "plat")).distinct().selectExpr("*", levels)
    held = held.selectExpr("base", *above).distinct()
    # At most one row per cell of the finest grid.
    cells = cut_lineage(positions.selectExpr(*level_cells("lon", "lat")).distinct())
    bases = (
        cells.selectExpr("*", levels).selectExpr("*", *above)
        .join(held, ["base", "ix", "iy"], "left_semi")
        .groupBy("cx", "cy").agg(F.min("base").alias("base"))
    )
    based = cut_lineage(
        cells.join(bases, ["cx", "cy"], "left").withColumn("base", F.coalesce("base", F.lit(DOUBLINGS)))
    )
    seats = cut_lineage(
        positions.selectExpr("lon", "lat", *level_cells("lon", "lat"))
        .join(broadcast_if_small(based), ["cx", "cy"])
        .select("lon", "lat", "base")
    )
    around = (
        based.selectExpr("base", *above).distinct()
        .selectExpr("*", "explode(sequence(ix - 2, ix + 2)) AS nx")
        .selectExpr("*", "explode(sequence(iy - 2, iy + 2)) AS ny")
    )
    placed = spots.selectExpr("*", *level_cells("plon", "plat"), levels).selectExpr(
        "plon", "plat", "name", "base", "shiftright(cx, base) AS nx", "shiftright(cy, base) AS ny"
    )
    reached = placed.join(broadcast_if_small(around), ["base", "nx", "ny"]).select(*CANDIDATE)
    candidates = cut_lineage(_prune(reached, FINEST_DEG, 0, "degrees", None))
    best = _settle(seats, candidates, FINEST_DEG, "degrees", None, max_candidates)
    return _named(positions, best, "best.d IS NOT NULL")


def nearest_settlement(
    source: DataFrame,
    places: DataFrame,
    max_distance_m: float | None = 10_000.0,
) -> DataFrame:
    """Add settlement_name and settlement_distance to rows with lon, lat.

    With a cutoff distances are metres. ``max_distance_m=None`` is the literal
    form of the original: planar degrees and no effective cutoff.
    """
    positions = source.select("lon", "lat").distinct()
    if max_distance_m is None:
        named = nearest_any(positions, places)
    else:
        named = nearest_within(positions, places, max_distance_m)
    return source.join(named, ["lon", "lat"], "left")
