"""Point-in-polygon, covers and distances against direct computation."""

import math
import random

import pytest

from emberscope.functions import geometry as g
from emberscope.operators import spatial

POLYGON = "id string, rings array<array<struct<x:double,y:double>>>"


def polygons(spark, shapes):
    rows = [(name, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for name, rings in shapes]
    return g.with_bounds(spark.createDataFrame(rows, POLYGON))


def points(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rows)], "pid int, lon double, lat double")


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]


@pytest.mark.parametrize("small_edges", [64, 1])
@pytest.mark.parametrize("cell", [0.3, 1.0, 10.0])
def test_boundary_vertex_and_hole(spark, small_edges, cell):
    cover = spatial.polygon_cover(
        polygons(spark, [("s", [SQUARE, HOLE])]), ["id"], cell, small_edges
    )
    rows = [
        (0, 2), (4, 4), (0, 0), (2, 4),  # edge and vertices of the shell
        (1, 2), (3, 3), (2, 1),  # edge and vertex of the hole
        (2, 2), (1.5, 2.9),  # inside the hole
        (0.5, 0.5), (3.5, 2), (2, 0.25),  # inside
        (-0.1, 2), (4.1, 4), (5, 5), (2, 4.0001),  # outside
    ]
    hit = {r.pid for r in spatial.points_in_polygons(points(spark, rows), cover).collect()}
    assert hit == {0, 1, 2, 3, 4, 5, 6, 9, 10, 11}


def _inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def _star(rng, cx, cy, n, r):
    ring = []
    for k in range(n):
        a, d = 2 * math.pi * k / n, r * (0.3 + 0.7 * rng.random())
        ring.append((cx + d * math.cos(a), cy + d * math.sin(a)))
    return [*ring, ring[0]]


def test_cut_up_polygons_equal_direct_test(spark):
    rng = random.Random(7)
    stars = [(f"s{k}", [_star(rng, rng.uniform(-3, 3), rng.uniform(-3, 3), 150, 2.5)]) for k in range(4)]
    rows = [(round(rng.uniform(-6, 6), 5), round(rng.uniform(-6, 6), 5)) for _ in range(3000)]
    # A third of the points in one cell.
    rows += [(round(rng.uniform(0.01, 0.2), 5), round(rng.uniform(0.01, 0.2), 5)) for _ in range(1500)]
    want = {(i, name) for i, (x, y) in enumerate(rows) for name, (ring,) in stars if _inside(x, y, ring)}
    for small_edges in (1000, 10):
        cover = spatial.polygon_cover(polygons(spark, stars), ["id"], 0.25, small_edges)
        got = {(r.pid, r.id) for r in spatial.points_in_polygons(points(spark, rows), cover).collect()}
        assert got == want


def test_equal_polygons_keep_their_copies(spark):
    twice = polygons(spark, [("same", [SQUARE]), ("same", [SQUARE])])
    for small_edges in (64, 1):
        cover = spatial.polygon_cover(twice, ["id"], 1.0, small_edges)
        assert spatial.points_in_polygons(points(spark, [(0.5, 0.5)]), cover).count() == 2


def test_shuffled_join_equals_broadcast(spark):
    cover = spatial.polygon_cover(polygons(spark, [("s", [SQUARE, HOLE])]), ["id"], 0.5)
    rows = [(x / 7, y / 7) for x in range(-3, 32) for y in range(-3, 32)]
    wide = {r.pid for r in spatial.points_in_polygons(points(spark, rows), cover).collect()}
    cover._fits = False
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.pid for r in spatial.points_in_polygons(points(spark, rows), cover).collect()} == wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_exclusion_modes(spark):
    left = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    right = [(1, 0), (3, 0), (3, 2), (1, 2), (1, 0)]
    shapes = polygons(spark, [("l", [left]), ("r", [right])])
    cover = spatial.polygon_cover(shapes, ["id"], 1.0)
    pts = points(spark, [(0.5, 1), (1.5, 1), (2.5, 1), (9, 9)])
    assert {r.pid for r in spatial.outside_polygons(pts, cover).collect()} == {3}
    both = spatial.touching_every_polygon(pts, shapes, cover, "pid")
    assert {r.pid for r in both.collect()} == {1}
    none = shapes.filter("id = 'x'")
    empty = spatial.polygon_cover(none, ["id"], 1.0)
    assert spatial.outside_polygons(pts, empty).count() == 4
    assert spatial.touching_every_polygon(pts, none, empty, "pid").count() == 4


def test_clip_keeps_inner_borders_only(spark):
    left = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    right = [(2, 0), (4, 0), (4, 2), (2, 2), (2, 0)]
    shapes = polygons(spark, [("l", [left]), ("r", [right])])
    pts = points(spark, [(2, 1), (0, 1), (4, 2), (1, 1), (3, 0), (2, 2), (5, 1)])
    got = {r.pid for r in spatial.clip_to_union(pts, shapes, 0.7).collect()}
    assert got == {0, 3}


def test_union_keeps_borders_with_corners_of_one_side(spark):
    shapes = {
        "long": [(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)],
        "left": [(0, 1), (1, 1), (1, 2), (0, 2), (0, 1)],
        "right": [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)],
        "aside": [(2, 0.5), (3, 0.5), (3, 1.5), (2, 1.5), (2, 0.5)],
        # A slope cut at its middle by two neighbours.
        "slope": [(0, 2), (2, 2), (0, 4), (0, 2)],
        "upper": [(2, 2), (2, 4), (1, 3), (2, 2)],
        "lower": [(1, 3), (2, 4), (0, 4), (1, 3)],
    }
    rows = polygons(spark, [(k, [ring]) for k, ring in shapes.items()])
    kept = [(0.5, 1), (1, 1), (1, 1.5), (1.5, 1), (1, 2), (2, 0.75), (2, 1.25), (1.5, 2.5), (1, 3), (0.5, 3.5), (1, 2.5), (1.5, 3.5)]
    dropped = [(2, 0.5), (2, 0.25), (2, 1.5), (2, 1.75), (0, 1), (1, 0), (3, 1), (0, 2), (2, 3), (2, 4), (0, 3), (1, 4), (2, 2), (5, 5)]
    pts = points(spark, kept + dropped)
    for cell in (0.3, 0.7, 10.0):
        got = {r.pid for r in spatial.clip_to_union(pts, rows, cell).collect()}
        assert got == set(range(len(kept)))


def test_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (10.0, 50.0, 11.0, 50.5)], "a double, b double, c double, d double")
    rows = df.selectExpr(
        f"{g.haversine_sql('a', 'b', 'c', 'd')} AS m",
        f"{g.haversine_sql('a', 'b', 'c', 'd', 'latlon')} AS swapped",
        f"{g.planar_distance_sql('a', 'b', 'c', 'd')} AS deg",
    ).collect()

    def hav(lon1, lat1, lon2, lat2):
        p1, p2 = math.radians(lat1), math.radians(lat2)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(a))

    assert rows[0].m == pytest.approx(hav(0, 0, 0, 1))
    assert rows[1].m == pytest.approx(hav(10, 50, 11, 50.5))
    assert rows[1].swapped == pytest.approx(hav(50, 10, 50.5, 11))
    assert rows[1].deg == pytest.approx(math.hypot(1, 0.5))


def test_small_polygons_are_cut_up_in_their_row(spark, monkeypatch):
    """The same cover as by shuffles, and no shuffle for it."""
    from emberscope.operators import spatial

    rng = random.Random(9)
    rows = []
    for i in range(40):
        n, cx, cy, r = rng.randrange(4, 9), rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(0.01, 0.2)
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(round(cx + r * math.cos(t), 3), round(cy + r * math.sin(t), 3)) for t in turns]
        rows.append((i % 30, [ring + ring[:1]]))
    rows.append((99, [[(0.0, 0.0), (0.3, 0.0), (0.3, 0.3), (0.0, 0.3), (0.0, 0.0)], [(0.1, 0.1), (0.2, 0.1), (0.2, 0.2), (0.1, 0.1)]]))
    polygons = g.with_bounds(spark.createDataFrame(rows, "id int, rings array<array<struct<x:double,y:double>>>"))

    def cover():
        frame = spatial.polygon_cover(polygons, ["id"], 0.05, small_edges=3).frame
        return sorted(
            (r.id, r.cov_ix, r.cov_iy, r.cov_ref_x, r.cov_ref_y, r.cov_ref_inside, sorted(map(tuple, r.cov_edges)), r.cov_xmin)
            for r in frame.filter("cov_ref_x IS NOT NULL").collect()
        )

    got = cover()
    bounds = polygons.select("id", "xmin", "ymin", "xmax", "ymax", g.ring_edges().alias("cov_edges"))
    alone = spatial._cut_in_row(bounds, ["id"], 0.05)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(spatial, "FEW_EDGE_CELLS", 0)
    assert got == cover() and len(got) > 200
