"""Imagery checks on hand-made scenes, pixels and buildings."""

import datetime
import math
import random

from emberscope.config import ImageryParams
from emberscope.functions import geometry as g
from emberscope.operators import imagery
from emberscope.operators.regions import label_regions, region_summary
from emberscope.plans import validation as val

DAY = 86_400_000
EPOCH = datetime.date(1970, 1, 1)
ACQ = datetime.date(2024, 6, 15)
STEP = 0.0001


def ms(day, hour=10):
    return (day - EPOCH).days * DAY + hour * 3_600_000


def at(days):
    return ACQ + datetime.timedelta(days=days)


def run(spark, scenes, detections=None, pixels=(), buildings=(), **params):
    """scenes: (id, day offset, cloud[, hour]); pixels: (scene, px, py, b8, b12)."""
    areas = spark.createDataFrame(
        [("area-a", 9.99, 49.99, 10.01, 50.01), ("area-b", 9.995, 49.995, 10.02, 50.02)],
        "area_id string, xmin double, ymin double, xmax double, ymax double",
    )
    detections = detections or [(1, ACQ, 10.0, 50.0, "area-a")]
    det = spark.createDataFrame(detections, "firms_id long, acq_date date, lon double, lat double, area_id string")
    sc = spark.createDataFrame(
        [(s[0], ms(at(s[1]), s[3] if len(s) > 3 else 10), float(s[2]), 9.0, 49.0, 11.0, 51.0) for s in scenes],
        "scene_id long, ts_ms long, cloud_pct double, xmin double, ymin double, xmax double, ymax double",
    )
    px = spark.createDataFrame(
        [(s, x, y, 10.0 + x * STEP, 50.0 + y * STEP, float(b8), float(b12)) for s, x, y, b8, b12 in pixels],
        "scene_id long, px long, py long, lon double, lat double, b8 double, b12 double",
    )
    bl = g.with_bounds(
        spark.createDataFrame(
            [(i, conf, [[(float(x), float(y)) for x, y in ring]]) for i, conf, ring in buildings],
            "building_id long, confidence double, rings array<array<struct<x:double,y:double>>>",
        )
    )
    out = val.validate_batch(det, areas, sc, px, bl, ImageryParams(**params))
    return {r.firms_id: r for r in out.collect()}


def box(x1, y1, x2, y2):
    return [(10 + x1, 50 + y1), (10 + x2, 50 + y1), (10 + x2, 50 + y2), (10 + x1, 50 + y2), (10 + x1, 50 + y1)]


def test_no_scenes_and_one_sided_scenes(spark):
    assert run(spark, [])[1].no_data
    assert run(spark, [(1, -5, 0)])[1].no_data
    assert run(spark, [(1, 5, 0), (2, 9, 0)])[1].no_data
    # A scene on the day itself is on neither side.
    assert run(spark, [(1, -5, 0), (2, 0, 0)])[1].no_data


def test_window_is_half_open(spark):
    assert not run(spark, [(1, -30, 0), (2, 29, 0)])[1].no_data
    assert run(spark, [(1, -31, 0), (2, 29, 0)])[1].no_data
    assert run(spark, [(1, -30, 0), (2, 30, 0)])[1].no_data


def test_cloud_limit_is_strict(spark):
    r = run(spark, [(1, -5, 10.0), (2, 5, 0)])[1]
    assert (r.no_data, r.too_cloudy) == (False, True)
    assert r.before_date is None and r.burnt_pixel_count == 0
    r = run(spark, [(1, -5, 9.99), (2, 5, 0)])[1]
    assert (r.no_data, r.too_cloudy) == (False, False)


def test_nearest_clear_dates(spark):
    r = run(spark, [(1, -20, 0), (2, -4, 50), (3, -6, 3), (4, 0, 0), (5, 8, 2), (6, 3, 90), (7, 20, 0)])[1]
    assert (r.before_date, r.after_date) == (at(-6), at(8))


def _burnt(scene_before, scene_after, cells, b8=30, b12=70):
    rows = []
    for x, y in cells:
        rows += [(scene_before, x, y, 60, 40), (scene_after, x, y, b8, b12)]
    return rows


def test_pixel_threshold_is_strict(spark):
    cells = [(x, 0) for x in range(11)]
    r = run(spark, [(1, -5, 0), (2, 5, 0)], pixels=_burnt(1, 2, cells))[1]
    assert (r.burnt_pixel_count, r.burn_scar_detected) == (11, True)
    r = run(spark, [(1, -5, 0), (2, 5, 0)], pixels=_burnt(1, 2, cells[:10]))[1]
    assert (r.burnt_pixel_count, r.burn_scar_detected) == (10, False)


def test_mask_limits_masked_pixels_and_square(spark):
    pixels = [
        (1, 0, 0, 50, 50), (2, 0, 0, 45, 55),  # difference 0.1: no
        (1, 1, 0, 60, 40), (2, 1, 0, 50, 50),  # after 0: no
        (1, 2, 0, 525, 475), (2, 2, 0, 45, 55),  # difference 0.15, after -0.1: limits count
        (1, 3, 0, 60, 40), (2, 3, 0, 0, 0),  # masked after
        (1, 4, 0, 60, 40),  # missing after
        (1, 200, 0, 60, 40), (2, 200, 0, 30, 70),  # outside the square of 1 km
        (1, 0, 80, 60, 40), (2, 0, 80, 30, 70),  # inside to the north
        (1, 0, 95, 60, 40), (2, 0, 95, 30, 70),  # outside to the north
    ]
    r = run(spark, [(1, -5, 0), (2, 5, 0)], pixels=pixels)[1]
    assert r.burnt_pixel_count in (1, 2)  # 525/475 gives 0.05 + 0.1 up to rounding
    r = run(spark, [(1, -5, 0), (2, 5, 0)], pixels=pixels, min_nbr_difference=0.1499)[1]
    assert r.burnt_pixel_count == 2


def test_first_scene_of_a_day(spark):
    scenes = [(1, -5, 0), (9, 5, 0, 8), (2, 5, 0, 10), (3, 5, 60, 6)]
    pixels = _burnt(1, 9, [(0, 0), (1, 0)]) + [(2, 0, 0, 60, 40)]
    assert run(spark, scenes, pixels=pixels)[1].burnt_pixel_count == 2


def test_buildings(spark):
    burnt = _burnt(1, 2, [(x, y) for x in range(30) for y in range(3)])
    buildings = [
        (1, 0.9, box(0.0001, 0.0001, 0.0002, 0.0002)),  # on burnt pixels
        (2, 0.75, box(0.0002, 0.0, 0.0029, 0.0001)),  # long, over several blocks: counts once
        (3, 0.74, box(0.0001, 0.0001, 0.0002, 0.0002)),  # not sure enough
        (4, 0.9, box(-0.0010, -0.0010, -0.0008, -0.0008)),  # beside
        (5, 0.9, box(-0.00004, 0.0, -0.00002, 0.00001)),  # touches the edge of pixel 0
        (6, 0.9, box(0.00001, 0.00001, 0.000015, 0.000015)),  # inside one pixel
        (7, 0.9, box(-0.001, -0.001, 0.004, 0.003)),  # holds all pixels
    ]
    r = run(spark, [(1, -5, 0), (2, 5, 0)], pixels=burnt, buildings=buildings)[1]
    assert r.burnt_pixel_count == 90
    assert r.burnt_building_count == 5


def test_detection_in_two_areas_uses_the_smallest_id(spark):
    detections = [(1, ACQ, 10.0, 50.0, "area-b"), (1, ACQ, 10.0, 50.0, "area-a"), (2, ACQ, 10.0, 50.0, "area-b")]
    got = run(spark, [(1, -5, 0), (2, 5, 0)], detections=detections, pixels=_burnt(1, 2, [(0, 0)]))
    assert sorted(got) == [1, 2]
    assert all(r.burnt_pixel_count == 1 for r in got.values())


def test_tries_follow_what_was_left_open(spark):
    schema = "firms_id long, acq_date date, no_data boolean, too_cloudy boolean"
    rows = [(i, at(-d)) for i, d in enumerate((5, 12, 17, 17, 30, 30))]
    cand = spark.createDataFrame(rows, "firms_id long, acq_date date")
    seen = []

    def check(batch, n):
        ids = sorted(r.firms_id for r in batch.collect())
        seen.append(ids)
        out = [(i, rows[i][1], i in (2, 4) and n < 2, i == 3 and n == 0) for i in ids]
        return spark.createDataFrame(out, schema)

    results = val.validate_tries(cand, check, ACQ)
    assert seen == [[1, 2, 3, 4, 5], [2, 3, 4], [4]]
    latest = {r.firms_id: (r.validation_try, r.no_data) for r in val.latest_try(results).collect()}
    assert latest == {1: (0, False), 2: (1, True), 3: (1, False), 4: (2, False), 5: (0, False)}
    strict = val.due_for_try(cand, ACQ, 12)
    assert sorted(r.firms_id for r in strict.collect()) == [2, 3, 4, 5]  # 12 days old is too young


def test_regions_are_four_connected(spark):
    picture = [
        "##..#",
        ".#.#.",
        ".###.",
        "....#",
        "#####",
    ]
    cells = [(x, y) for y, line in enumerate(picture) for x, c in enumerate(line) if c == "#"]
    # A long snake needs many label steps; a second pair must not mix with the first.
    snake = [(x, 10 + 2 * k) for k in range(12) for x in range(20)]
    snake += [(19 if k % 2 == 0 else 0, 11 + 2 * k) for k in range(11)]
    rows = [(1, 2, x, y) for x, y in cells + snake] + [(1, 3, x, y) for x, y in cells]
    df = spark.createDataFrame(rows, "before_scene long, after_scene long, px long, py long")
    got = sorted((r.after_scene, r.n_pixels) for r in region_summary(df).collect())
    assert got == sorted([(2, 1), (2, 7), (2, 6), (2, len(snake)), (3, 1), (3, 7), (3, 6)])
    assert label_regions(df).select("region").distinct().count() == 4


def test_regions_of_few_and_many_runs(spark, monkeypatch):
    """Labels in one go and in rounds agree with a flood fill, pair by pair."""
    from emberscope.operators import regions

    rng = random.Random(5)
    cells = {(pair, x, y) for pair in range(4) for x in range(14) for y in range(9) if rng.random() < 0.55}
    expected, left = [], set(cells)
    while left:
        todo, seen = [left.pop()], []
        while todo:
            pair, x, y = todo.pop()
            seen.append((x, y))
            for near in ((pair, x + 1, y), (pair, x - 1, y), (pair, x, y + 1), (pair, x, y - 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
        xs, ys = zip(*seen)
        expected.append((pair, len(seen), min(xs), max(xs), min(ys), max(ys)))
    rows = [(pair, pair + 10, x, y) for pair, x, y in cells] + [(0, 10, None, 3), (1, 11, 4, None)]
    df = spark.createDataFrame(rows, "before_scene long, after_scene long, px long, py long")
    lone = [(0, 1, None, None, 3, 3), (1, 1, 4, 4, None, None)]
    for few in (10_000, 40, 0):
        monkeypatch.setattr(regions, "FEW_RUNS", few)
        found = [
            (r.before_scene, r.n_pixels, r.px_min, r.px_max, r.py_min, r.py_max)
            for r in regions.region_summary(df).collect()
        ]
        assert sorted(map(str, found)) == sorted(map(str, expected + lone))


def test_squares_near_the_pole(spark, tmp_path):
    """Squares of a thousand metres go round the pole there: rows of blocks instead of every block."""
    rng = random.Random(3)
    at_lat = {1: 80.0, 2: 80.001, 3: 86.0, 4: 89.9, 5: 89.9999, 6: 90.0, 7: 90.5}
    areas = spark.createDataFrame(
        [("a", 0.0, 79.0, 30.0, 91.0)], "area_id string, xmin double, ymin double, xmax double, ymax double"
    )
    det = spark.createDataFrame(
        [(i, ACQ, 10.0, lat, "a") for i, lat in at_lat.items()],
        "firms_id long, acq_date date, lon double, lat double, area_id string",
    )
    sc = spark.createDataFrame(
        [(i, ms(at(d)), 0.0, 0.0, 79.0, 30.0, 91.0) for i, d in ((1, -3), (2, 3))],
        "scene_id long, ts_ms long, cloud_pct double, xmin double, ymin double, xmax double, ymax double",
    )
    # Two burnt pixels of the building at 89.9 lie in blocks of their own.
    places = [(10.0501, 89.9001), (10.0561, 89.9001)]
    for reach, n in ((0.06, 200), (0.2, 200), (8.0, 200)):
        for lat in at_lat.values():
            places += [(10 + rng.uniform(-reach, reach), lat + rng.uniform(-0.012, 0.012)) for _ in range(n)]
    burnt = [k % 3 != 2 for k in range(len(places))]
    rows = [(1, k, 0, x, y, 100.0, 10.0) for k, (x, y) in enumerate(places)]
    rows += [(2, k, 0, x, y, *((10.0, 100.0) if burnt[k] else (100.0, 10.0))) for k, (x, y) in enumerate(places)]
    px = spark.createDataFrame(rows, "scene_id long, px long, py long, lon double, lat double, b8 double, b12 double")
    ring = [(x, y) for x, y in ((10.05, 89.9), (10.058, 89.9), (10.058, 89.9002), (10.05, 89.9002), (10.05, 89.9))]
    bl = g.with_bounds(
        spark.createDataFrame(
            [(1, 0.9, [ring])],
            "building_id long, confidence double, rings array<array<struct<x:double,y:double>>>",
        )
    )
    params = ImageryParams()
    wanted = {}
    for i, lat in at_lat.items():
        d_lat, d_lon = 1000 / 111320, 1000 / (111320 * math.cos(math.radians(lat)))
        near = lambda p: abs(p[1] - lat) <= d_lat and 10 - d_lon <= p[0] <= 10 + d_lon  # noqa: E731, B023
        wanted[i] = sum(b and near(p) for p, b in zip(places, burnt)), int(any(map(near, places[:2])))
    assert wanted[4][1] and wanted[7] == (0, 0) and all(wanted[i][0] for i in range(1, 7))
    imagery.store_pixels(px, sc, f"{tmp_path}/pixels", params)
    for pixels in (px, imagery.stored_pixels(spark, f"{tmp_path}/pixels")):
        got = val.validate_batch(det, areas, sc, pixels, bl, params).collect()
        assert {r.firms_id: (r.burnt_pixel_count, r.burnt_building_count) for r in got} == wanted
