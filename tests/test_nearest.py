"""Nearest places against brute force."""

import math
import random

import pytest

from emberscope.operators.nearest import nearest_settlement, nearest_within


def hav(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1.0, math.sqrt(h)))


def make(spark, spots, places):
    p = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "pid int, lon double, lat double")
    s = spark.createDataFrame([(f"p{i:05d}", *c) for i, c in enumerate(places)], "name string, lon double, lat double")
    return p, s


def brute(spots, places, dist, limit):
    want = {}
    for i, a in enumerate(spots):
        d, name = min((dist(a, b), f"p{k:05d}") for k, b in enumerate(places))
        want[i] = (d, name) if limit is None or d <= limit else (None, None)
    return want


def check(got, want):
    assert got.keys() == want.keys()
    for i, (d, name) in want.items():
        if d is None:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == pytest.approx(d, abs=1e-6)
            assert got[i][1] == name


@pytest.mark.parametrize("max_candidates", [4, 64])
def test_within_cutoff_with_a_crowded_cell(spark, max_candidates):
    rng = random.Random(11)
    places = [(round(rng.uniform(30, 31), 5), round(rng.uniform(60, 61), 5)) for _ in range(150)]
    places += [(round(30.5 + rng.gauss(0, 0.01), 5), round(60.5 + rng.gauss(0, 0.01), 5)) for _ in range(400)]
    spots = [(round(rng.uniform(29.5, 31.5), 5), round(rng.uniform(59.5, 61.5), 5)) for _ in range(150)]
    spots += [(round(30.5 + rng.gauss(0, 0.02), 5), round(60.5 + rng.gauss(0, 0.02), 5)) for _ in range(200)]
    p, s = make(spark, spots, places)
    named = nearest_within(p.select("lon", "lat").distinct(), s, 10_000.0, max_candidates=max_candidates)
    got = {
        r.pid: (r.settlement_distance, r.settlement_name)
        for r in p.join(named, ["lon", "lat"], "left").collect()
    }
    check(got, brute(spots, places, hav, 10_000.0))


def test_no_cutoff_in_degrees(spark):
    rng = random.Random(2)
    places = [(round(rng.uniform(0, 1), 4), round(rng.uniform(0, 1), 4)) for _ in range(120)] + [(40.0, 40.0)]
    spots = [(round(rng.uniform(-1, 2), 4), round(rng.uniform(-1, 2), 4)) for _ in range(60)] + [(25.0, 60.0), (-170.0, -80.0)]
    p, s = make(spark, spots, places)
    got = {
        r.pid: (r.settlement_distance, r.settlement_name)
        for r in nearest_settlement(p, s, None).collect()
    }
    check(got, brute(spots, places, lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1]), None))


def test_date_line_and_ties(spark):
    p, s = make(spark, [(179.99, 0.0), (5.0, 5.0)], [(-179.99, 0.0), (5.01, 5.0), (4.99, 5.0), (5.0, 50.0)])
    got = {r.pid: r.settlement_name for r in nearest_settlement(p, s, 10_000.0).collect()}
    assert got[0] == "p00000"
    assert got[1] in ("p00001", "p00002")


def test_no_places(spark):
    p, s = make(spark, [(1.0, 1.0)], [(1.0, 1.0)])
    (row,) = nearest_settlement(p, s.filter("name = ''"), 10_000.0).collect()
    assert row.settlement_name is None and row.settlement_distance is None


def test_no_cutoff_over_a_pyramid(spark):
    rng = random.Random(5)
    places = [(round(10 + rng.gauss(0, 0.05), 5), round(10 + rng.gauss(0, 0.05), 5)) for _ in range(300)]
    places += [(round(rng.uniform(-180, 180), 3), round(rng.uniform(0, 90), 3)) for _ in range(60)]
    spots = [(round(10 + rng.gauss(0, 0.2), 5), round(10 + rng.gauss(0, 0.2), 5)) for _ in range(120)]
    spots += [(round(rng.uniform(-180, 180), 3), round(rng.uniform(-90, 90), 3)) for _ in range(200)]
    spots += [(180.0, 90.0), (-180.0, -90.0), (0.0, 0.0)]
    p, s = make(spark, spots, places)
    got = {r.pid: (r.settlement_distance, r.settlement_name) for r in nearest_settlement(p, s, None).collect()}
    check(got, brute(spots, places, lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1]), None))
    assert [r.settlement_name for r in nearest_settlement(p.limit(2), s.filter("name = ''"), None).collect()] == [None] * 2


def test_places_out_of_reach_are_not_listed(spark, monkeypatch):
    from emberscope.operators import nearest

    seen = []
    settle = nearest._settle
    monkeypatch.setattr(nearest, "_settle", lambda seats, candidates, *a: seen.append(candidates) or settle(seats, candidates, *a))
    p, s = make(spark, [(5.0, 5.0)], [(5.01, 5.0)] + [(round(60 + k / 500, 3), 20.0) for k in range(300)])
    for limit in (10_000.0, None):
        assert [r.settlement_name for r in nearest_settlement(p, s, limit).collect()] == ["p00000"]
    assert [c.select("name").distinct().count() for c in seen] == [1, 1]
