"""Event chaining, numbering and extents on small made cases."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions

from emberscope.operators.extent import event_extent
from emberscope.operators.islands import assign_events
from emberscope.operators.numbering import number_rows, number_rows_per_interval
from emberscope.operators.pairs import extent_across_areas, extent_within
from emberscope.plans.events import cluster_events, on_event_days

D = datetime.date


def hav(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(h))


def test_gap_of_two_merges_and_three_splits(spark):
    days = [D(2024, 1, 1), D(2024, 1, 3), D(2024, 1, 3), D(2024, 1, 6), D(2024, 1, 6), D(2024, 1, 8)]
    df = spark.createDataFrame([(i, "a", d) for i, d in enumerate(days)], "firms_id int, area_id string, acq_date date")
    got = {r.firms_id: r.event_no for r in assign_events(df).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2}


def test_event_measures(spark):
    none = None
    rows = [
        (1, "a", D(2024, 1, 1), 1.0, 1.0, D(2023, 12, 30), D(2024, 1, 4), True, 20, 1, False, False),
        (2, "a", D(2024, 1, 2), 1.0, 1.0, D(2023, 12, 29), none, False, 0, 0, False, False),
        (3, "a", D(2024, 1, 3), 1.002, 1.0, none, none, False, 0, 0, True, False),
        (4, "b", D(2024, 1, 3), 5.0, 1.0, none, none, False, 0, 0, False, True),
    ]
    schema = (
        "firms_id long, area_id string, acq_date date, lon double, lat double, before_date date, after_date date,"
        " burn_scar_detected boolean, burnt_pixel_count long, burnt_building_count long, no_data boolean, too_cloudy boolean"
    )
    got = {r.area_id: r for r in cluster_events(spark.createDataFrame(rows, schema)).collect()}
    a = got["a"]
    assert (a.start_date, a.end_date, a.event_count) == (D(2024, 1, 1), D(2024, 1, 3), 3)
    assert a.before_date == D(2023, 12, 29)  # tie: earliest
    assert a.after_date == D(2024, 1, 4)
    assert a.burn_scar_detected == pytest.approx(1 / 3)
    assert a.no_data == pytest.approx(1 / 3)
    assert a.lon == pytest.approx(1.001)  # the two equal positions count once
    assert a.max_distance == pytest.approx(hav((1.0, 1.0), (1.002, 1.0)))
    assert got["b"].max_distance == 0.0
    assert got["b"].too_cloudy == 1.0
    joined = on_event_days(spark.createDataFrame(rows, schema), spark.createDataFrame(list(got.values())))
    assert joined.count() == 4


def _cloud(spark, seed=3):
    """A hot event, a ring, a line on one meridian, a pair and a single point."""
    rng = random.Random(seed)
    rows = [("hot", 1, round(30 + rng.gauss(0, 0.02), 5), round(50 + rng.gauss(0, 0.02), 5)) for _ in range(700)]
    rows += [("ring", 1, 10 + math.cos(k / 20) * 0.03, 60 + math.sin(k / 20) * 0.03) for k in range(126)]
    rows += [("line", 2, 5.0, round(rng.uniform(1, 1.05), 5)) for _ in range(40)]
    rows += [("pair", 1, 0.0, 0.0), ("pair", 1, 0.001, 0.001), ("one", 1, 7.0, 7.0)]
    rows += [("same", 1, 7.5, 7.5), ("same", 1, 7.5, 7.5)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "firms_id long, area_id string, event_no int, lon double, lat double")
    return df, rows


@pytest.mark.parametrize("axis_order", ["lonlat", "latlon"])
def test_extent_equals_all_pairs(spark, axis_order):
    df, rows = _cloud(spark)
    want = {}
    for i, area, no, *a in rows:
        for j, area2, no2, *b in rows:
            if (area, no) == (area2, no2):
                d = hav(a, b) if axis_order == "lonlat" else hav(a[::-1], b[::-1])
                want[area, no] = max(want.get((area, no), 0.0), d)
    got = {(r.area_id, r.event_no): r.max_distance for r in event_extent(df, ["area_id", "event_no"], axis_order=axis_order).collect()}
    assert got.keys() == want.keys()
    for key, d in want.items():
        assert got[key] == pytest.approx(d, abs=1e-4), key


@pytest.mark.parametrize("cutoff", [200.0, 2500.0, 50_000.0])
def test_extent_below_cutoff_equals_all_pairs(spark, cutoff):
    df, rows = _cloud(spark)
    want = {}
    for i, area, no, *a in rows:
        for j, area2, no2, *b in rows:
            if (area, no) == (area2, no2) and hav(a, b) <= cutoff:
                want[area, no] = max(want.get((area, no), 0.0), hav(a, b))
    got = {(r.area_id, r.event_no): r.max_distance for r in extent_within(df, ["area_id", "event_no"], cutoff).collect()}
    assert got.keys() == want.keys()
    for key, d in want.items():
        assert got[key] == pytest.approx(d, abs=1e-4), key


def test_extent_across_areas_equals_all_pairs(spark):
    rng = random.Random(5)
    rows = [
        (i, rng.choice("aaab"), rng.choice([1, 1, 2]), round(rng.uniform(20, 21), 3), round(rng.uniform(5, 6), 3))
        for i in rng.sample(range(5000), 150)
    ]
    df = spark.createDataFrame(rows, "firms_id long, area_id string, event_no int, lon double, lat double")
    want = {}
    for i, area, no, *a in rows:
        for j, _, no2, *b in rows:
            if no == no2 and i < j:
                want[area, no] = max(want.get((area, no), 0.0), hav(a, b))
    got = {(r.area_id, r.event_no): r.max_distance for r in extent_across_areas(df).collect()}
    assert got.keys() == want.keys()
    for key, d in want.items():
        assert got[key] == pytest.approx(d, abs=1e-4)


def test_numbers_are_dense_and_ordered(spark):
    rng = random.Random(1)
    rows = [(D(2024, 1, 1 + min(rng.randrange(9), 2)), rng.randrange(1440), rng.random(), rng.random()) for _ in range(900)]
    df = spark.createDataFrame(rows, "acq_date date, acq_time int, lon double, lat double")
    got = [tuple(r)[:4] for r in number_rows(df).orderBy("id").collect()]
    assert got == sorted(rows)
    ids = sorted(r.id for r in number_rows(df).select("id").collect())
    assert ids == list(range(1, 901))
    per_day = number_rows_per_interval(df).groupBy("acq_date").agg({"id": "max", "*": "count"}).collect()
    assert all(r["max(id)"] == r["count(1)"] for r in per_day)


def test_session_windows_on_a_stream(spark, tmp_path):
    """Closed sessions of a stream equal the events of the batch rule."""
    from emberscope.streaming.arrivals import session_events

    days = [D(2024, 1, 1), D(2024, 1, 3), D(2024, 1, 6), D(2024, 3, 1)]
    rows = [(i, "a", d) for i, d in enumerate(days)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(rows, "firms_id int, area_id string, acq_date date")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    query = (
        session_events(stream, watermark="1 day")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = sorted((r.start_date, r.end_date, r.event_count) for r in spark.read.parquet(out).collect())
    assert got == [(days[0], days[1], 2), (days[2], days[2], 1)]
    batch = session_events(df).count()
    assert batch == 3


def _metres(a, b):
    (u1, v1), (u2, v2) = [[math.radians(x) for x in p] for p in (a, b)]
    h = math.sin((v1 - v2) / 2) ** 2 + math.cos(v1) * math.cos(v2) * math.sin((u1 - u2) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(min(1.0, max(0.0, h))))


def _world(spark, seed, n=120):
    rng = random.Random(seed)
    rows = [(1, i - n // 2, round(rng.uniform(-180, 180), 5), round(rng.uniform(-90, 90), 5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "event_no int, firms_id long, lon double, lat double")


@pytest.mark.parametrize("axis_order", ["lonlat", "latlon"])
def test_extent_round_the_globe(spark, axis_order):
    rows, df = _world(spark, 5)
    pts = [(r[2], r[3]) if axis_order == "lonlat" else (r[3], r[2]) for r in rows]
    want = max(_metres(a, b) for a in pts for b in pts)
    got = event_extent(df, ["event_no"], axis_order=axis_order).collect()
    assert len(got) == 1 and got[0].max_distance == pytest.approx(want, abs=0.01)


def test_extent_across_areas_with_signed_ids_round_the_globe(spark):
    rows, df = _world(spark, 6, 60)
    df = df.withColumn("area_id", functions.expr("pmod(firms_id, 3)"))
    got = {r.area_id: r.max_distance for r in extent_across_areas(df).collect()}
    for area in range(3):
        mine = [r for r in rows if r[1] % 3 == area]
        want = max(_metres(a[2:], b[2:]) for a in mine for b in rows if a[1] < b[1])
        assert got[area] == pytest.approx(want, abs=0.01)


def test_extent_across_areas_keeps_areas_without_a_name_and_positions_without_numbers(spark):
    """Wide events, so cells are halved; a pair without distance still makes a row."""
    rows, df = _world(spark, 4, 40)
    df = df.withColumn("area_id", functions.expr("nullif(pmod(firms_id, 2), 0)"))
    got = {r.area_id: r.max_distance for r in extent_across_areas(df).collect()}
    assert set(got) == {None, 1}
    for area in got:
        mine = [r for r in rows if r[1] % 2 == (area or 0)]
        want = max(_metres(a[2:], b[2:]) for a in mine for b in rows if a[1] < b[1])
        assert got[area] == pytest.approx(want, abs=0.01)
    odd = [(1, 1, 7, float("nan"), 0.0), (2, 1, 8, 1.0, None), (2, 2, 9, 1.0, 1.0)]
    df = spark.createDataFrame(odd, "area_id int, event_no int, firms_id long, lon double, lat double")
    assert [tuple(r) for r in extent_across_areas(df).collect()] == [(1, 1, None)]


@pytest.mark.parametrize(
    "lon, lat, axis_order", [(112.0, 20.0, "latlon"), (180.0, 10.0, "lonlat"), (0.0, 90.0, "lonlat"), (90.0, 5.0, "latlon")]
)
def test_extent_within_cutoff_anywhere(spark, lon, lat, axis_order):
    rng = random.Random(7)
    rows = []
    for _ in range(150):
        x, y = lon + rng.uniform(-0.08, 0.08), lat + rng.uniform(-0.08, 0.08)
        if lat == 90.0:
            x, y = rng.uniform(-180, 180), 90 - abs(y - 90)
        rows.append((1, round((x + 180) % 360 - 180, 5), round(y, 5)))
    df = spark.createDataFrame(rows, "event_no int, lon double, lat double")
    pts = [r[1:] if axis_order == "lonlat" else (r[2], r[1]) for r in rows]
    want = max(d for a in pts for b in pts if (d := _metres(a, b)) <= 4000)
    got = extent_within(df, ["event_no"], 4000.0, axis_order=axis_order).collect()
    assert len(got) == 1 and got[0].max_distance == pytest.approx(want, abs=0.01)
