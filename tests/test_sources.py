"""Files: detection feed, settlements, polygons, stored tables, streams, audits."""

import datetime
import hashlib
import os
import sqlite3
import struct

import pytest

from emberscope.operators import audits
from emberscope.plans import ingest as ing
from emberscope.sources import detections as src
from emberscope.sources import places, polygons, tables
from emberscope.streaming.arrivals import land_new_files

HEADER = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,confidence,version,bright_ti5,frp,daynight"
D = datetime.date


def line(lat, lon, day="2024-01-01", time="730", sat="N", conf="n", frp="1.5"):
    return f"{lat},{lon},300.1,0.4,0.5,{day},{time},{sat},VIIRS,{conf},2.0NRT,280.0,{frp},D"


def feed(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_scan_and_quarantine(spark, tmp_path):
    a = feed(tmp_path, "a.csv", line(1, 2), line(3, 4, time="2460"), line("x", 4))
    b = feed(tmp_path, "b.csv", line(5, 6, sat="N20"), line(5, 7, sat="Q"), line(5, 8, day="yesterday"))
    valid, rejected = src.check_records(src.scan_detections(spark, [a, b]))
    got = sorted((r.latitude, r.longitude, r.acq_date, r.acq_time) for r in valid.collect())
    assert got == [(1.0, 2.0, D(2024, 1, 1), 450), (5.0, 6.0, D(2024, 1, 1), 450)]
    problems = sorted(p for r in rejected.collect() for p in r.problems)
    assert problems == ["acq_date", "acq_time", "latitude", "satellite"]


def test_strict_load_fails_on_one_bad_row(spark, tmp_path):
    a = feed(tmp_path, "a.csv", line(1, 2), line(3, 4, conf="z"))
    with pytest.raises(Exception, match="bad detection record: confidence"):
        src.require_valid(src.scan_detections(spark, a)).collect()


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("Invalid API call,,,,,,,,,,,,,\n" + line(1, 2) + "\n")
    with pytest.raises(Exception):
        src.scan_detections(spark, str(path)).select("latitude", "longitude").collect()


def test_ingest_clips_to_country(spark, tmp_path):
    from emberscope.functions import geometry as g

    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    country = g.with_bounds(
        spark.createDataFrame([([ring],)], "rings array<array<struct<x:double,y:double>>>")
    )
    a = feed(tmp_path, "a.csv", line(1, 2), line(11, 2), line(3, "bad"), line(0, 5))
    raw, rejected = ing.ingest(spark, a, country, "SDN", cell_deg=1.0)
    (row,) = raw.collect()
    assert (row.country_id, row.latitude, row.longitude) == ("SDN", 1.0, 2.0)
    assert raw.columns == list(src.RAW_DETECTION_COLUMNS)
    assert rejected.count() == 1
    table = ing.detection_table(raw, D(2024, 1, 1), D(2024, 1, 1), ids="interval")
    assert [tuple(r) for r in table.collect()] == [(1, D(2024, 1, 1), 2.0, 1.0)]
    assert ing.detection_table(raw, D(2024, 1, 2), D(2024, 1, 3)).count() == 0


def test_settlements(spark, tmp_path):
    path = tmp_path / "SDN.txt"
    row = ["1", 'Kassala "old"', "Kassala", "a,b", "15.4", "36.4", "P", "PPL", "SD", "", "", "", "", "", "5", "", "1", "Africa", "2024-01-01"]
    path.write_text("\t".join(row) + "\n")
    (r,) = places.scan_settlements(spark, str(path)).collect()
    assert tuple(r) == ('Kassala "old"', 36.4, 15.4)


def wkb(rings):
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    return out


SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
FAR = [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]
OPEN = [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 6.0)]


@pytest.fixture
def package(tmp_path):
    path = str(tmp_path / "areas.gpkg")
    multi = struct.pack("<BII", 1, 6, 2) + wkb([SQUARE]) + wkb([FAR])
    head = b"GP\x00" + bytes([0b0000_0011]) + struct.pack("<i4d", 4326, 0, 6, 0, 6)
    bare = b"GP\x00" + bytes([1]) + struct.pack("<i", 4326)
    with sqlite3.connect(path) as con:
        for layer in ("areas", "ADM_ADM_2"):
            con.execute(f"CREATE TABLE {layer} (fid INTEGER PRIMARY KEY, GID_0 TEXT, NAME_1 TEXT, NAME_2 TEXT, geom BLOB)")
            for k, blob in enumerate([head + multi, bare + wkb([SQUARE]), bare + wkb([OPEN])]):
                con.execute(f"INSERT INTO {layer} VALUES (?, 'SDN', 'One', ?, ?)", (k * 7 + 1, f"Two{k}", blob))
    return path


def test_area_polygons(spark, package):
    rows = polygons.area_polygons(spark, package).collect()
    ids = sorted(r.id for r in rows)
    square = hashlib.md5(wkb([SQUARE])).hexdigest()
    assert ids == sorted([square, square, hashlib.md5(wkb([FAR])).hexdigest()])
    assert rows[0].file_mtime == pytest.approx(os.path.getmtime(package))
    assert polygons.area_polygons(spark, None).count() == 0
    with pytest.raises(FileNotFoundError):
        polygons.area_polygons(spark, package + ".missing")


def test_geopackage_splits_by_row_id(spark, package):
    df = polygons.read_geopackage(spark, package, "areas", ["NAME_2"], rowsPerTask="5")
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.NAME_2 for r in df.collect()) == ["Two0", "Two1", "Two2"]


def test_admin_polygons(spark, package):
    rows = {r.gadm_2: r for r in polygons.admin_polygons(spark, package, 2).collect()}
    assert set(rows) == {"Two0", "Two1", "Two2"}
    assert len(rows["Two0"].rings) == 2 and rows["Two0"].xmax == 6.0
    assert rows["Two1"].country_id == "SDN"


def test_polygon_checks(spark):
    from emberscope.functions import geometry as g

    bow = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    flat = [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)]
    rows = [("ok", [SQUARE]), ("open", [OPEN]), ("short", [SQUARE[:3]]), ("flat", [flat]), ("bow", [bow])]
    df = g.with_bounds(spark.createDataFrame(rows, "id string, rings array<array<struct<x:double,y:double>>>"))
    good, bad = polygons.check_polygons(df)
    assert {r.id: r.problem for r in bad.collect()} == {
        "open": "ring not closed", "short": "too few positions", "flat": "no area", "bow": "no area",
    }
    assert [r.id for r in polygons.self_crossings(df, "id").collect()] == ["bow"]
    assert [r.id for r in good.collect()] == ["ok"]


def test_self_crossings_in_a_crowded_corner(spark):
    from emberscope.functions import geometry as g

    # A large box whose lower-left corner is replaced by a fine saw.
    saw = [(0.001 * k / 300, 0.001 * (k % 2) / 300 + 0.001 * (300 - k) / 300) for k in range(301)]
    clean = [*saw, (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), saw[0]]
    bent = [*saw[:150], saw[152], saw[151], saw[150], *saw[153:], (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), saw[0]]
    crossed = [*saw, (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), saw[0]]
    rows = [("clean", [clean]), ("bent", [bent]), ("crossed", [crossed])]
    df = g.with_bounds(spark.createDataFrame(rows, "id string, rings array<array<struct<x:double,y:double>>>"))

    def crosses(ring):
        def turn(a, b, p):
            v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
            return (v > 0) - (v < 0)

        edges = list(zip(ring, ring[1:]))
        return any(
            turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
            for i, (a, b) in enumerate(edges)
            for c, d in edges[:i]
        )

    want = {name for name, (ring,) in rows if crosses(ring)}
    assert want == {"bent", "crossed"}
    for max_edges in (8, 64):
        assert {r.id for r in polygons.self_crossings(df, "id", max_edges).collect()} == want


def test_three_dimensional_wkb():
    ring = [(0.0, 0.0, 9.0), (1.0, 0.0, 9.0), (1.0, 1.0, 9.0), (0.0, 0.0, 9.0)]
    body = struct.pack("<I", 4) + b"".join(struct.pack("<3d", *p) for p in ring)
    for code in (1003, 0x80000003):
        (part,) = polygons.parts_of_wkb(struct.pack("<BII", 1, code, 1) + body)
        assert [(p["x"], p["y"]) for p in part[0]] == [p[:2] for p in ring]
    with pytest.raises(ValueError):
        polygons.parts_of_wkb(struct.pack("<BIdd", 1, 1, 0.0, 0.0))


def test_replaced_days_keep_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, acq_date date"
    tables.replace_days(spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], schema), path)
    tables.replace_days(spark.createDataFrame([(9, D(2024, 1, 2)), (8, D(2024, 1, 2))], schema), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 8, 9]
    assert [r.v for r in tables.read_interval(spark, path, D(2024, 1, 1), D(2024, 1, 1)).collect()] == [1]


def test_replaced_interval_empties_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, acq_date date"
    tables.replace_days(spark.createDataFrame([(n, D(2024, 1, n)) for n in (1, 2, 3)], schema), path)
    new = spark.createDataFrame([(9, D(2024, 1, 2)), (7, D(2024, 1, 5))], schema)
    tables.replace_interval(new, path, D(2024, 1, 1), D(2024, 1, 2))
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [3, 9]
    held = tables.held_days(spark.createDataFrame([(0, D(2024, 1, 3))], schema), path)
    assert "PartitionFilters: [isnotnull(acq_date" in held._jdf.queryExecution().executedPlan().toString()


def test_stream_checks_header_and_keeps_rejects(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "table"), str(tmp_path / "progress"), "SDN")
    feed(landing, "n.csv", line(1, 2), line(1, 2, time="bad"))
    land_new_files(*args)
    rejected = spark.read.parquet(str(tmp_path / "table-rejected")).collect()
    assert [list(r.problems) for r in rejected] == [["acq_time"]]
    text = (landing / "n.csv").read_text().replace("latitude,longitude", "longitude,latitude", 1)
    (landing / "swapped.csv").write_text(text)
    land_new_files(*args)
    got = spark.read.parquet(str(tmp_path / "table")).select("latitude", "longitude").collect()
    assert sorted(map(tuple, got)) == [(1.0, 2.0), (2.0, 1.0)]
    (landing / "short.csv").write_text(text.replace(",frp", "", 1))
    with pytest.raises(Exception, match="(?i)header"):
        land_new_files(*args)


def test_columns_are_found_by_name(spark, tmp_path):
    a = feed(tmp_path, "a.csv", line(1, 2), line(3, 4))
    other = HEADER.split(",")[::-1]
    values = dict(zip(HEADER.split(","), line(5, 6).split(",")))
    (tmp_path / "b.csv").write_text(
        ",".join([" Note", *other]) + "\r\n" + ",".join(['"x, y"', *(values[c] for c in other)]) + "\r\n\r\n"
    )
    raw = src.scan_detections(spark, [a, str(tmp_path / "b.csv")])
    assert raw.columns == HEADER.split(",")
    assert sorted((r.latitude, r.longitude, r.daynight) for r in raw.collect()) == [("1", "2", "D"), ("3", "4", "D"), ("5", "6", "D")]
    assert src.scan_detections(spark, feed(tmp_path, "c.csv")).collect() == []
    twice = feed(tmp_path, "d.csv", line(1, 2), ",".join(other), line(3, 4))
    with pytest.raises(Exception, match="more than one header"):
        src.scan_detections(spark, twice).collect()


def test_a_line_is_parsed_once_under_the_checks(spark, tmp_path, capsys):
    raw = src.scan_detections(spark, feed(tmp_path, "a.csv", line(1, 2), line(3, 4, frp="x")))
    valid, rejected = src.check_records(raw)
    for rows in (valid, rejected):
        rows.explain("extended")
        optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        # Once for the headers and once for the lines.
        assert optimized.count("from_csv(") == 2
    assert [(r.latitude, r.longitude) for r in valid.collect()] == [(1.0, 2.0)]
    assert [r.problems for r in rejected.collect()] == [["frp"]]


def test_undecodable_and_crossing_areas_are_rejected(spark):
    bow = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 3.0), (0.0, 0.0)]
    rows = [(1, bytearray(wkb([SQUARE]))), (2, bytearray(b"junk")), (3, None), (4, bytearray(wkb([bow])))]
    usable, rejected = polygons.checked_areas(spark.createDataFrame(rows, "k int, wkb binary"))
    assert [r.k for r in usable.collect()] == [1]
    assert sorted((r.k, r.problem) for r in rejected.collect()) == [(2, "empty"), (3, "empty"), (4, "crosses itself")]


def test_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "r")
    schema = "k int, v string, acq_date date"
    rows = [(1, "a", D(2024, 1, 1)), (2, "a", D(2024, 1, 2)), (3, "a", D(2024, 1, 2))]
    tables.upsert_days(spark.createDataFrame(rows, schema), path, "k")
    before = {f: os.path.getmtime(f"{path}/acq_date=2024-01-01/{f}") for f in os.listdir(f"{path}/acq_date=2024-01-01")}
    tables.upsert_days(spark.createDataFrame([(2, "b", D(2024, 1, 2)), (4, "b", D(2024, 1, 3))], schema), path, "k")
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]
    after = {f: os.path.getmtime(f"{path}/acq_date=2024-01-01/{f}") for f in os.listdir(f"{path}/acq_date=2024-01-01")}
    assert before == after
    assert tables.lookback_start(D(2024, 3, 1), 60) == D(2024, 1, 1)


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "table"), str(tmp_path / "progress"), "SDN")
    feed(landing, "n.csv", line(1, 2), line(1, 2, time="bad"))
    land_new_files(*args)
    feed(landing, "n20.csv", line(5, 6, sat="N20"), line(7, 8, day="2024-01-02", sat="N20"))
    land_new_files(*args)
    land_new_files(*args)
    rows = spark.read.parquet(str(tmp_path / "table")).collect()
    assert sorted((r.satellite, r.latitude) for r in rows) == [("N", 1.0), ("N20", 5.0), ("N20", 7.0)]


def test_audits(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 3))], "k int, acq_date date")
    assert audits.has_more_rows_than(df, 1) and not audits.has_more_rows_than(df, 2)
    with pytest.raises(audits.AuditError):
        audits.require_rows(df.limit(1), "one row")
    assert [tuple(r) for r in audits.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    missing = audits.missing_days(df, D(2024, 1, 1), D(2024, 1, 4)).collect()
    assert sorted(r.acq_date for r in missing) == [D(2024, 1, 2), D(2024, 1, 4)]


def test_table_names(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    assert "some_view" in tables.table_names(spark, "default")


def test_columnar_wkb_against_struct():
    import random

    import pyarrow as pa

    from emberscope.sources.wkb import decode, encode

    rnd = random.Random(5)

    def packed(rings, order="<", code=3, dims=2, srid=False):
        head = struct.pack(order + "BI", order == "<", code | (0x20000000 if srid else 0))
        out = head + (struct.pack(order + "I", 4326) if srid else b"") + struct.pack(order + "I", len(rings))
        for ring in rings:
            out += struct.pack(order + "I", len(ring))
            out += b"".join(struct.pack(f"{order}{dims}d", *p, *[7.0] * (dims - 2)) for p in ring)
        return out

    def polygon():
        return [[(rnd.random(), rnd.random()) for _ in range(rnd.randint(0, 5))] for _ in range(rnd.randint(0, 3))]

    values, want = [], []
    for _ in range(600):
        order = rnd.choice("<>")
        code, dims = rnd.choice([(3, 2), (1003, 3), (0x80000003, 3), (3003, 4), (0xC0000003, 4)])
        parts = [polygon() for _ in range(rnd.randint(0, 3))]
        one = packed(polygon() + [[(1.0, 2.0)]])
        value, expected = rnd.choice(
            [
                (None, None), (b"", None), (b"\x01\x03", None), (one[:-1], None), (b"\x02" + one[1:], None),
                (struct.pack("<BIdd", 1, 1, 0.0, 0.0), None), (struct.pack("<BII", 1, 6, 4_000_000_000), None),
                (struct.pack("<BII", 1, 3, 4_000_000_000), None),
                (b"".join([struct.pack(order + "BII", order == "<", 6, len(parts))] + [packed(p, "<", code, dims) for p in parts]), parts),
                *[(packed(p, order, code, dims, rnd.random() < 0.5), [p]) for p in parts],
            ]
        )
        values.append(value)
        want.append(expected)
    whole = pa.array(values, pa.binary())
    for array, expected in ((whole, want), (whole.slice(7, 200), want[7:207]), (whole.slice(0, 0), [])):
        got = decode(array).to_pylist()
        assert [g and [[[(p["x"], p["y"]) for p in r] for r in part["rings"]] for part in g] for g in got] == expected
        assert [g and [part["wkb"] for part in g] for g in got] == [x and [packed(p) for p in x] for x in expected]
        rings = [None if g is None or not g else g[0]["rings"] for g in got]
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        assert encode(pa.array(rings, kind)).to_pylist() == [x[0] if (x := g and [p["wkb"] for p in g]) else None for g in got]


def test_feature_tables_keep_what_they_reject(spark, tmp_path):
    path = str(tmp_path / "features")
    multi = struct.pack("<BII", 1, 6, 2) + wkb([SQUARE]) + wkb([OPEN])
    rows = [("SDN", "One", "Two", bytearray(multi)), ("SDN", "One", None, None), ("SDN", None, "x", bytearray(b"junk"))]
    spark.createDataFrame(rows, "GID_0 string, NAME_1 string, NAME_2 string, wkb binary").write.parquet(path)
    usable, rejected = polygons.read_areas(spark, path)
    assert [r.id for r in usable.collect()] == [hashlib.md5(wkb([SQUARE])).hexdigest()]
    assert sorted(r.problem for r in rejected.collect()) == ["empty", "empty", "ring not closed"]
    areas, bad = polygons.read_admin(spark, path, 2)
    assert [(r.gadm_2, len(r.rings)) for r in areas.collect()] == [("Two", 2)]
    assert sorted((r.gadm_2 or "", r.problem) for r in bad.collect()) == [("", "no polygon"), ("x", "no polygon")]
    none = spark.createDataFrame([], "wkb binary")
    assert [df.count() for df in polygons.checked_areas(none)] == [0, 0]
    assert [df.count() for df in polygons.read_areas(spark, None)] == [0, 0]


def test_repeated_load_replaces_its_rejects(spark, tmp_path):
    from emberscope.functions import geometry as g

    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    country = g.with_bounds(
        spark.createDataFrame([([ring],)], "rings array<array<struct<x:double,y:double>>>")
    )
    one = feed(tmp_path, "a.csv", line(1, 2), line(1, "bad"))
    other = feed(tmp_path, "b.csv", line(3, 4, day="2024-01-02"), line(1, 2, conf="z"))
    table = str(tmp_path / "raw")
    for path in (one, other, one):
        ing.load_days(spark, path, country, "SDN", table)
    rejected = spark.read.parquet(f"{table}-rejected").collect()
    assert sorted(p for r in rejected for p in r.problems) == ["confidence", "longitude"]
    assert sorted(r.latitude for r in spark.read.parquet(table).collect()) == [1.0, 3.0]
    with pytest.raises(Exception, match="bad detection record"):
        ing.load_days(spark, other, country, "SDN", table, strict=True)


def test_sides_are_not_broadcast_by_estimate(spark, tmp_path, capsys):
    """A small file of keys from which many edges are made."""
    from emberscope.workload import run

    spark.range(3000).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    found = run("self_crossing_areas", spark, str(tmp_path))
    found.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
    assert found.count() == 1000
