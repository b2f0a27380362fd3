"""Links and scalar functions against the Python standard library."""

import datetime
import json
import random
from base64 import b64encode
from urllib.parse import quote, urlencode

import pytest

from emberscope.config import Config
from emberscope.functions import links, scalars

KEYWORDS = ["Utrecht", "El Fasher", "a/b~c*d", "100% 'sure' & \"x\"", "الخرطوم", "tab\tplus+"]
D = datetime.date(2025, 4, 29)


def imagery(lat, lon, date, nbr=False):
    params = {
        "zoom": 16, "lat": lat, "lng": lon, "themeId": "DEFAULT-THEME",
        "fromTime": f"{date}T00:00:00.000Z", "toTime": f"{date}T23:59:59.999Z",
        "datasetId": "S2_L2A_CDAS", "layerId": "2_FALSE_COLOR", "demSource3D": '"MAPZEN"',
        "cloudCoverage": 20, "dateMode": "SINGLE#custom-index" if nbr else "SINGLE",
    }
    if nbr:
        params["evalscript"] = b64encode(links.DEFAULT_EVALSCRIPT.encode()).decode()
    return "https://browser.dataspace.copernicus.eu/?" + urlencode(params)


def test_encodings(spark):
    df = spark.createDataFrame([(k,) for k in KEYWORDS], "k string")
    for r in df.selectExpr("k", f"{links.form_encoded_sql('k')} AS f", f"{links.path_encoded_sql('k')} AS p").collect():
        assert r.f == urlencode({"k": r.k})[2:]
        assert r.p == quote(r.k)


def test_float_text(spark):
    values = [0.0, -0.0, 12.19528, -29.26756, 100.0, 0.001, 0.00012, -0.00012345, 1.5e-5, 1e-5, 1e7, 12345678.25, 1e16, 1 / 3]
    rng = random.Random(4)
    values += [round(rng.uniform(-180, 180), rng.choice((3, 5, 14))) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.selectExpr(scalars.python_float_text("v")).collect()]
    assert got == [repr(v) for v in values]


def test_float_text_of_huge_values_reads_back(spark):
    # Java before 19 may write a digit more than needed here: the value is kept.
    values = [1.25e22, 2e23, 8.41e21, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.selectExpr(scalars.python_float_text("v")).collect()]
    assert [float(t) for t in got] == values
    assert all("e+" in t or "e-" in t for t in got)


def test_links(spark):
    rows = [(1, 12.19528, 29.26756, D, D, D, k, "North", None) for k in KEYWORDS] + [(2, 1.5, 2.0, D, None, D, None, "x", "y")]
    df = spark.createDataFrame(
        rows,
        "firms_id int, latitude double, longitude double, acq_date date, before_date date, after_date date,"
        " settlement_name string, gadm_1 string, gadm_2 string",
    )
    got = links.with_links(df).collect()
    assert len(got) == len(rows)  # equal ids do not multiply
    start, end = D - datetime.timedelta(days=3), D + datetime.timedelta(days=3)
    for r in got:
        for when, day in (("before", r.before_date), ("after", r.after_date)):
            for nbr in (False, True):
                name, tail = f"link_copernicus_{when}", "_nbr" if nbr else ""
                want = day and f'=HYPERLINK("{imagery(r.latitude, r.longitude, day, nbr)}","s2_{when}{tail}")'
                assert r[name + tail] == want
        for c in ("settlement_name", "gadm_1", "gadm_2"):
            search = quote(f'"{r[c]}" since:{start} until:{end}')
            assert r[f"link_{c}_x"] == (r[c] and f'=HYPERLINK("https://x.com/search?q={search}","X_{c}")')


def test_event_dates_win_over_acquisition(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, D, None, D, D, "k")],
        "latitude double, longitude double, start_date date, end_date date, before_date date, after_date date, settlement_name string",
    ).withColumn("acq_date", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(datetime.date(2025, 1, 1)))
    (r,) = links.with_links(df).collect()
    assert quote("since:2025-04-26 until:2025-01-04") in r.link_settlement_name_x


def test_page_search(spark):
    df = spark.createDataFrame([("a b", D)], "k string, d date")
    (r,) = df.selectExpr(f"{links.page_search_sql('k', 'd', 'd')} AS u").collect()
    filters = json.dumps({"start_day": str(D), "end_day": str(D)}, separators=(",", ":"))
    assert r.u == "https://www.facebook.com/search/posts/?" + urlencode({"q": "a b", "filters": filters, "epa": "FILTERS"})


def test_times(spark):
    values = ["0", "5", "59", "60", "159", "2359", "2400", "1260", "12:3", "", None, "12345", " 730"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(scalars.hhmm_minutes("t")).collect()]
    assert got == [0, 5, 59, None, 119, 1439, None, None, None, None, None, None, 450]
    ints = spark.createDataFrame([(0,), (730,), (2359,)], "t int")
    assert [r[0] for r in ints.select(scalars.hhmm_minutes("t")).collect()] == [0, 450, 1439]


def test_ids_and_defaults(spark):
    df = spark.createDataFrame([(1.5, 2.25, "7", "x")], "lat double, lon double, a string, b string")
    (r,) = df.select(
        scalars.position_id("lat", "lon").alias("i"),
        scalars.expect_type("a", "INT", "0").alias("a"),
        scalars.expect_type("b", "INT", "0").alias("b"),
    ).collect()
    import hashlib

    assert r.i == hashlib.md5(b"1.500002.25000").hexdigest()
    assert (r.a, r.b) == (7, 0)


def test_config_checks():
    assert Config("SDN", gadm_level=2).admin_columns == ["gadm_1", "gadm_2"]
    for bad in ({"country_id": ""}, {"country_id": "SDN", "gadm_level": 4}, {"country_id": "SDN", "retry_ages_days": (16, 11)}):
        with pytest.raises(ValueError):
            Config(**bad)
