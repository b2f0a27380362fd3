"""Files in and out, record checks, incremental loads, audits."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import scalars
from emberscope.operators import audits
from emberscope.plans import ingest as ing
from emberscope.session import scratch_path
from emberscope.sources import detections as src
from emberscope.sources import files, places, tables, versions
from emberscope.streaming.arrivals import land_new_files
from emberscope.workload.catalog import cte, query
from emberscope.workload.views import AS_OF, Views

cte(
    "raw",
    """
    SELECT 'XXX' AS country_id, lat AS latitude, lon AS longitude, scan, track, acq_date,
           acq_time // 100 * 60 + acq_time % 100 AS acq_time, satellite, 'VIIRS' AS instrument,
           '2.0NRT' AS version, frp, daynight, bright_ti4, bright_ti5, confidence FROM det""",
)
RAW = "SELECT * REPLACE (CAST(acq_time AS INTEGER) AS acq_time) FROM raw"


def _write_feed(v: Views, label: str, feed: DataFrame | None = None) -> str:
    """Feed files, one folder per satellite, in the shared scratch folder."""
    folder = scratch_path(v.spark, label)
    (v.feed() if feed is None else feed).withColumn("platform", F.col("satellite")).write.partitionBy("platform").option(
        "header", True
    ).csv(folder)
    return folder


def _feed_paths(v: Views, label: str) -> list[str]:
    folder = _write_feed(v, label)
    return [f"{folder}/platform={s}" for s in ("N", "N20", "N21")]


@query("SRC1 SRC2 FLT5 PRJ5 PRJ7", RAW, "raw")
def scanned_detection_files(v: Views) -> DataFrame:
    valid, _ = src.check_records(src.scan_detections(v.spark, _feed_paths(v, "feed")))
    return src.to_raw_table(valid, "XXX")


def _mixed_feed(v: Views, label: str) -> list[str]:
    """Feed files of one satellite each: in the feed's order, turned round, and with a column more."""
    feed, folder = v.feed(), scratch_path(v.spark, label)
    orders = {"N": feed.columns, "N20": feed.columns[::-1], "N21": ["track", "extra", *sorted(set(feed.columns) - {"track"})]}
    for satellite, columns in orders.items():
        rows = feed.filter(F.col("satellite") == satellite).withColumn("extra", F.lit('a, "b"'))
        rows.select(*columns).write.option("header", True).csv(f"{folder}/{satellite}")
    return [f"{folder}/{satellite}" for satellite in orders]


@query("SRC1 SRC2", RAW, "raw")
def scanned_mixed_headers(v: Views) -> DataFrame:
    valid, _ = src.check_records(src.scan_detections(v.spark, _mixed_feed(v, "mixed")))
    return src.to_raw_table(valid, "XXX")


@query("SRC1 INC6", RAW, "raw")
def streamed_mixed_headers(v: Views) -> DataFrame:
    landing, base = _mixed_feed(v, "mixed")[0].rpartition("/")[0], scratch_path(v.spark, "stream")
    land_new_files(v.spark, landing, f"{base}/table", f"{base}/progress", "XXX")
    return v.spark.read.parquet(f"{base}/table").select(*src.RAW_DETECTION_COLUMNS)


@query(
    "PIPE1 GEO2",
    RAW + " WHERE longitude > 20 AND longitude < 30 AND latitude > 0 AND latitude < 15",
    "raw",
)
def ingested_country(v: Views) -> DataFrame:
    raw, _ = ing.ingest(v.spark, _feed_paths(v, "feed"), v.admin(2), "XXX", cell_deg=0.5)
    return raw


@query("INC6 INC1", RAW, "raw")
def streamed_arrivals(v: Views) -> DataFrame:
    landing, base = _write_feed(v, "landing"), scratch_path(v.spark, "stream")
    land_new_files(v.spark, landing, f"{base}/table", f"{base}/progress", "XXX")
    return v.spark.read.parquet(f"{base}/table").select(*src.RAW_DETECTION_COLUMNS)


@query(
    "INC6 GEO2",
    RAW + " WHERE longitude > 20 AND longitude < 30 AND latitude > 0 AND latitude < 15",
    "raw",
)
def streamed_arrivals_in_country(v: Views) -> DataFrame:
    landing, base = _write_feed(v, "landing"), scratch_path(v.spark, "stream")
    land_new_files(v.spark, landing, f"{base}/table", f"{base}/progress", "XXX", admin=v.admin(2), cell_deg=0.5)
    return v.spark.read.parquet(f"{base}/table").select(*src.RAW_DETECTION_COLUMNS)


@query(
    "FLT5 PIPE1 INC1",
    """
    SELECT kind, count(*) AS n_records FROM (
      SELECT 'frp' AS kind FROM det WHERE firms_id % 19 = 0 UNION ALL
      SELECT CAST(acq_date AS VARCHAR) FROM det
      WHERE firms_id % 19 != 0 AND lon > 20 AND lon < 30 AND lat > 0 AND lat < 15)
    GROUP BY kind""",
    "det",
)
def repeated_load(v: Views) -> DataFrame:
    """A load run twice: its days and its rejected records are there once."""
    damaged = v.detections().withColumn("frp", F.expr("IF(firms_id % 19 = 0, 'strong', CAST(frp AS STRING))"))
    feed = damaged.withColumnsRenamed({"lat": "latitude", "lon": "longitude"}).select(*v.feed().columns)
    folder, table = _write_feed(v, "feed", feed), scratch_path(v.spark, "raw")
    paths = [f"{folder}/platform={s}" for s in ("N", "N20", "N21")]
    for _ in range(2):
        ing.load_days(v.spark, paths, v.admin(2), "XXX", table)
    kept = v.spark.read.parquet(table).select(F.col("acq_date").cast("string").alias("kind"))
    rejected = v.spark.read.parquet(f"{table}-rejected").select(F.explode("problems").alias("kind"))
    return kept.unionByName(rejected).groupBy("kind").agg(F.count("*").alias("n_records"))


@query(
    "FLT5 FLT6",
    """
    SELECT problem, count(*) AS n_records FROM (
      SELECT 'acq_time' AS problem FROM det WHERE firms_id % 13 = 0 UNION ALL
      SELECT 'satellite' FROM det WHERE firms_id % 17 = 0 UNION ALL
      SELECT 'frp' FROM det WHERE firms_id % 19 = 0 UNION ALL
      SELECT 'none' FROM det WHERE firms_id % 13 != 0 AND firms_id % 17 != 0 AND firms_id % 19 != 0)
    GROUP BY problem""",
    "det",
)
def rejected_records(v: Views) -> DataFrame:
    damaged = v.detections().selectExpr(
        "lat AS latitude", "lon AS longitude", "bright_ti4", "scan", "track", "acq_date",
        "IF(firms_id % 13 = 0, '2460', CAST(acq_time AS STRING)) AS acq_time",
        "IF(firms_id % 17 = 0, 'X', satellite) AS satellite",
        "instrument", "confidence", "version", "bright_ti5",
        "IF(firms_id % 19 = 0, 'strong', CAST(frp AS STRING)) AS frp", "daynight",
    )
    text = damaged.select(*[F.col(c).cast("string").alias(c) for c in damaged.columns])
    valid, rejected = src.check_records(text)
    return (
        rejected.select(F.explode("problems").alias("problem"))
        .unionByName(valid.select(F.lit("none").alias("problem")))
        .groupBy("problem")
        .agg(F.count("*").alias("n_records"))
    )


@query(
    "FLT8",
    "SELECT DISTINCT latitude, longitude, acq_date, CAST(acq_time AS INTEGER) AS acq_time FROM raw",
    "raw",
)
def distinct_detection_records(v: Views) -> DataFrame:
    feed = v.feed().withColumn("acq_time", scalars.hhmm_minutes("acq_time"))
    return src.distinct_records(feed.unionByName(feed)).select(
        "latitude", "longitude", "acq_date", "acq_time"
    )


@query(
    "PRJ7",
    "SELECT firms_id, acq_time, CAST(acq_time // 100 * 60 + acq_time % 100 AS INTEGER) AS minutes FROM det",
    "det",
)
def acquisition_minutes(v: Views) -> DataFrame:
    return v.detections().select(
        "firms_id", "acq_time", scalars.hhmm_minutes("acq_time").alias("minutes")
    )


@query("SRC3", "SELECT name, plon AS lon, plat AS lat FROM places", "places")
def scanned_settlement_dump(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "settlements")
    dump = v.settlements().selectExpr(
        "1 AS geonameid", "name", "name AS asciiname", "'a,b' AS alternatenames",
        "lat AS latitude", "lon AS longitude", "'P' AS feature_class", "'PPL' AS feature_code",
        "'XX' AS country_code", "'' AS cc2", "'' AS a1", "'' AS a2", "'' AS a3", "'' AS a4",
        "0 AS population", "'' AS elevation", "'1' AS dem", "'UTC' AS timezone", "'2024-01-01' AS d",
    )
    dump.write.option("sep", "\t").option("quote", "").csv(path)
    return places.scan_settlements(v.spark, path)


@query(
    "JOIN14",
    """
    SELECT c_custkey, printf('C%02d', c_nationkey) AS country_id,
           CASE WHEN c_nationkey % 4 != 0 THEN printf('%02d', c_nationkey) END AS country_iso2
    FROM customer""",
)
def country_codes(v: Views) -> DataFrame:
    rows = v.table("customer").selectExpr("c_custkey", "format_string('C%02d', c_nationkey) AS country_id")
    return places.with_alpha2(rows, _codes(v))


def _codes(v: Views) -> DataFrame:
    return v.table("nation").filter("n_nationkey % 4 != 0").selectExpr(
        "format_string('C%02d', n_nationkey) AS alpha3", "format_string('%02d', n_nationkey) AS alpha2"
    )


@query(
    "JOIN14",
    """
    SELECT printf('C%02d', c_nationkey) AS country_id, count(*) AS n_rows
    FROM customer WHERE c_nationkey % 4 = 0 GROUP BY ALL""",
)
def unknown_country_codes(v: Views) -> DataFrame:
    rows = v.table("customer").selectExpr("format_string('C%02d', c_nationkey) AS country_id")
    return places.unknown_codes(rows, _codes(v))


@query(
    "INC1 INC3 INC5",
    """
    SELECT acq_date, count(*) AS n_rows, round(sum(CASE WHEN acq_date >= DATE '2024-01-15' THEN frp ELSE 0 END), 4) AS frp
    FROM raw WHERE acq_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY acq_date""",
    "raw",
)
def replaced_days(v: Views) -> DataFrame:
    """A first load with empty power values, of which the later days are replaced."""
    path = scratch_path(v.spark, "days")
    feed = v.feed()
    tables.replace_days(feed.withColumn("frp", F.lit(0.0)), path)
    tables.replace_days(feed.filter("acq_date >= '2024-01-15'"), path)
    stored = tables.read_interval(
        v.spark, path, datetime.date(2024, 1, 10), datetime.date(2024, 1, 20)
    )
    return stored.groupBy("acq_date").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("frp"), 4).alias("frp")
    )


@query(
    "INC1 INC5",
    """
    SELECT acq_date, count(*) AS n_rows, round(sum(CASE WHEN acq_date < DATE '2024-01-15' THEN 0 ELSE frp END), 4) AS frp
    FROM det WHERE acq_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND acq_date != DATE '2024-01-17'
    GROUP BY acq_date""",
    "det",
)
def replaced_days_with_an_empty_day(v: Views) -> DataFrame:
    """A second load of some days, one of them without records, shows in one step."""
    path = scratch_path(v.spark, "versions")
    feed = v.feed()
    versions.replace_days(feed.withColumn("frp", F.lit(0.0)), path)
    again = feed.filter("acq_date >= '2024-01-15' AND acq_date != '2024-01-17'")
    versions.replace_days(again, path, (datetime.date(2024, 1, 15), AS_OF))
    stored = versions.read_table(v.spark, path, datetime.date(2024, 1, 10), datetime.date(2024, 1, 20))
    return stored.groupBy("acq_date").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("frp"), 4).alias("frp")
    )


@query(
    "INC5 SRC5",
    """
    SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS area_id,
           (200005 + 1000 * (c_custkey % 100)) / CAST(10000 AS DOUBLE) AS xmin
    FROM customer WHERE c_custkey % 3 = 0""",
)
def refreshed_polygons(v: Views) -> DataFrame:
    """A full refresh: the second set of areas takes the place of the first."""
    path = scratch_path(v.spark, "areas")
    versions.refresh(v.areas(), path)
    versions.refresh(v.areas().filter("CAST(substring(area_id, 2) AS BIGINT) % 3 = 0"), path)
    return versions.read_table(v.spark, path).select("area_id", "xmin")


@query(
    "INC2 INC3",
    """
    SELECT firms_id, acq_date, CASE WHEN firms_id % 4 = 0 AND acq_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'
                               THEN 1 ELSE 0 END AS validation_try FROM res""",
    "res",
)
def upserted_results(v: Views) -> DataFrame:
    """A second run over the look-back window replaces the rows it has results for."""
    path = scratch_path(v.spark, "results")
    first = v.sample_results().select("firms_id", "acq_date", F.lit(0).alias("validation_try"))
    tables.upsert_days(first, path, "firms_id")
    end = datetime.date(2024, 1, 25)
    start = tables.lookback_start(end, 15)
    again = first.filter(F.col("acq_date").between(F.lit(start), F.lit(end))).filter("firms_id % 4 = 0")
    tables.upsert_days(again.withColumn("validation_try", F.lit(1)), path, "firms_id")
    return v.spark.read.parquet(path).select(*first.columns)


@query(
    "INC4",
    """
    SELECT CAST(d AS DATE) AS acq_date
    FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) t(d)
    WHERE CAST(d AS DATE) NOT IN (SELECT acq_date FROM det WHERE day(acq_date) % 5 != 0)""",
    "det",
)
def days_without_detections(v: Views) -> DataFrame:
    held = v.detections().filter("day(acq_date) % 5 != 0")
    return audits.missing_days(held, datetime.date(2024, 1, 1), AS_OF)


@query(
    "AUD2",
    "SELECT lon, lat, acq_date, count(*) AS n_rows FROM det GROUP BY ALL HAVING count(*) > 1",
    "det",
)
def duplicate_grain(v: Views) -> DataFrame:
    return audits.duplicate_keys(v.detections(), ["lon", "lat", "acq_date"])


@query(
    "AUD1",
    """
    SELECT 'detections' AS name, (SELECT count(*) FROM det) > 1 AS passed
    UNION ALL SELECT 'areas', (SELECT count(*) FROM customer) > 1
    UNION ALL SELECT 'nothing', false""",
    "det",
)
def row_count_audits(v: Views) -> DataFrame:
    checked = {
        "detections": v.detections(),
        "areas": v.areas(),
        "nothing": v.detections().filter("firms_id < 0"),
    }
    rows = [(name, audits.has_more_rows_than(df)) for name, df in checked.items()]
    return v.spark.createDataFrame(rows, "name string, passed boolean")


@query(
    "PIPE2 WIN1 FLT8",
    """
    SELECT acq_date, count(*) AS n_rows, count(DISTINCT (acq_time, longitude, latitude, satellite)) AS n_ids
    FROM raw GROUP BY acq_date""",
    "raw",
)
def stable_detection_ids(v: Views) -> DataFrame:
    """Hash ids: as many as there are distinct records."""
    feed = v.feed().withColumn("acq_time", scalars.hhmm_minutes("acq_time"))
    table = ing.detection_table(feed, datetime.date(2024, 1, 1), AS_OF)
    return table.groupBy("acq_date").agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids")
    )


@query(
    "SNK4",
    "SELECT firms_id, acq_date, lon, lat, satellite, frp FROM det",
    "det",
)
def json_round_trip(v: Views) -> DataFrame:
    rows = v.detections().select("firms_id", "acq_date", "lon", "lat", "satellite", "frp")
    path = scratch_path(v.spark, "json")
    files.write_json(files.serialize(rows), path)
    return files.deserialize(v.spark.read.schema("record string").json(path), rows.schema)


@query(
    "SNK3 SNK1 SRC11",
    "SELECT firms_id, acq_date, lon, lat, frp FROM det",
    "det",
)
def parquet_and_csv_round_trip(v: Views) -> DataFrame:
    """Half of the rows through Parquet by day, the other half through CSV."""
    rows = v.detections().select("firms_id", "acq_date", "lon", "lat", "frp")
    parquet, csv = scratch_path(v.spark, "parquet"), scratch_path(v.spark, "csv")
    files.write_parquet(rows.filter("firms_id % 2 = 0"), parquet)
    files.write_csv(rows.filter("firms_id % 2 = 1"), csv, ["acq_date", "firms_id"])
    return (
        v.spark.read.parquet(parquet)
        .select(*rows.columns)
        .unionByName(files.read_csv(v.spark, csv, rows.schema))
    )


@query(
    "FLT6",
    """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0
                          ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k FROM events""",
)
def values_or_default(v: Views) -> DataFrame:
    text = v.table("events").selectExpr(
        "event_id", "IF(event_id % 10 = 0, 'none', regexp_extract(props, '[0-9]+', 0)) AS k"
    )
    return text.select("event_id", scalars.expect_type("k", "BIGINT", "0L").alias("k"))
