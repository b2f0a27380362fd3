"""Numbering, events and their measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.operators.extent import event_extent
from emberscope.operators.islands import assign_events, date_islands
from emberscope.operators.numbering import number_rows, number_rows_per_interval
from emberscope.operators.pairs import extent_across_areas, extent_within
from emberscope.plans import events as ev
from emberscope.session import cut_lineage
from emberscope.streaming.arrivals import session_events
from emberscope.workload.catalog import haversine, query
from emberscope.workload.views import Views

MEASURES = """
       min(acq_date) AS start_date, max(acq_date) AS end_date,
       round(avg(CAST(burn_scar_detected AS INTEGER)), 6) AS burn_scar_detected,
       round(avg(burnt_pixel_count), 6) AS burnt_pixel_count,
       round(avg(burnt_building_count), 6) AS burnt_building_count,
       round(avg(CAST(no_data AS INTEGER)), 6) AS no_data,
       round(avg(CAST(too_cloudy AS INTEGER)), 6) AS too_cloudy,
       count(*) AS event_count"""

MODES = """
    SELECT area_id, event_no,
           max(before_date) FILTER (WHERE what = 'b') AS before_date,
           max(before_date) FILTER (WHERE what = 'a') AS after_date
    FROM (SELECT *, row_number() OVER (PARTITION BY area_id, event_no, what
                                       ORDER BY n DESC, before_date) AS rn
          FROM (SELECT area_id, event_no, 'b' AS what, before_date, count(*) AS n
                FROM {ev} WHERE before_date IS NOT NULL GROUP BY ALL
                UNION ALL
                SELECT area_id, event_no, 'a', after_date, count(*)
                FROM {ev} WHERE after_date IS NOT NULL GROUP BY ALL))
    WHERE rn = 1 GROUP BY ALL"""

CENTRES = """
    SELECT area_id, event_no, avg(lon) AS lon, avg(lat) AS lat
    FROM (SELECT DISTINCT area_id, event_no, lon, lat FROM {ev}) GROUP BY ALL"""


def farthest(ev_name: str, condition: str = "a.area_id = b.area_id", swap: bool = False) -> str:
    d = haversine("a.lat", "a.lon", "b.lat", "b.lon") if swap else haversine(
        "a.lon", "a.lat", "b.lon", "b.lat"
    )
    return f"""
    SELECT a.area_id, a.event_no, max({d}) AS d
    FROM {ev_name} a JOIN {ev_name} b
      ON {condition} AND a.event_no = b.event_no AND a.firms_id < b.firms_id
    GROUP BY ALL"""


ROUNDED_CENTRE = "round(c.lon, 6) AS lon, round(c.lat, 6) AS lat"


def event_sql(ev_name: str, centre: str = ROUNDED_CENTRE) -> str:
    """Event table over a view of numbered detections."""
    return f"""
    SELECT m.*, before_date, after_date, {centre},
           round(coalesce(d, 0.0), 3) AS max_distance
    FROM (SELECT area_id, event_no, {MEASURES} FROM {ev_name} GROUP BY ALL) m
    JOIN ({CENTRES.format(ev=ev_name)}) c USING (area_id, event_no)
    LEFT JOIN ({MODES.format(ev=ev_name)}) t USING (area_id, event_no)
    LEFT JOIN ({farthest(ev_name)}) f USING (area_id, event_no)"""


def rounded_events(events: DataFrame) -> DataFrame:
    shares = (
        "burn_scar_detected",
        "burnt_pixel_count",
        "burnt_building_count",
        "no_data",
        "too_cloudy",
        "lon",
        "lat",
    )
    return events.withColumns(
        {**{c: F.round(c, 6) for c in shares}, "max_distance": F.round("max_distance", 3)}
    )


@query(
    "WIN2 WIN3 AGG1 AGG2 PRJ6 PRJ8 PRJ10 SCL2",
    f"SELECT area_id, event_no, {MEASURES} FROM ev GROUP BY ALL",
    "ev",
)
def events_per_area(v: Views) -> DataFrame:
    numbered = assign_events(v.sample_results())
    measures = numbered.groupBy("area_id", "event_no").agg(
        F.min("acq_date").alias("start_date"),
        F.max("acq_date").alias("end_date"),
        F.round(F.avg(F.col("burn_scar_detected").cast("int")), 6).alias("burn_scar_detected"),
        F.round(F.avg("burnt_pixel_count"), 6).alias("burnt_pixel_count"),
        F.round(F.avg("burnt_building_count"), 6).alias("burnt_building_count"),
        F.round(F.avg(F.col("no_data").cast("int")), 6).alias("no_data"),
        F.round(F.avg(F.col("too_cloudy").cast("int")), 6).alias("too_cloudy"),
        F.count("*").alias("event_count"),
    )
    return measures


@query("PIPE6 JOIN7 JOIN10 AGG3 AGG4 AGG5 GEO6 GEO8 PRJ9", event_sql("ev"), "ev")
def event_table(v: Views) -> DataFrame:
    return rounded_events(ev.cluster_events(cut_lineage(v.sample_results())))


@query(
    "WIN2 WIN3",
    """
    SELECT DISTINCT area_id, acq_date, event_no FROM ev""",
    "ev",
)
def event_days(v: Views) -> DataFrame:
    return date_islands(v.in_areas()).select("area_id", "acq_date", "event_no")


@query(
    "GEO6 AGG5 JOIN7",
    f"""
    SELECT k.area_id, k.event_no, round(coalesce(d, 0.0), 3) AS max_distance
    FROM (SELECT DISTINCT area_id, event_no FROM ev) k
    LEFT JOIN ({farthest('ev', swap=True)}) f USING (area_id, event_no)""",
    "ev",
)
def event_extents_swapped_axes(v: Views) -> DataFrame:
    """Great-circle metres with latitude and longitude read in swapped order."""
    numbered = assign_events(v.in_areas())
    return event_extent(numbered, ev.EVENT_KEYS, axis_order="latlon").withColumn(
        "max_distance", F.round("max_distance", 3)
    )


@query(
    "JOIN7 GEO5 AGG5",
    f"""
    SELECT k.area_id, k.event_no, round(coalesce(max(d), 0.0), 3) AS max_distance
    FROM (SELECT DISTINCT area_id, event_no FROM wide_ev) k
    LEFT JOIN (SELECT a.area_id, a.event_no, {haversine('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS d
               FROM wide_ev a JOIN wide_ev b ON a.area_id = b.area_id AND a.event_no = b.event_no
                AND a.firms_id < b.firms_id) f
      ON f.area_id = k.area_id AND f.event_no = k.event_no AND d <= 4000
    GROUP BY ALL""",
    "wide_ev",
)
def event_extents_below_cutoff(v: Views) -> DataFrame:
    """Only pairs up to 4 km apart count; wide gaps give events with many detections."""
    numbered = assign_events(v.in_areas(), max_gap=30)
    return extent_within(numbered, ev.EVENT_KEYS, 4000.0).selectExpr(
        "area_id", "event_no", "round(coalesce(max_distance, 0D), 3) AS max_distance"
    )


@query(
    "JOIN7 AGG5",
    f"""
    SELECT area_id, event_no, round(d, 3) AS max_distance
    FROM ({farthest('ev', 'true')})""",
    "ev",
)
def event_extents_across_areas(v: Views) -> DataFrame:
    """Pairs share the event number only; a pair counts for the smaller id's area."""
    numbered = cut_lineage(assign_events(v.in_areas()))
    return extent_across_areas(numbered).withColumn("max_distance", F.round("max_distance", 3))


@query(
    "WIN1 PIPE2 PRJ1",
    """
    SELECT CAST(row_number() OVER (ORDER BY acq_date, acq_time, lon, lat, firms_id) AS BIGINT) AS id,
           firms_id, acq_date, lon, lat FROM det""",
    "det",
)
def detection_numbers(v: Views) -> DataFrame:
    rows = v.detections().select("firms_id", "acq_date", "acq_time", "lon", "lat")
    return number_rows(rows, tie_breakers=["firms_id"]).select(
        "id", "firms_id", "acq_date", "lon", "lat"
    )


@query(
    "WIN1",
    """
    SELECT CAST(row_number() OVER (PARTITION BY acq_date
                  ORDER BY acq_time, lon, lat, firms_id) AS BIGINT) AS id, firms_id FROM det""",
    "det",
)
def detection_numbers_per_load(v: Views) -> DataFrame:
    rows = v.detections().select("firms_id", "acq_date", "acq_time", "lon", "lat")
    return number_rows_per_interval(rows, tie_breakers=["firms_id"]).select("id", "firms_id")


@query(
    "JOIN3",
    """
    SELECT h.firms_id, h.area_id, e.event_no FROM hits h
    JOIN (SELECT area_id, event_no, min(acq_date) AS s, max(acq_date) AS e FROM ev GROUP BY ALL) e
      ON h.area_id = e.area_id AND h.acq_date >= e.s AND h.acq_date <= e.e""",
    "hits ev",
)
def detections_on_event_dates(v: Views) -> DataFrame:
    hits = v.in_areas()
    spans = assign_events(hits).groupBy("area_id", "event_no").agg(
        F.min("acq_date").alias("start_date"), F.max("acq_date").alias("end_date")
    )
    return ev.on_event_days(hits, spans).select("firms_id", "area_id", "event_no")


@query(
    "INC6 WIN3",
    """
    SELECT area_id, min(acq_date) AS start_date, max(acq_date) AS end_date, count(*) AS event_count
    FROM ev GROUP BY area_id, event_no""",
    "ev",
)
def session_window_events(v: Views) -> DataFrame:
    return session_events(v.in_areas())
