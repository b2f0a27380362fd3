"""Links and the export of the final tables."""

from __future__ import annotations

from base64 import b64encode
from urllib.parse import quote_plus

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import links
from emberscope.operators.islands import assign_events
from emberscope.operators.spatial import points_in_polygons
from emberscope.plans.export import export
from emberscope.session import scratch_path
from emberscope.sources.files import read_csv
from emberscope.workload.catalog import cte, query
from emberscope.workload.views import Views

cte(
    "named",
    """
    SELECT r.*, 'Tel ~ ' || CAST(firms_id % 7 AS VARCHAR) || '/x*y é' AS settlement_name, gadm_1, gadm_2
    FROM res r JOIN adm ON lon BETWEEN x1 AND x2 AND lat BETWEEN y1 AND y2""",
)

_SCRIPT = quote_plus(b64encode(links.DEFAULT_EVALSCRIPT.encode()).decode())


def _imagery(date: str, label: str, nbr: bool) -> str:
    mode = "SINGLE%23custom-index" if nbr else "SINGLE"
    script = f"&evalscript={_SCRIPT}" if nbr else ""
    return (
        "'=HYPERLINK(\"https://browser.dataspace.copernicus.eu/?zoom=16&lat=' || latitude || '&lng=' || longitude"
        f" || '&themeId=DEFAULT-THEME&fromTime=' || CAST({date} AS VARCHAR)"
        f" || 'T00%3A00%3A00.000Z&toTime=' || CAST({date} AS VARCHAR) || 'T23%3A59%3A59.999Z"
        "&datasetId=S2_L2A_CDAS&layerId=2_FALSE_COLOR&demSource3D=%22MAPZEN%22&cloudCoverage=20"
        f"&dateMode={mode}{script}\",\"{label}\")'"
    )


def _posts(keyword: str, start: str, end: str) -> str:
    return (
        f"'=HYPERLINK(\"https://x.com/search?q=' || replace(url_encode('\"' || {keyword} || '\" since:'"
        f" || CAST({start} AS VARCHAR) || ' until:' || CAST({end} AS VARCHAR)), '%2F', '/')"
        f" || '\",\"X_{keyword}\")'"
    )


def link_sql(start: str, end: str, keywords: tuple[str, ...]) -> str:
    cols = [
        f"{_imagery(f'{when}_date', f's2_{when}' + ('_nbr' if nbr else ''), nbr)}"
        f" AS link_copernicus_{when}{'_nbr' if nbr else ''}"
        for nbr in (False, True)
        for when in ("before", "after")
    ]
    cols += [f"{_posts(k, start, end)} AS link_{k}_x" for k in keywords]
    return ",\n".join(cols)


KEYWORDS = ("settlement_name", "gadm_1", "gadm_2")


def _named(v: Views) -> DataFrame:
    rows = v.sample_results().withColumn(
        "settlement_name", F.expr("concat('Tel ~ ', firms_id % 7, '/x*y é')")
    )
    return points_in_polygons(rows, v.admin_cover()).withColumnsRenamed(
        {"lon": "longitude", "lat": "latitude"}
    )


@query(
    "SCL7 SCL8 SCL9 SCL10 SCL11 SCL13 PRJ12 JOIN12",
    f"""
    SELECT firms_id, {link_sql('acq_date - 3', 'acq_date + 3', KEYWORDS)}
    FROM (SELECT *, lon AS longitude, lat AS latitude FROM named)""",
    "named",
)
def detection_links(v: Views) -> DataFrame:
    table = links.with_links(_named(v))
    return table.select("firms_id", *[c for c in table.columns if c.startswith("link_")])


@query(
    "SCL12",
    """
    SELECT firms_id, 'https://www.facebook.com/search/posts/?q=' || replace(url_encode(settlement_name), '%20', '+')
           || '&filters=' || url_encode('{"start_day":"' || CAST(acq_date AS VARCHAR) || '","end_day":"'
           || CAST(acq_date AS VARCHAR) || '"}') || '&epa=FILTERS' AS link
    FROM named""",
    "named",
)
def page_search_links(v: Views) -> DataFrame:
    url = links.page_search_sql("settlement_name", "acq_date", "acq_date")
    return _named(v).selectExpr("firms_id", f"{url} AS link")


@query(
    "PIPE10 SNK1 SNK2 SRT1 SCL13",
    f"""
    SELECT area_include_id, event_no, event_count, {link_sql('start_date - 3', 'end_date + 3', ('settlement_name',))}
    FROM (SELECT area_id AS area_include_id, event_no, min(acq_date) AS start_date, max(acq_date) AS end_date,
                 min(before_date) AS before_date, max(after_date) AS after_date,
                 'Place ' || CAST(event_no AS VARCHAR) AS settlement_name, count(*) AS event_count,
                 min(lat) AS latitude, min(lon) AS longitude
          FROM ev GROUP BY ALL)""",
    "ev",
)
def exported_events(v: Views) -> DataFrame:
    """Both tables exported with links; the events are read back."""
    numbered = assign_events(v.sample_results()).withColumnsRenamed(
        {"area_id": "area_include_id", "lon": "longitude", "lat": "latitude"}
    ).withColumn("settlement_name", F.expr("concat('Place ', event_no)"))
    events = numbered.groupBy("area_include_id", "event_no", "settlement_name").agg(
        F.min("acq_date").alias("start_date"),
        F.max("acq_date").alias("end_date"),
        F.min("before_date").alias("before_date"),
        F.max("after_date").alias("after_date"),
        F.count("*").alias("event_count"),
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
    )
    path = scratch_path(v.spark, "export")
    export(numbered, events, path, add_links=True)
    written = links.with_links(events)
    back = read_csv(v.spark, f"{path}/output_clustered", written.schema)
    return back.select(
        "area_include_id", "event_no", "event_count",
        *[c for c in back.columns if c.startswith("link_")],
    )
