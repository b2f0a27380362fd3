"""Search and imagery links as string columns."""

from __future__ import annotations

from base64 import b64encode
from urllib.parse import quote_plus

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.functions.scalars import python_float_text

# Addresses, parameter names and constants of the links (fixed values).
IMAGERY_BASE = "https://browser.dataspace.copernicus.eu/?"
IMAGERY_ZOOM = "16"
IMAGERY_THEME = "DEFAULT-THEME"
IMAGERY_DATASET = "S2_L2A_CDAS"
IMAGERY_LAYER = "2_FALSE_COLOR"
IMAGERY_DEM = '"MAPZEN"'
IMAGERY_CLOUDS = "20"
DATE_MODE = "SINGLE"
DATE_MODE_CUSTOM = "SINGLE#custom-index"
POST_SEARCH_BASE = "https://x.com/search?q="
PAGE_SEARCH_BASE = "https://www.facebook.com/search/posts/?"

# Script the imagery browser runs for the burn-ratio view; any script may be given.
DEFAULT_EVALSCRIPT = """//VERSION=3
function setup() {
  return { input: ["B08", "B12"], output: { bands: 1 } };
}
function evaluatePixel(s) {
  return [(s.B08 - s.B12) / (s.B08 + s.B12)];
}
"""


def form_encoded_sql(value: str) -> str:
    """Query-string encoding: space to plus, tilde kept, asterisk escaped."""
    return f"replace(replace(url_encode({value}), '%7E', '~'), '*', '%2A')"


def path_encoded_sql(value: str) -> str:
    """Path encoding: space to %20 and slashes kept."""
    return f"replace(replace({form_encoded_sql(value)}, '+', '%20'), '%2F', '/')"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def imagery_link_sql(
    lat: str, lon: str, date: str, nbr: bool = False, evalscript: str = DEFAULT_EVALSCRIPT
) -> str:
    """Imagery browser address for one place and day; null date gives null."""
    day = f"CAST({date} AS STRING)"
    midnight, day_end = quote_plus("T00:00:00.000Z"), quote_plus("T23:59:59.999Z")
    tail = (
        f"&datasetId={IMAGERY_DATASET}&layerId={IMAGERY_LAYER}"
        f"&demSource3D={quote_plus(IMAGERY_DEM)}&cloudCoverage={IMAGERY_CLOUDS}"
        f"&dateMode={quote_plus(DATE_MODE_CUSTOM if nbr else DATE_MODE)}"
    )
    if nbr:
        script = b64encode(evalscript.encode()).decode()
        tail += f"&evalscript={quote_plus(script)}"
    return (
        f"concat({_text(f'{IMAGERY_BASE}zoom={IMAGERY_ZOOM}&lat=')}, {python_float_text(lat)},"
        f" '&lng=', {python_float_text(lon)}, '&themeId={IMAGERY_THEME}&fromTime=', {day},"
        f" {_text(midnight + '&toTime=')}, {day}, {_text(day_end + tail)})"
    )


def post_search_sql(keyword: str, start: str, end: str) -> str:
    """Post search for a quoted keyword between two days."""
    query = (
        f"concat('\"', {keyword}, '\" since:', CAST({start} AS STRING),"
        f" ' until:', CAST({end} AS STRING))"
    )
    return f"concat('{POST_SEARCH_BASE}', {path_encoded_sql(query)})"


def page_search_sql(keyword: str, start: str, end: str) -> str:
    """Page search with the day filters as a JSON object."""
    filters = (
        f"to_json(named_struct('start_day', CAST({start} AS STRING),"
        f" 'end_day', CAST({end} AS STRING)))"
    )
    return (
        f"concat('{PAGE_SEARCH_BASE}q=', {form_encoded_sql(keyword)},"
        f" '&filters=', {form_encoded_sql(filters)}, '&epa=FILTERS')"
    )


def sheet_link_sql(url: str, label: str) -> str:
    """Spreadsheet formula showing ``label`` for an address."""
    return f"concat('=HYPERLINK(\"', {url}, '\",\"{label}\")')"


def keyword_columns(columns: list[str]) -> list[str]:
    """Settlement name and every administrative name present."""
    return ["settlement_name"] + [c for c in columns if c.startswith("gadm_")]


def with_links(
    table: DataFrame,
    keywords: list[str] | None = None,
    date_buffer_days: int = 3,
    evalscript: str = DEFAULT_EVALSCRIPT,
) -> DataFrame:
    """Add four imagery links and one post search per keyword column.

    The search runs from ``date_buffer_days`` before the start to as many after
    the end; rows without start or end date use their acquisition date. A missing
    date or keyword leaves that link null. Links are computed in place, so rows
    sharing an id do not multiply.
    """
    columns = set(table.columns)
    keywords = keyword_columns(table.columns) if keywords is None else keywords

    def first_of(*names: str) -> str:
        present = [n for n in names if n in columns]
        return present[0] if len(present) == 1 else f"coalesce({', '.join(present)})"

    start = f"date_sub({first_of('start_date', 'acq_date')}, {date_buffer_days})"
    end = f"date_add({first_of('end_date', 'acq_date')}, {date_buffer_days})"
    links: dict[str, Column] = {}
    for nbr in (False, True):
        for when in ("before", "after"):
            label = f"s2_{when}_nbr" if nbr else f"s2_{when}"
            url = imagery_link_sql("latitude", "longitude", f"{when}_date", nbr, evalscript)
            links[f"link_copernicus_{when}{'_nbr' if nbr else ''}"] = F.expr(
                sheet_link_sql(url, label)
            )
    for c in keywords:
        links[f"link_{c}_x"] = F.expr(sheet_link_sql(post_search_sql(c, start, end), f"X_{c}"))
    return table.withColumns(links)
