"""Registry of the queries, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from emberscope.workload.views import Views


@dataclass(frozen=True)
class Query:
    name: str
    units: str
    run: Callable[[Views], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

# Common table expressions of the SQL side, in dependency order.
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def with_ctes(names: str, body: str) -> str:
    """``body`` preceded by the named expressions and everything they use."""
    import re

    needed: set[str] = set()

    def add(name: str) -> None:
        if name in needed:
            return
        for other in CTES:
            if other != name and re.search(rf"\b{other}\b", CTES[name]):
                add(other)
        needed.add(name)

    for name in names.split():
        add(name)
    listed = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    # A view may read itself.
    again = "RECURSIVE " if any(re.search(rf"\b(FROM|JOIN) {n}\b", CTES[n]) for n in needed) else ""
    return f"WITH {again}{listed}\n{body}" if listed else body


def query(units: str, sql: str | None = None, ctes: str = ""):
    """Register a function as a query for the given inventory units."""

    def register(fn: Callable[[Views], DataFrame]):
        QUERIES[fn.__name__] = Query(
            fn.__name__, units, fn, None if sql is None else with_ctes(ctes, sql)
        )
        return fn

    return register


cte(
    "det",
    """
    SELECT event_id AS firms_id, CAST(ts AS DATE) AS acq_date,
           CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS acq_time, cell,
           (event_id * 31) % 100 * 10 AS dx, (event_id * 53) % 100 * 10 AS dy,
           (20000 + 100 * (cell % 100) + (event_id * 31) % 100) / CAST(1000 AS DOUBLE) AS lon,
           (100 * (cell // 100) + (event_id * 53) % 100) / CAST(1000 AS DOUBLE) AS lat,
           CASE event_id % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'N20' ELSE 'N21' END AS satellite,
           CASE event_id % 7 WHEN 0 THEN 'h' WHEN 1 THEN 'l' ELSE 'n' END AS confidence,
           (30 + event_id % 20) / CAST(100 AS DOUBLE) AS scan,
           (30 + event_id % 15) / CAST(100 AS DOUBLE) AS track,
           (3000 + event_id % 600) / CAST(10 AS DOUBLE) AS bright_ti4,
           (2800 + event_id % 300) / CAST(10 AS DOUBLE) AS bright_ti5,
           value AS frp,
           CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS daynight
    FROM (SELECT *, (user_id * 10 + event_id % 10) % (SELECT count(*) FROM customer) AS cell
          FROM events)""",
)
cte(
    "hits",
    """
    SELECT *, 'A' || lpad(CAST(cell AS VARCHAR), 9, '0') AS area_id FROM det
    WHERE CASE cell % 3
            WHEN 0 THEN dx BETWEEN 5 AND 895 AND dy BETWEEN 5 AND 895
            WHEN 1 THEN dx >= 5 AND dy >= 5 AND 88 * dx + 89 * dy <= 79205
            ELSE dx BETWEEN 5 AND 895 AND dy BETWEEN 5 AND 895
                 AND NOT (dx BETWEEN 305 AND 605 AND dy BETWEEN 305 AND 605) END""",
)
cte(
    "corners",
    """
    SELECT c_custkey AS cell, r.ring, r.n, r.x, r.y FROM customer,
      (VALUES (0,0,0,5,5),(0,0,1,895,5),(0,0,2,895,895),(0,0,3,5,895),(0,0,4,5,5),
              (1,0,0,5,5),(1,0,1,895,5),(1,0,2,5,885),(1,0,3,5,5),
              (2,0,0,5,5),(2,0,1,895,5),(2,0,2,895,895),(2,0,3,5,895),(2,0,4,5,5),
              (2,1,0,305,305),(2,1,1,305,605),(2,1,2,605,605),(2,1,3,605,305),(2,1,4,305,305)
      ) r(kind, ring, n, x, y)
    WHERE c_custkey % 3 = r.kind""",
)
cte(
    "edges",
    """
    SELECT a.cell, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
    FROM corners a JOIN corners b ON a.cell = b.cell AND a.ring = b.ring AND b.n = a.n + 1""",
)
cte(
    "adm",
    """
    SELECT r_name AS gadm_1, n_name AS gadm_2, 20.0 + 2 * r_regionkey AS x1,
           22.0 + 2 * r_regionkey AS x2, 3.0 * b AS y1, 3.0 * b + 3 AS y2
    FROM region JOIN (SELECT n_regionkey, n_name,
      rank() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS b FROM nation)
      ON n_regionkey = r_regionkey""",
)
cte(
    "places",
    """
    SELECT s_name AS name, (2000 + (s_suppkey * 37) % 1000) / CAST(100 AS DOUBLE) AS plon,
           ((s_suppkey * 53) % 1500) / CAST(100 AS DOUBLE) AS plat FROM supplier""",
)
# Results with every branch, derived from the detection number.
cte(
    "res",
    """
    SELECT *, firms_id % 11 = 0 AS no_data, firms_id % 11 != 0 AND firms_id % 7 = 0 AS too_cloudy,
           CASE WHEN firms_id % 11 = 0 OR firms_id % 7 = 0 THEN NULL
                ELSE acq_date - CAST(firms_id % 5 + 1 AS INTEGER) END AS before_date,
           CASE WHEN firms_id % 11 = 0 OR firms_id % 7 = 0 THEN NULL
                ELSE acq_date + CAST(firms_id % 3 + 1 AS INTEGER) END AS after_date,
           firms_id % 4 = 0 AS burn_scar_detected, firms_id % 50 AS burnt_pixel_count,
           firms_id % 6 AS burnt_building_count
    FROM hits""",
)
cte(
    "ev",
    """
    SELECT * EXCLUDE (gap),
           CAST(sum(CASE WHEN gap > 2 OR gap IS NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY area_id ORDER BY acq_date) AS INTEGER) AS event_no
    FROM (SELECT *, acq_date - lag(acq_date) OVER (PARTITION BY area_id ORDER BY acq_date) AS gap
          FROM res)""",
)
cte(
    "wide_ev",
    """
    SELECT * EXCLUDE (gap),
           CAST(sum(CASE WHEN gap > 30 OR gap IS NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY area_id ORDER BY acq_date) AS INTEGER) AS event_no
    FROM (SELECT *, acq_date - lag(acq_date) OVER (PARTITION BY area_id ORDER BY acq_date) AS gap
          FROM hits)""",
)


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"(2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )
