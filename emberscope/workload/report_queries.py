"""Comparison of an old and a new result set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions import scalars
from emberscope.operators import compare
from emberscope.workload.catalog import cte, query
from emberscope.workload.views import Views

_ID = "md5(CAST(CAST(lat AS DECIMAL(20, 5)) AS VARCHAR) || CAST(CAST(lon AS DECIMAL(20, 5)) AS VARCHAR))"
cte("old_set", f"SELECT *, {_ID} AS id FROM res WHERE firms_id % 5 != 0")
cte("new_set", f"SELECT *, {_ID} AS id FROM res WHERE firms_id % 3 != 0")
cte("raw_set", f"SELECT *, {_ID} AS id FROM det WHERE firms_id % 7 != 0")


def _sets(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    results = v.sample_results().withColumn("id", scalars.position_id("lat", "lon"))
    raw = v.detections().withColumn("id", scalars.position_id("lat", "lon"))
    return (
        results.filter("firms_id % 5 != 0"),
        results.filter("firms_id % 3 != 0"),
        raw.filter("firms_id % 7 != 0"),
    )


@query(
    "AGG13 RSH1 JOIN13 PIPE11",
    """
    SELECT acq_date, 'old' AS variable, n AS value
    FROM (SELECT acq_date, count(*) AS n FROM old_set GROUP BY ALL)
    WHERE acq_date IN (SELECT acq_date FROM new_set)
    UNION ALL
    SELECT acq_date, 'new', n FROM (SELECT acq_date, count(*) AS n FROM new_set GROUP BY ALL)
    WHERE acq_date IN (SELECT acq_date FROM old_set)""",
    "old_set new_set",
)
def result_counts_per_day(v: Views) -> DataFrame:
    old, new, _ = _sets(v)
    return compare.counts_per_day(old, new)


@query(
    "AGG14 FLT4 SCL1",
    """
    SELECT id, acq_date FROM old_set
    WHERE acq_date BETWEEN (SELECT min(acq_date) + 1 FROM old_set) AND (SELECT max(acq_date) - 1 FROM old_set)""",
    "old_set",
)
def results_inside_span(v: Views) -> DataFrame:
    old, _, _ = _sets(v)
    return compare.within_span(old, compare.date_span(old)).select("id", "acq_date")


@query(
    "SET2 PIPE11",
    """
    SELECT n_old, n_new, n_both, n_old - n_both AS n_missing, n_old + n_new - 2 * n_both AS n_difference,
           n_new = n_both AS difference_is_missing,
           CAST(100 AS DOUBLE) * n_new / n_old AS coverage_pct,
           n_old_not_raw,
           (SELECT count(*) FROM ((SELECT id FROM old_set EXCEPT SELECT id FROM raw_set)
              EXCEPT (SELECT id FROM ((SELECT id FROM old_set EXCEPT SELECT id FROM new_set)
                 UNION (SELECT id FROM new_set EXCEPT SELECT id FROM old_set))))) = 0
           AND (SELECT count(*) FROM (SELECT id FROM ((SELECT id FROM old_set EXCEPT SELECT id FROM new_set)
                 UNION (SELECT id FROM new_set EXCEPT SELECT id FROM old_set)))
              WHERE id NOT IN (SELECT id FROM old_set EXCEPT SELECT id FROM raw_set)) = 0
             AS raw_gap_is_difference
    FROM (SELECT (SELECT count(DISTINCT id) FROM old_set) AS n_old,
                 (SELECT count(DISTINCT id) FROM new_set) AS n_new,
                 (SELECT count(DISTINCT id) FROM old_set WHERE id IN (SELECT id FROM new_set)) AS n_both,
                 (SELECT count(DISTINCT id) FROM old_set WHERE id NOT IN (SELECT id FROM raw_set)) AS n_old_not_raw)""",
    "old_set new_set raw_set",
)
def id_set_report(v: Views) -> DataFrame:
    return compare.id_set_report(*_sets(v))


@query(
    "SET2 SET3",
    "SELECT firms_id, id FROM old_set WHERE id NOT IN (SELECT id FROM new_set)",
    "old_set new_set",
)
def missing_results(v: Views) -> DataFrame:
    old, new, _ = _sets(v)
    return compare.rows_in(old, compare.missing_rows(old, new)).select("firms_id", "id")


_PAIRS = {
    "burn_scar": ("burn_scar_detected", "burn_scar_detected"),
    "no_data": ("no_data", "no_data"),
    "before": ("before_date", "before_date"),
}


def _flags(v: Views) -> DataFrame:
    old, new, _ = _sets(v)
    changed = new.withColumn(
        "burn_scar_detected", F.expr("burn_scar_detected != (firms_id % 8 = 0)")
    )
    return compare.match_flags(old, changed, _PAIRS, "firms_id")


_FLAGS = """
    SELECT o.firms_id, o.burn_scar_detected AS burn_scar_old,
           n.burn_scar_detected != (n.firms_id % 8 = 0) AS burn_scar_new,
           o.burn_scar_detected = (n.burn_scar_detected != (n.firms_id % 8 = 0)) AS burn_scar_match,
           o.no_data = n.no_data AS no_data_match, o.before_date = n.before_date AS before_match
    FROM old_set o JOIN new_set n USING (firms_id)"""


@query(
    "JOIN13 SCL14 RSH2",
    f"SELECT burn_scar_match, no_data_match, before_match, count(*) AS n_rows FROM ({_FLAGS}) GROUP BY ALL",
    "old_set new_set",
)
def match_flag_counts(v: Views) -> DataFrame:
    flags = compare.flag_columns(_flags(v))
    return flags.groupBy(*flags.columns).agg(F.count("*").alias("n_rows"))


@query(
    "FLT10 SCL14",
    f"SELECT firms_id, burn_scar_old, burn_scar_new FROM ({_FLAGS}) WHERE NOT burn_scar_match",
    "old_set new_set",
)
def burn_scar_mismatches(v: Views) -> DataFrame:
    return compare.mismatches(_flags(v), "burn_scar").select(
        "firms_id", "burn_scar_old", "burn_scar_new"
    )


@query(
    "SET4",
    """
    SELECT lat AS latitude, lon AS longitude, 'old' AS src FROM old_set
    UNION ALL SELECT lat, lon, 'new' FROM new_set""",
    "old_set new_set",
)
def stacked_points(v: Views) -> DataFrame:
    old, new, _ = _sets(v)
    renamed = {"lat": "latitude", "lon": "longitude"}
    return compare.stacked_points(old.withColumnsRenamed(renamed), new.withColumnsRenamed(renamed))
