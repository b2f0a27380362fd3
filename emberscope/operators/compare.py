"""Comparison of two result sets (old against new)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_span(df: DataFrame, date: str = "acq_date", margin_days: int = 1) -> DataFrame:
    """One row: first date plus and last date minus a margin."""
    return df.agg(
        F.date_add(F.min(date), margin_days).alias("start_date"),
        F.date_sub(F.max(date), margin_days).alias("end_date"),
    )


def within_span(df: DataFrame, span: DataFrame, date: str = "acq_date") -> DataFrame:
    """Rows with a date inside the one-row span, both ends included."""
    return df.filter(
        F.col(date).between(span.select("start_date").scalar(), span.select("end_date").scalar())
    )


def counts_per_day(old: DataFrame, new: DataFrame, date: str = "acq_date") -> DataFrame:
    """Days present in both, unpivoted to (date, variable, value)."""
    n_old = old.groupBy(date).agg(F.count("*").alias("old"))
    n_new = new.groupBy(date).agg(F.count("*").alias("new"))
    return n_old.join(n_new, date).unpivot(date, ["old", "new"], "variable", "value")


def _ids(df: DataFrame, id_col: str, flag: str) -> DataFrame:
    return df.select(id_col).distinct().withColumn(flag, F.lit(1))


def id_set_report(old: DataFrame, new: DataFrame, raw: DataFrame, id_col: str = "id") -> DataFrame:
    """One row on the id sets: sizes, differences, coverage and subset checks.

    All three sets meet in one full outer join, so each is read once.
    """
    sets = (
        _ids(old, id_col, "in_old")
        .join(_ids(new, id_col, "in_new"), id_col, "full_outer")
        .join(_ids(raw, id_col, "in_raw"), id_col, "full_outer")
    )
    return (
        sets.selectExpr(
            "count(in_old) AS n_old",
            "count(in_new) AS n_new",
            "count_if(in_old IS NOT NULL AND in_new IS NOT NULL) AS n_both",
            "count_if(in_old IS NOT NULL AND in_new IS NULL) AS n_missing",
            "count_if(in_old IS NULL AND in_new IS NOT NULL) AS n_added",
            "count_if(in_old IS NOT NULL AND in_raw IS NULL) AS n_old_not_raw",
            "count_if((in_old IS NOT NULL AND in_raw IS NULL)"
            " != ((in_old IS NULL) != (in_new IS NULL))) AS n_raw_gap_unlike_difference",
        )
        .selectExpr(
            "n_old",
            "n_new",
            "n_both",
            "n_missing",
            "n_missing + n_added AS n_difference",
            "n_added = 0 AS difference_is_missing",
            "try_divide(100D * n_new, n_old) AS coverage_pct",
            "n_old_not_raw",
            "n_raw_gap_unlike_difference = 0 AS raw_gap_is_difference",
        )
    )


def missing_rows(old: DataFrame, new: DataFrame, id_col: str = "id") -> DataFrame:
    """Old rows whose id the new set does not have."""
    return old.join(new.select(id_col), id_col, "left_anti")


def rows_in(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    return df.join(ids.select(id_col), id_col, "left_semi")


def match_flags(
    old: DataFrame, new: DataFrame, pairs: dict[str, tuple[str, str]], id_col: str = "id"
) -> DataFrame:
    """Join on id and flag equal values: ``{name: (old column, new column)}``.

    A null on either side leaves the flag null.
    """
    old_side = old.select(id_col, *[F.col(o).alias(f"{name}_old") for name, (o, _) in pairs.items()])
    new_side = new.select(id_col, *[F.col(n).alias(f"{name}_new") for name, (_, n) in pairs.items()])
    return old_side.join(new_side, id_col).withColumns(
        {f"{name}_match": F.col(f"{name}_old") == F.col(f"{name}_new") for name in pairs}
    )


def flag_columns(flags: DataFrame) -> DataFrame:
    """Only the columns ending in ``_match``."""
    return flags.select(flags.colRegex("`^.*_match$`"))


def mismatches(flags: DataFrame, name: str) -> DataFrame:
    """Rows whose flag is false; null flags drop out."""
    return flags.filter(~F.col(f"{name}_match"))


def stacked_points(old: DataFrame, new: DataFrame) -> DataFrame:
    """Positions of both sets with their source."""
    return old.select("latitude", "longitude", F.lit("old").alias("src")).unionByName(
        new.select("latitude", "longitude", F.lit("new").alias("src"))
    )
