"""Daily detection files: scan, check, normalise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.functions.scalars import hhmm_minutes
from emberscope.schemas import (
    CONFIDENCES,
    DAY_NIGHT,
    DETECTION_FEED,
    INSTRUMENTS,
    RAW_DETECTION_COLUMNS,
    SATELLITES,
)
from emberscope.session import broadcast_if_small, cut_lineage

HEADER_START = ("latitude", "longitude")


class RejectedRecords(ValueError):
    pass


def file_lines(reader, paths: str | list[str]) -> DataFrame:
    """``value, file`` of every line; ``reader`` reads a batch or a stream."""
    return reader.text(paths).select("value", F.col("_metadata.file_path").alias("file"))


def _with_cells(df: DataFrame, width: int) -> DataFrame:
    """``df`` with ``cells``: the fields of ``value`` as ``width`` strings, null where there are fewer.

    A line gives one row of an explode: filters on its fields are not moved below that, where
    the optimizer would put the parser in for every field they name.
    """
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    parsed = df.select("*", F.explode(F.array(F.from_csv("value", schema))).alias("parsed"))
    return parsed.withColumn("cells", F.array(*(f"parsed.c{i}" for i in range(width)))).drop("value", "parsed")


def fields_by_name(lines: DataFrame) -> DataFrame:
    """The text fields of the feed, each taken from where its file's header names it.

    ``lines`` has ``value`` and ``file``. Files may list the columns in any order and have
    others besides. A file without a header, with a column missing or with headers that
    differ is an error. One row per file tells the order, so all orders share a scan.
    """
    is_header = F.lit(True)
    for name in HEADER_START:
        is_header = is_header & F.contains(F.lower("value"), F.lit(name))
    needed = F.array(*(F.lit(c) for c in DETECTION_FEED.names))
    lacking = F.array_except(needed, F.col("names"))
    width = F.size(F.split("value", ",")).alias("width")
    headers = cut_lineage(lines.filter(is_header).select("file", "value", width).distinct())
    widest = headers.agg(F.max("width")).first()[0] or len(DETECTION_FEED)
    named = _with_cells(headers, widest).select(
        "file", F.transform("cells", lambda c: F.lower(F.trim(c))).alias("names")
    )
    orders = named.groupBy("file").agg(F.min("names").alias("names"), F.count("*").alias("n")).select(
        "file",
        F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("more than one header in "), "file")))
        .when(
            F.size(lacking) > 0,
            F.raise_error(F.concat(F.lit("header of "), "file", F.lit(" lacks "), F.array_join(lacking, ", "))),
        )
        .otherwise(F.col("names"))
        .alias("names"),
    )
    given = F.coalesce("names", F.raise_error(F.concat(F.lit("no header in "), "file")))
    rows = (
        lines.filter(~is_header & (F.trim("value") != ""))
        .join(broadcast_if_small(orders), "file", "left")
        .select("value", given.alias("names"))
    )
    fields = (
        F.get("cells", F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in DETECTION_FEED.names
    )
    # One row again, so that fields are looked up once however often the checks name them.
    return _with_cells(rows, widest).select(F.inline(F.array(F.struct(*fields))))


def scan_detections(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw text fields of all files (one per satellite and day) as one frame, read by name."""
    return fields_by_name(file_lines(spark.read, paths))


def one_constellation(frames: list[DataFrame]) -> DataFrame:
    """Rows of several satellites as one set."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _typed(raw: DataFrame) -> DataFrame:
    """Typed columns plus ``problems``, the names of fields that break a rule."""
    doubles = ("latitude", "longitude", "scan", "track", "frp", "bright_ti4", "bright_ti5")
    enums = {
        "satellite": SATELLITES,
        "instrument": INSTRUMENTS,
        "confidence": CONFIDENCES,
        "daynight": DAY_NIGHT,
    }
    typed = {c: F.expr(f"try_cast({c} AS DOUBLE)") for c in doubles}
    typed["acq_date"] = F.expr("try_cast(acq_date AS DATE)")
    typed["acq_time"] = hhmm_minutes("acq_time")
    rules = [f"IF(try_cast({c} AS DOUBLE) IS NULL, '{c}', NULL)" for c in doubles]
    rules.append("IF(try_cast(acq_date AS DATE) IS NULL, 'acq_date', NULL)")
    rules.append("IF(_minutes IS NULL, 'acq_time', NULL)")
    rules.append("IF(version IS NULL, 'version', NULL)")
    for c, allowed in enums.items():
        values = ", ".join(f"'{v}'" for v in allowed)
        rules.append(f"IF({c} IS NULL OR {c} NOT IN ({values}), '{c}', NULL)")
    return (
        raw.withColumn("_minutes", hhmm_minutes("acq_time"))
        .withColumn("problems", F.expr(f"filter(array({', '.join(rules)}), p -> p IS NOT NULL)"))
        .withColumns(typed)
        .drop("_minutes")
    )


def check_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``problems``)."""
    typed = _typed(raw)
    return (
        typed.filter("size(problems) = 0").drop("problems"),
        typed.filter("size(problems) > 0"),
    )


def require_valid(raw: DataFrame) -> DataFrame:
    """Strict form: one bad record fails the load when the rows are read."""
    typed = _typed(raw)
    checked = F.expr(
        "IF(size(problems) = 0, latitude,"
        " CAST(raise_error(concat('bad detection record: ', array_join(problems, ', '))) AS DOUBLE))"
    )
    return typed.withColumn("latitude", checked).drop("problems")


def to_raw_table(valid: DataFrame, country_id: str) -> DataFrame:
    """Stored column order with the country as a constant column."""
    return valid.withColumn("country_id", F.lit(country_id)).select(*RAW_DETECTION_COLUMNS)


def distinct_records(valid: DataFrame) -> DataFrame:
    """One row per (place, date, time), the identity of a record."""
    return valid.dropDuplicates(["latitude", "longitude", "acq_date", "acq_time"])
