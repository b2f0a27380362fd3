"""Dense detection numbers in (date, time, lon, lat) order without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.session import cut_lineage

ORDER = ["acq_date", "acq_time", "lon", "lat"]
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def number_rows(
    rows: DataFrame, order: list[str] = ORDER, id_col: str = "id", tie_breakers: list[str] = ()
) -> DataFrame:
    """Number rows 1..n in sort order.

    The rows are range-partitioned and sorted in parallel; a row's number is its
    place in its partition plus the rows of all partitions before it. Only one
    count per partition passes through the prefix sum. The sorted rows are
    checkpointed first, so the places cannot change between the two reads.
    """
    keys = [F.col(c).asc_nulls_last() for c in [*order, *tie_breakers]]
    placed = cut_lineage(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    # One row per partition, so this side is as small as the partition count.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(
            id_col, F.col("_offset") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1) + 1
        )
        .drop("_part", "_place", "_offset")
    )


def number_rows_per_interval(
    rows: DataFrame, interval: str = "acq_date", id_col: str = "id", tie_breakers: list[str] = ()
) -> DataFrame:
    """Numbers restarting with every load interval, as daily loads produce them."""
    numbered = number_rows(rows, [interval, *[c for c in ORDER if c != interval]], "_all", tie_breakers)
    firsts = numbered.groupBy(interval).agg(F.min("_all").alias("_first"))
    return (
        numbered.join(firsts, interval)
        .withColumn(id_col, F.col("_all") - F.col("_first") + 1)
        .drop("_all", "_first")
    )
