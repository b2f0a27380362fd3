"""Queries over the star-schema test tables, with the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberscope.session import join_by_measured_size
from emberscope.workload import (  # noqa: F401
    event_queries,
    feed_queries,
    imagery_queries,
    link_queries,
    report_queries,
    spatial_queries,
)
from emberscope.workload.catalog import QUERIES
from emberscope.workload.views import Views


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    join_by_measured_size(spark)
    return QUERIES[name].run(Views(spark, sf_dir))


__all__ = ["QUERIES", "run"]
