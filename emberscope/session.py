"""Session helpers: shared scratch space, lineage cuts, size-checked broadcast."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have to be sent to every executor; the callers below only pass
# narrow dimension rows (polygon covers, place cells), a few hundred bytes each.
BROADCAST_MAX_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="emberscope-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _checkpoint_dir(spark: SparkSession) -> str:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages restart from files, not from the sources."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def join_by_measured_size(spark: SparkSession) -> None:
    """Let adaptive execution alone choose which unhinted sides are broadcast.

    The planner's estimate knows neither how many rows an explode makes of one nor what a
    compressed file holds, and a checkpoint keeps it. Of covers, edges and pixels it is a
    hundredth of the truth, so whole tables would go through the driver as "small". The
    limit of the session then holds for sizes measured at run time.
    """
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit == "-1":
        return
    if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Measured: at most ``max_rows`` rows; reading stops there."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the side is measured to be small.

    Beyond the bound the frame comes back unchanged and the join shuffles both
    sides, where adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


_shipped: set[str] = set()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores, by key: for small files whose rows become many or costly ones.

    A small file is one task, however much is made of its rows; adaptive execution leaves a
    number of partitions given here as it is.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1), *keys)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers; needed by the few Python functions."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="emberscope-package-")
    archive = shutil.make_archive(f"{folder}/emberscope", "zip", root, "emberscope")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
