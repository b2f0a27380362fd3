"""Structured Streaming over a landing folder of daily files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.operators.spatial import clip_to_union
from emberscope.session import cut_lineage
from emberscope.sources import detections as src
from emberscope.sources.tables import held_days, path_exists, replace_days


def land_new_files(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    country_id: str,
    max_files_per_trigger: int | None = None,
    admin: DataFrame | None = None,
    cell_deg: float = 0.1,
) -> None:
    """Take every file not seen yet, then stop; one call per day of operation.

    A batch is merged per day with what the table holds of that day, so files of
    several satellites may arrive apart, and a batch run again after a failure
    leaves the same rows. Columns are found by each file's header. With ``admin`` only detections inside the country are
    kept. Rejected records go to ``<table>-rejected``, one folder per batch.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def store(batch: DataFrame, batch_id: int) -> None:
        valid, rejected = src.check_records(src.fields_by_name(batch))
        rejected.write.mode("overwrite").parquet(f"{table}-rejected/batch={batch_id}")
        if admin is not None:
            valid = clip_to_union(valid, admin, cell_deg, "longitude", "latitude")
        new = src.to_raw_table(valid, country_id)
        if path_exists(batch.sparkSession, table):
            new = cut_lineage(new)
            same_days = held_days(new, table).select(*new.columns)
            # Cut off before the days it reads are replaced.
            new = cut_lineage(same_days.exceptAll(new).unionByName(new))
        replace_days(new, table)

    query = (
        src.file_lines(reader, landing)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def session_events(
    detections: DataFrame, max_gap_days: int = 2, watermark: str | None = None
) -> DataFrame:
    """Events per area as session windows over the detection day.

    Days are whole, so a session gap of N days and a half splits exactly where
    more than N days pass. With a watermark the frame may be a stream.
    """
    rows = detections.withColumn("day_ts", F.col("acq_date").cast("timestamp"))
    if watermark:
        rows = rows.withWatermark("day_ts", watermark)
    gap = f"{max_gap_days * 24 + 12} hours"
    return rows.groupBy("area_id", F.session_window("day_ts", gap).alias("w")).agg(
        F.min("acq_date").alias("start_date"),
        F.max("acq_date").alias("end_date"),
        F.count("*").alias("event_count"),
    ).drop("w")
