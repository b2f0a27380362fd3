"""Plans: pruning, pushdown, join kinds, and the shared scratch folder."""

import datetime

import pytest

from emberscope import session
from emberscope.operators import spatial
from emberscope.operators.islands import date_islands
from emberscope.sources import tables
from emberscope.workload.views import Views

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_reads_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_days(Views(spark, SF_DIR).feed(), path)
    text = plan(tables.read_interval(spark, path, datetime.date(2024, 1, 3), datetime.date(2024, 1, 4)))
    assert "PartitionFilters: [isnotnull(acq_date" in text


def test_scan_reads_only_needed_columns(spark):
    v = Views(spark, SF_DIR)
    text = plan(v.detections().select("firms_id", "lon", "lat"))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_small_cover_is_broadcast_and_large_is_not(spark):
    v = Views(spark, SF_DIR)
    cover = v.include_cover()
    assert cover.fits_broadcast()
    joined = plan(spatial.points_in_polygons(v.detections(), cover))
    assert "BroadcastHashJoin" in joined and "Exchange hashpartitioning" not in joined
    assert not v.include_cover().fits_broadcast(max_bytes=1000)


def test_event_windows_run_on_distinct_dates(spark):
    text = plan(date_islands(Views(spark, SF_DIR).in_areas()))
    assert text.index("Window") < text.index("HashAggregate(keys=[area_id")


def test_scratch_follows_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: str(tmp_path) if key == "spark.checkpoint.dir" else default)
    assert session.shared_dir(spark) == str(tmp_path)


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_export_sorts_rows_before_links_are_made(spark, tmp_path, monkeypatch, capsys):
    from emberscope.plans import export as ex

    frames = []
    monkeypatch.setattr(ex, "write_csv", lambda df, path, order=(): frames.append(df))
    one = spark.sql(
        "SELECT id AS event_no, 'A' AS area_include_id, DATE'2024-01-02' AS acq_date, DATE'2024-01-02' AS start_date,"
        " DATE'2024-01-01' AS before_date, DATE'2024-01-03' AS after_date, 1D AS latitude, 2D AS longitude,"
        " 'P' AS settlement_name FROM range(5)"
    )
    ex.export(one, one, str(tmp_path), add_links=True)
    assert len(frames) == 2
    for df in frames:
        df.explain()
        plan = capsys.readouterr().out
        assert "HYPERLINK" in plan.split("rangepartitioning")[0]
        assert "HYPERLINK" not in plan.split("rangepartitioning")[1]
        assert [r.event_no for r in df.collect()] == [0, 1, 2, 3, 4]
