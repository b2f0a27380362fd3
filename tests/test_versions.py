"""One-step table writes, audits on the write, and the run by settings."""

import datetime

import pytest

from emberscope.operators.audits import AuditError
from emberscope.sources import versions

D = datetime.date
SCHEMA = "v int, acq_date date"


def rows(spark, path, *interval):
    return sorted((r.v, r.acq_date.day) for r in versions.read_table(spark, path, *interval).collect())


def frame(spark, *pairs):
    return spark.createDataFrame([(v, D(2024, 1, d)) for v, d in pairs], SCHEMA)


def test_days_and_intervals_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.replace_days(frame(spark, (1, 1), (2, 2), (3, 3)), path) == {"n_rows": 3}
    versions.replace_days(frame(spark, (9, 2), (8, 2)), path)
    assert rows(spark, path) == [(1, 1), (3, 3), (8, 2), (9, 2)]
    # Day 1 ends up empty, day 5 is outside the interval.
    versions.replace_days(frame(spark, (7, 2), (5, 5)), path, (D(2024, 1, 1), D(2024, 1, 2)))
    assert rows(spark, path) == [(3, 3), (7, 2)]
    assert rows(spark, path, D(2024, 1, 3), D(2024, 1, 9)) == [(3, 3)]
    assert rows(spark, path, D(2024, 2, 1), D(2024, 2, 2)) == []
    read = versions.read_table(spark, path, D(2024, 1, 3), D(2024, 1, 3)).inputFiles()
    assert read and all("acq_date=2024-01-03" in f for f in read)


def test_a_broken_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace_days(frame(spark, (1, 1)), path)
    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versions.replace_days(frame(spark, (2, 1), (2, 2)), path)
    assert rows(spark, path) == [(1, 1)]
    # A manifest cut short counts as not written.
    (tmp_path / "t" / "_versions" / "0000000002.json").write_text('{"parts": {"20')
    assert rows(spark, path) == [(1, 1)]
    versions.replace_days(frame(spark, (3, 3)), path)
    assert rows(spark, path) == [(1, 1), (3, 3)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 3
    versions.drop_unused(spark, path)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert rows(spark, path) == [(1, 1), (3, 3)]


def test_only_one_of_two_writers_commits(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace_days(frame(spark, (1, 1)), path)
    real = versions._commit

    def slower(spark, path, version, manifest):
        real(spark, path, version, {**manifest, "parts": {}})
        real(spark, path, version, manifest)

    monkeypatch.setattr(versions, "_commit", slower)
    with pytest.raises(versions.CommitConflict):
        versions.replace_days(frame(spark, (2, 2)), path)


def test_refresh_takes_the_place_of_all(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    versions.refresh(frame(spark, (1, 1), (2, 2)), path)
    versions.refresh(frame(spark, (3, 3)), path)
    assert rows(spark, path) == [(3, 3)]
    versions.refresh(frame(spark, (3, 3)).limit(0), path)
    assert rows(spark, path) == [] and versions.read_table(spark, path).columns == ["v", "acq_date"]


@pytest.mark.parametrize("left", [0, 1])
@pytest.mark.parametrize("by_day", [True, False])
def test_a_failed_audit_leaves_the_old_rows(spark, tmp_path, by_day, left):
    path = str(tmp_path / "t")
    write = versions.replace_days if by_day else versions.refresh
    assert write(frame(spark, (1, 1), (2, 1)), path, min_rows=1) == {"n_rows": 2}
    with pytest.raises(AuditError):
        write(frame(spark, (5, 1)).limit(left), path, min_rows=1)
    assert rows(spark, path) == [(1, 1), (2, 1)]
