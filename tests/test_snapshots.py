"""Snapshots: every step of a write may be the last one, two writers, and merges that leave other buckets alone."""

import pytest

from kinomill.session import scratch_path
from kinomill.sources import snapshots as S


@pytest.fixture
def table(spark):
    return S.SnapshotTable(spark, scratch_path(spark, "snapshots"), ("k",), buckets=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_write_merge_and_pinned_reads(spark, table):
    first = [(i, f"a{i}") for i in range(20)] + [(None, "none"), (3, "again")]
    assert table.write(frame(spark, first)) == 0
    pinned = table.read(0)
    assert table.merge(frame(spark, [(3, "new"), (None, "other"), (50, "b"), (50, "c")])) == 1
    kept = [(k, v) for k, v in first if k not in (3, None)]
    assert rows_of(table.read()) == sorted([*kept, (3, "new"), (None, "other"), (50, "b"), (50, "c")], key=repr)
    assert rows_of(pinned) == rows_of(table.read(0)) == sorted(first, key=repr)
    assert table.merge(frame(spark, [])) == 1
    assert table.write(frame(spark, [])) == 2 and table.read().collect() == [] and table.read().columns == ["k", "v"]


def test_buckets_without_keys_stay(spark, table):
    table.write(frame(spark, [(i, "a") for i in range(100)]))
    before = table._manifest(0)["buckets"]
    table.merge(frame(spark, [(7, "b")]))
    after = table._manifest(1)["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()


@pytest.mark.parametrize("step", ["_written", "_commit"])
@pytest.mark.parametrize("late", [False, True])
def test_a_job_that_dies_leaves_the_old_table_or_the_new(spark, table, monkeypatch, step, late):
    table.write(frame(spark, [(1, "a"), (2, "b")]))
    original = getattr(S.SnapshotTable, step)

    def dying(self, *args):
        if late:
            original(self, *args)
        raise KeyboardInterrupt

    monkeypatch.setattr(S.SnapshotTable, step, dying)
    with pytest.raises(KeyboardInterrupt):
        table.merge(frame(spark, [(2, "new")]))
    monkeypatch.setattr(S.SnapshotTable, step, original)
    done = step == "_commit" and late
    assert rows_of(table.read()) == [(1, "a"), (2, "new" if done else "b")]
    assert table.merge(frame(spark, [(2, "new")])) == (2 if done else 1)
    assert rows_of(table.read()) == [(1, "a"), (2, "new")]
    table.expire()
    assert rows_of(table.read()) == [(1, "a"), (2, "new")] and len(table.versions()) == 1


def test_of_two_writers_one_wins(spark, table, monkeypatch):
    table.write(frame(spark, [(1, "a")]))
    original = S.SnapshotTable._written

    def slow(self, df, name):
        monkeypatch.setattr(S.SnapshotTable, "_written", original)
        table.merge(frame(spark, [(2, "other writer")]))
        return original(self, df, name)

    monkeypatch.setattr(S.SnapshotTable, "_written", slow)
    with pytest.raises(S.Conflict):
        table.merge(frame(spark, [(1, "lost")]))
    assert rows_of(table.read()) == [(1, "a"), (2, "other writer")]
    with pytest.raises(FileNotFoundError):
        table.read(9)


def test_many_small_files_are_written_by_several_tasks(spark, small, tmp_path, monkeypatch):
    """Files of a few lines each: their bytes are few, and one task would write them one after the other."""
    from kinomill.catalog import storage

    monkeypatch.setattr(storage, "scratch_path", lambda *_: str(tmp_path / "files"))
    storage.file_hashes(spark, small)
    tasks = {f.name.split("-")[1] for f in (tmp_path / "files").rglob("part-*") if f.is_file()}
    assert len(tasks) > 1


def test_file_hashes_are_taken_once_for_manifest_and_result(spark, small):
    """The result is made of the hashes the manifest has, not of files that are read again."""
    from kinomill.catalog import storage

    plan = storage.file_hashes(spark, small)._jdf.queryExecution().analyzed().toString()
    assert plan.count("md5(content") == 1  # that of ``still_new``
