"""Incremental pulls: each change once, late and unreadable records set aside, repeated runs without effect."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql.types import StructType

from supplyloom.sources import ingest, versions

SCHEMA = "id bigint, name string, updated_at string"


class Store:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.path, self.quarantine, self.log = (f"{folder}/{n}" for n in ("changes", "quarantine", "log"))

    def pull(self, rows, run, day, source="companies", **options):
        records = rows if hasattr(rows, "columns") else self.spark.createDataFrame(rows, SCHEMA)
        return ingest.pull(records, self.path, self.quarantine, source, run, datetime(2020, 1, day, 12), log_path=self.log, **options)

    def changes(self):
        return sorted((r.id, r.updated_at.day) for r in versions.read(self.spark, self.path).collect())

    def aside(self):
        return sorted((r.reason, r.record) for r in versions.read(self.spark, self.quarantine).collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def change(id_, day, name="n"):
    return (id_, name, f"2020-01-{day:02d} 06:00:00")


def test_overlapping_pulls_store_each_change_once(store):
    first = store.pull([change(1, 1), change(2, 2), change(2, 2), change(1, 3)], "run 1", 3)
    assert first == ingest.Pull(3, {}, datetime(2020, 1, 3, 6))
    second = store.pull([change(1, 1), change(2, 2), change(1, 3), change(3, 3), change(4, 5)], "run 2", 5)
    assert second.accepted == 2 and second.quarantined == {} and second.mark == datetime(2020, 1, 5, 6)
    assert store.changes() == [(1, 1), (1, 3), (2, 2), (3, 3), (4, 5)]


def test_repeated_run_changes_nothing(store):
    store.pull([change(1, 5)], "run 1", 5)
    rows = [change(2, 6), change(3, 2), (4, "n", "soon")]
    results = [store.pull(rows, "run 2", 6) for _ in range(3)]
    assert results[0] == results[1] == results[2]
    store.pull([change(9, 20)], "run 3", 20)
    # also after a later run: its mark is the one of run 1
    assert store.pull(rows, "run 2", 6) == results[0]
    assert store.changes() == [(1, 5), (2, 6), (9, 20)] and len(store.aside()) == 2
    assert versions.current(store.spark, store.path).state["marks"]["companies"][1][0] == "run 2"


def test_late_and_unreadable_records_are_set_aside_once(store):
    store.pull([change(1, 10)], "run 1", 10)
    got = store.pull([change(2, 9), change(3, 8), (4, "n", None), (5, "n", "2020-13-45"), (None, "n", "2020-01-10 01:00:00")], "run 2", 10)
    assert got.accepted == 1 and got.quarantined == {ingest.LATE: 1, ingest.NO_TIME: 2, ingest.CORRUPT: 1}
    assert store.changes() == [(1, 10), (2, 9)]
    again = store.pull([change(3, 8), (4, "n", None)], "run 3", 11)
    assert again.accepted == 0 and again.quarantined == {} and len(store.aside()) == 4
    wide = store.pull([change(6, 7)], "run 4", 11, lateness=timedelta(days=5))
    assert wide.accepted == 1


def test_counts_are_logged(store):
    store.pull([change(1, 10), (2, "n", "x")], "run 1", 10)
    entry = store.spark.read.parquet(store.log).first()
    assert entry.metrics == {"accepted": 1, "late": 0, "no time of change": 1, "corrupt": 0}
    assert entry.category == "pull of companies" and entry.created_at == datetime(2020, 1, 10, 12)


def test_marks_belong_to_their_source(store):
    store.pull([change(1, 20)], "a1", 20, source="a")
    got = store.pull([change(2, 3)], "b1", 20, source="b")
    assert got.accepted == 1 and got.mark == datetime(2020, 1, 3, 6)


def test_time_in_the_future_does_not_move_the_mark_past_the_run(store):
    got = store.pull([change(1, 30), change(2, 4)], "run 1", 5)
    assert got.accepted == 2 and got.mark == datetime(2020, 1, 5, 12)
    assert store.pull([change(3, 6)], "run 2", 7).accepted == 1


def test_empty_pull_keeps_the_mark(store):
    assert store.pull([], "run 0", 1) == ingest.Pull(0, {}, None)
    store.pull([change(1, 3)], "run 1", 3)
    assert store.pull([], "run 2", 4) == ingest.Pull(0, {}, datetime(2020, 1, 3, 6))
    assert store.changes() == [(1, 3)]


def test_run_that_fails_between_quarantine_and_changes(store, monkeypatch):
    rows = [change(1, 3), (2, "n", "x")]
    publish = versions.append_run

    def failing(df, path, *args):
        if path == store.path:
            raise OSError("lost")
        return publish(df, path, *args)

    with monkeypatch.context() as m:
        m.setattr(versions, "append_run", failing)
        with pytest.raises(OSError):
            store.pull(rows, "run 1", 3)
    assert store.pull(rows, "run 1", 3) == ingest.Pull(1, {ingest.NO_TIME: 1}, datetime(2020, 1, 3, 6))
    assert store.changes() == [(1, 3)] and len(store.aside()) == 1


def test_records_of_files_that_cannot_be_read(store, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<companies>\n'
        "<Company><id>1</id><name>a</name><updated_at>2020-01-01 12:00:00</updated_at></Company>\n"
        "<Company><id>one</id><name>b</name><updated_at>2020-01-01 12:00:00</updated_at></Company>\n"
        "<Company><id>3</id><name>c</name><updated_at>yesterday</updated_at></Company>\n</companies>\n"
    )
    (landed / "b.xml").write_text("<companies><Company><id>7</id><name>z</name></Com")
    records = ingest.read_records(store.spark, str(landed), StructType.fromDDL(SCHEMA))
    got = store.pull(records, "run 1", 2)
    assert got.accepted == 1 and got.quarantined == {ingest.CORRUPT: 2, ingest.NO_TIME: 1}
    assert (ingest.CORRUPT, '{"id":"one","name":"b","updated_at":"2020-01-01 12:00:00"}') in store.aside()
    assert versions.read(store.spark, store.path).columns == ["id", "name", "updated_at"]
