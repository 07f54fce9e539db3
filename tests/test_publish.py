"""Snapshots change in one step: for failing writers, for two writers, and for those who read meanwhile."""

import threading
import uuid
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from featuremart.operators import publish
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.snapshots import NoSnapshot, list_partitions

DS, MODIFIED = "20230306", datetime(2023, 3, 6, 8)


@pytest.fixture
def table(spark):
    name = f"published_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {publish.log_table(name)}")


def batches(spark, mark, *names):
    return spark.createDataFrame([(mark, i, n) for n in names for i in range(3)], "mark string, x int, batch string")


def write(spark, table, mark, *names, **options):
    return write_snapshot(batches(spark, mark, *names), table, DS, MODIFIED, **options)


def content(df):
    return Counter((r.mark, r.batch) for r in df.collect())


def whole(mark, *names):
    return Counter({(mark, n): 3 for n in names})


def catalog(spark, table):
    return content(spark.table(table).filter(F.col("ds") == DS))


def published(spark, table):
    return content(publish.read_snapshot(spark, table, DS))


def test_failure_between_data_and_switch(spark, table, monkeypatch):
    write(spark, table, "old", "0", "1")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(publish, "commit", fails)
        with pytest.raises(RuntimeError, match="lost"):
            write(spark, table, "new", "1", "2")
    spark.catalog.refreshTable(table)
    assert catalog(spark, table) == published(spark, table) == whole("old", "0", "1")
    write(spark, table, "new", "1", "2")
    assert catalog(spark, table) == published(spark, table) == whole("new", "1", "2")


def test_failure_between_switch_and_catalog(spark, table, monkeypatch):
    write(spark, table, "old", "0", "1")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(publish, "settle", fails)
        with pytest.raises(RuntimeError, match="lost"):
            write(spark, table, "new", "1", "2")
    assert published(spark, table) == whole("new", "1", "2")
    assert catalog(spark, table) == whole("old", "0", "1")
    publish.settle(spark, table, DS)
    assert catalog(spark, table) == whole("new", "1", "2")
    assert {p["batch"] for p in list_partitions(spark, table)} == {"1", "2"}


def test_a_writer_that_started_before_the_other_published(spark, table):
    write(spark, table, "old", "0", "1")
    start = publish.current(spark, table, DS)
    write(spark, table, "first", "0", "2", former=start)
    with pytest.raises(publish.Conflict):
        write(spark, table, "second", "0", "3", former=start)
    assert catalog(spark, table) == published(spark, table) == whole("first", "0", "2")
    assert publish.current(spark, table, DS).number == start.number + 1


def test_two_writers_and_a_reader_at_once(spark, table):
    write(spark, table, "old", "0", "1", keep=9)
    start, results, seen, done = publish.current(spark, table, DS), {}, [], threading.Event()

    def writer(mark):
        try:
            results[mark] = write(spark, table, mark, "1", "2", "3", former=start, keep=9)
        except publish.Conflict as error:
            results[mark] = error

    def reader():
        while not done.is_set():
            seen.append(published(spark, table))

    watching = threading.Thread(target=reader)
    writers = [threading.Thread(target=writer, args=(m,)) for m in ("a", "b")]
    for thread in (watching, *writers):
        thread.start()
    for thread in writers:
        thread.join()
    done.set()
    watching.join()
    (winner,) = [m for m, r in results.items() if r is True]
    assert sum(isinstance(r, publish.Conflict) for r in results.values()) == 1
    assert seen and all(s in (whole("old", "0", "1"), whole(winner, "1", "2", "3")) for s in seen)
    assert catalog(spark, table) == published(spark, table) == whole(winner, "1", "2", "3")


def test_a_reader_that_planned_before_the_switch_finishes(spark, table):
    write(spark, table, "old", "0", "1")
    before = publish.read_snapshot(spark, table, DS)
    write(spark, table, "new", "2")
    assert content(before) == whole("old", "0", "1")


def test_one_batch_keeps_the_others_of_the_version(spark, table):
    write(spark, table, "old", "0", "1", "o'clock")
    one = batches(spark, "new", "1").drop("batch")
    write_snapshot(one, table, DS, MODIFIED, batch="1")
    want = whole("old", "0", "o'clock") + whole("new", "1")
    assert catalog(spark, table) == published(spark, table) == want


def test_old_versions_go(spark, table):
    for mark in "abcd":
        write(spark, table, mark, "0", "1", keep=2)
    log = spark.table(publish.log_table(table))
    assert sorted(int(r.version) for r in log.select("version").distinct().collect()) == [3, 4]
    write_snapshot(batches(spark, "e", "1").drop("batch"), table, DS, MODIFIED, batch="1", keep=1)
    # Batch 0 of the version before is still in use.
    assert published(spark, table) == catalog(spark, table) == whole("d", "0") + whole("e", "1")


def test_partitions_written_before_there_was_a_log(spark, table):
    old = batches(spark, "old", "0", "1").withColumns({"modified_date": F.lit(MODIFIED), "ds": F.lit(DS)})
    old.select("mark", "x", "modified_date", "ds", "batch").write.partitionBy("ds", "batch").saveAsTable(table)
    with pytest.raises(NoSnapshot):
        publish.read_snapshot(spark, table, DS)
    write_snapshot(batches(spark, "new", "1").drop("batch"), table, DS, MODIFIED, batch="1")
    assert published(spark, table) == catalog(spark, table) == whole("old", "0") + whole("new", "1")
    assert publish.current(spark, table, DS).number == 2


def test_snapshots_without_batches_and_empty_ones(spark, table):
    rows = batches(spark, "a", "0").drop("batch")
    for df in (rows, rows.limit(0), rows):
        write_snapshot(df, table, DS, MODIFIED)
        read = publish.read_snapshot(spark, table, DS)
        assert read.columns == spark.table(table).columns
        assert read.count() == spark.table(table).count() == df.count()


def test_a_row_without_batch_is_an_error(spark, table):
    write(spark, table, "old", "0")
    with pytest.raises(ValueError, match="no batch"):
        write_snapshot(batches(spark, "new", "0", None), table, DS, MODIFIED)
    assert published(spark, table) == whole("old", "0")
