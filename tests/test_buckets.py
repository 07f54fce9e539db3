"""Marts bucketed by the user: what is written, and what a reader need not move."""

import uuid
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from featuremart.operators import publish
from featuremart.operators.buckets import Buckets, buckets_of
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.snapshots import snapshot
from featuremart.plans.dataset import assemble_features
from featuremart.runner import JOINED_MARTS, JOBS, Run, run_job

DS, MODIFIED = "20010620", datetime(2001, 6, 20, 8)


@pytest.fixture
def name(spark):
    made = f"bucketed_{uuid.uuid4().hex}"
    yield made
    for table in spark.catalog.listTables():
        if table.name.startswith(made):
            spark.sql(f"DROP TABLE {table.name}")


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def rows(df):
    return Counter(map(tuple, df.collect()))


def users(spark, *ids):
    return spark.createDataFrame([(u, i) for i, u in enumerate(ids)], "user_id string, x int")


def test_write_keeps_to_the_buckets_of_the_table(spark, name):
    ids = [f"u{i}" for i in range(50)]
    write_snapshot(users(spark, *ids), name, DS, MODIFIED, buckets=Buckets("user_id", 4))
    # Another number is not heeded once the table is there.
    write_snapshot(users(spark, *ids, "u1"), name, DS, MODIFIED, buckets=Buckets("user_id", 7))
    assert buckets_of(spark, name) == Buckets("user_id", 4)
    read = snapshot(spark.table(name), DS)
    assert rows(read.select("user_id", "x")) == rows(users(spark, *ids, "u1"))
    assert len(read.inputFiles()) == 4
    placed = read.select("user_id", F.input_file_name().alias("file")).distinct().collect()
    assert len({r.user_id for r in placed}) == len(placed) == 50
    assert rows(publish.read_snapshot(spark, name, DS).select("user_id", "x")) == rows(read.select("user_id", "x"))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")] == [publish.log_table(name)]


def test_keys_are_cleansed_and_may_be_missing(spark, name):
    write_snapshot(users(spark, " a ", "nan", None, "", "b"), name, DS, MODIFIED, buckets=Buckets("user_id", 3))
    found = spark.table(name).select("user_id").collect()
    assert Counter(r.user_id for r in found) == Counter({None: 3, "a": 1, "b": 1})


def test_empty_snapshot_and_batches(spark, name):
    four = Buckets("user_id", 4)
    write_snapshot(users(spark, "a").limit(0), name, DS, MODIFIED, buckets=four)
    assert spark.table(name).count() == 0
    both = users(spark, "a", "b", "a").withColumn("batch", F.format_string("%02d", "x"))
    write_snapshot(both, f"{name}_b", DS, MODIFIED, buckets=four)
    write_snapshot(both.filter("x = 1").drop("batch"), f"{name}_b", DS, MODIFIED, batch="02")
    found = spark.table(f"{name}_b").select("user_id", "batch")
    assert rows(found) == Counter([("a", "00"), ("b", "01"), ("b", "02")])


def test_failed_write_leaves_no_table(spark, name):
    write_snapshot(users(spark, "a"), name, DS, MODIFIED, buckets=Buckets("user_id", 2))
    with pytest.raises(Exception, match="broken"):
        broken = F.when(F.col("x") >= 0, F.raise_error(F.lit("broken")).cast("int")).alias("x")
        write_snapshot(users(spark, "b").select("user_id", broken), name, DS, MODIFIED)
    assert rows(spark.table(name).select("user_id")) == Counter([("a",)])
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")] == [publish.log_table(name)]


@pytest.mark.parametrize("bucketed", [True, False])
def test_dataset_job_moves_nothing_before_the_numbering(spark, bank, name, no_broadcast, monkeypatch, bucketed):
    names = {role: f"{name}_{role}" for role in (*JOINED_MARTS, "dataset")}
    with monkeypatch.context() as patch:
        for role, mart in zip(JOINED_MARTS, bank.marts, strict=True):
            if bucketed:
                patch.setitem(JOBS, role, lambda run, mart=mart: mart)
                assert run_job(spark, role, date(2001, 6, 20), names, modified=MODIFIED)
            else:
                write_snapshot(mart, names[role], DS, MODIFIED)
    run = Run(spark, date(2001, 6, 20), names)
    assert run.bucketed(JOINED_MARTS) == bucketed
    assembled = assemble_features(*map(run.own, JOINED_MARTS), clean_ids=run.bucketed(JOINED_MARTS))
    plan = assembled._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" not in plan) == bucketed
    assert rows(assembled) == rows(assemble_features(*bank.marts))
    assert run_job(spark, "dataset", date(2001, 6, 20), names, modified=MODIFIED)
    written = spark.table(names["dataset"]).select(*bank.staged_dataset.columns)
    assert rows(written) == rows(bank.staged_dataset)
