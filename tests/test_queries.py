"""Every registered query against its oracle, and rules all of them keep."""

import os

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from featuremart.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    problems = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    # The smallest tables leave a few reports empty.
    assert [p for p in problems if p != "no rows"] == []


def test_entry_points(spark):
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0


def test_no_row_at_a_time_python(spark, plan_of):
    for name in ("job_customer_pool", "job_demographic", "job_income", "national_id_cleanse"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan


def test_jobs_do_not_repeat_their_inputs(spark, plan_of):
    """Chained left joins repeat what is before them: the bounds are those of the present plans."""
    for name, scans, exchanges in (
        ("job_card_master", 13, 8), ("job_customer_pool", 30, 17), ("job_demographic", 41, 22),
    ):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert plan.count("FileScan") <= scans and plan.count("Exchange hash") <= exchanges, name


def test_catalog_lookups_read_no_data(spark):
    """Partition names come from the catalog: the plans hold no scan of the data."""
    plan = QUERIES["list_partitions"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_accounts_and_ledger_are_scanned_once_for_the_ratios(spark, plan_of):
    from featuremart.operators.scratch import stage
    from featuremart.sources.bank import Bank

    bank = Bank(spark, SF_DIR)
    bank.saving = stage(bank.saving, "saving")
    plan = plan_of(bank.ratios_of(bank.staged_pool))
    assert plan.count("FileScan parquet") == 3  # pool, accounts, ledger


def test_code_lists():
    """Counts and members by hand, as the oracles read the same lists."""
    from featuremart.functions import classes

    assert len(classes.LOAN_TYPES) == len(set(classes.LOAN_TYPES))
    assert {"10", "K1", "ZX"} <= set(classes.LOAN_TYPES) and "AA" not in classes.LOAN_TYPES
    assert (classes.ACTIVE, classes.CLOSED) == (1, 2)
    assert set(classes.INCOME_WORDS) == {"SALARY", "CREDIT", "GAJI", "PAYROLL"}
    assert set(classes.INCOME_CODES) == {"428", "541", "555"}


def test_a_partition_with_most_rows_is_written_by_several_tasks(spark, bank):
    """Snapshots of one day each: the rows of the larger one do not pass through a single task."""
    from types import SimpleNamespace

    from featuremart.queries.scans import partitioned

    wide = F.concat(*[F.md5(F.concat("id", F.lit(i)).cast("string")) for i in range(4)])
    rows = spark.range(0, 20_000, 1, 8).select("id", wide.alias("text"), F.lit("20010615").alias("ds"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "256k")
    try:
        table = spark.read.table(partitioned(SimpleNamespace(spark=spark), rows, "ds"))
        assert table.count() == 20_000
        assert len(table.inputFiles()) > 2
    finally:
        spark.conf.unset(size)
