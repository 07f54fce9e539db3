"""Scans, partition lookup, snapshot and range selection."""

import uuid

from pyspark.sql import functions as F

from featuremart.functions.cleansing import cleanse_table
from featuremart.operators import sinks, snapshots
from featuremart.operators.scratch import scratch_path
from featuremart.operators.sinks import partition_rows
from featuremart.params import run_params_columns
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


def partitioned(bank, df, *columns):
    """Name of a catalog table in the scratch folder with the rows of ``df``.

    A partition that holds most rows is split, so no task sorts and writes it alone.
    """
    name = f"featuremart_partitioned_{uuid.uuid4().hex}"
    writer = df.hint("rebalance", *map(F.col, columns)).write.partitionBy(*columns).format("parquet")
    writer.option("path", scratch_path(bank.spark, "partitioned")).saveAsTable(name)
    return name


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def scan_table(bank):
    return bank.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("""
    SELECT DISTINCT concat('year=', year, '/month=', month) AS partition, year, month FROM v_trx
""")
def list_partitions(bank):
    """What the catalog lists; the data are not read for it."""
    table = partitioned(bank, bank.trx.select("tr_acc", "year", "month"), "year", "month")
    found = snapshots.list_partitions(bank.spark, table)
    rows = [("/".join(f"{k}={v}" for k, v in f.items()), *f.values()) for f in found]
    return bank.spark.createDataFrame(rows, "partition string, year string, month string")


@query("""
    SELECT DISTINCT concat('year=', year, '/month=', month, '/day=', day) AS partition,
           year, month, day
    FROM v_trx
""")
def partition_values(bank):
    return snapshots.partition_values(bank.trx, "year", "month", "day").orderBy(
        F.desc("partition")
    )


@query("""
    SELECT ds, count(*) AS row_count FROM v_loan
    WHERE ds = (SELECT max(ds) FROM v_loan) GROUP BY ds
""")
def latest_partition(bank):
    table = partitioned(bank, bank.view("v_loan"), "ds")
    found = snapshots.latest_partition(bank.spark, table)["ds"]
    return partition_rows(snapshots.snapshot(bank.spark.read.table(table), found), "ds")


@query("""
    SELECT ds, count(*) AS row_count FROM v_loan
    WHERE ds = (SELECT max(ds) FROM v_loan) GROUP BY ds
""")
def latest_snapshot(bank):
    loans = bank.view("v_loan")
    return partition_rows(snapshots.snapshot(loans, snapshots.latest_snapshot(loans)), "ds")


@query("""
    SELECT ds, count(*) AS row_count FROM v_saving
    WHERE ds = (SELECT max(ds) FROM v_saving WHERE ds <= '20010614') GROUP BY ds
""")
def nearest_partition(bank):
    table = partitioned(bank, bank.view("v_saving"), "ds")
    found = snapshots.nearest_partition(bank.spark, table, "20010614")
    return partition_rows(snapshots.snapshot(bank.spark.read.table(table), found), "ds")


@query("SELECT user_id, type, ds FROM v_loan")
def scan_catalog_table(bank):
    table = partitioned(bank, bank.view("v_loan"), "ds")
    return bank.spark.read.table(table).select("user_id", "type", "ds")


@query("""
    SELECT ds, count(*) AS row_count FROM v_saving
    WHERE ds = (SELECT max(ds) FROM v_saving WHERE ds <= '20010614') GROUP BY ds
""")
def nearest_snapshot(bank):
    rows = bank.view("v_saving")
    found = snapshots.nearest_snapshot(rows, "20010614")
    return partition_rows(snapshots.snapshot(rows, found), "ds")


@query("""
    SELECT user_id, acct_num, type, status, ds FROM v_saving WHERE ds = '20010615'
""")
def snapshot_filter(bank):
    return snapshots.snapshot(bank.view("v_saving"), PARAMS.data_ds).select(
        "user_id", "acct_num", "type", "status", "ds"
    )


@query("""
    SELECT tr_acc, tr_type, amt, year, month, day FROM v_trx
    WHERE concat(year, month, day) BETWEEN '20001217' AND '20010615'
""")
def ledger_range(bank):
    return bank.income_ledger.select("tr_acc", "tr_type", "amt", "year", "month", "day")


@query("""
    SELECT ds, count(*) AS row_count FROM v_saving
    WHERE ds = (SELECT max(ds) FROM v_saving) GROUP BY ds
""")
def newest_rows(bank):
    return partition_rows(snapshots.newest_rows(bank.view("v_saving")), "ds")


@query("SELECT count(*) AS row_count FROM saving_now")
def row_count(bank):
    return bank.saving.agg(F.count(F.lit(1)).alias("row_count"))


@query("""
    SELECT 'saving' AS input,
           CAST((SELECT count(*) FROM v_saving WHERE ds = '20010615') > 0 AS INTEGER) AS is_ready
    UNION ALL SELECT 'loan',
           CAST((SELECT count(*) FROM v_loan WHERE ds = '20010615') > 0 AS INTEGER)
    UNION ALL SELECT 'credit_info',
           CAST((SELECT count(*) FROM v_credit_info WHERE ds = '20010615') > 0 AS INTEGER)
    UNION ALL SELECT 'cust_info_backup',
           CAST((SELECT count(*) FROM v_cust_info_backup WHERE ds = '20010615') > 0 AS INTEGER)
""")
def inputs_ready(bank):
    names = ("saving", "loan", "credit_info", "cust_info_backup")
    return snapshots.inputs_ready({n: bank.view(f"v_{n}") for n in names}, PARAMS.data_ds)


@query("""
    SELECT DISTINCT strftime(d, '%Y%m%d') AS ds, strftime(d, '%Y%m') AS month,
           strftime(d - 5, '%Y%m%d') AS data_ds, strftime(d - 5, '%Y-%m-%d') AS cutoff,
           strftime(d - 2, '%Y%m%d') AS card_ds,
           strftime(d - 35, '%Y%m%d') AS l30d, strftime(d - 95, '%Y%m%d') AS l90d,
           strftime(d - 185, '%Y%m%d') AS l180d,
           CAST(day(d) IN (6, 20) AS INTEGER) AS is_run_day
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) days
""")
def run_params(bank):
    days = bank.table("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(*run_params_columns(F.col("day")))


@query("""
    SELECT DISTINCT user_id, type, status FROM v_saving
""")
def distinct_rows(bank):
    return bank.view("v_saving").select("user_id", "type", "status").distinct()


@query("""
    SELECT user_id, acct_num, strftime(open_date, '%Y-%m-%d %H:%M:%S') AS open_date
    FROM saving_clean
""")
def sorted_output(bank):
    rows = cleanse_table(bank.saving)
    return sinks.sorted_output(rows.select("user_id", "acct_num", stamped("open_date")), "acct_num")
