"""Writing, staging and what goes with it. Tables go to the scratch folder and are read back."""

import uuid

from pyspark.sql import functions as F

from featuremart.operators import publish, sinks
from featuremart.operators.scratch import scratch_path, stage
from featuremart.plans.customer_pool import first_open_date
from featuremart.plans.portfolio import portfolio_rollup
from featuremart.queries.aggregates import doubles
from featuremart.queries.registry import query
from featuremart.sources.bank_views import PARAMS


class ScratchTable:
    """A catalog table of its own in the scratch folder."""

    def __init__(self, bank, name: str):
        self.spark = bank.spark
        self.name = f"featuremart_{name}_{uuid.uuid4().hex}"
        self.location = scratch_path(bank.spark, name)
        self.modified = bank.modified

    def write(self, df, ds: str, **options) -> bool:
        return sinks.write_snapshot(
            df, self.name, ds, self.modified, location=self.location, **options
        )

    def read(self):
        return self.spark.read.table(self.name)


FIRST_DAYS = """
    SELECT user_id, strftime(open_date_saving, '%Y-%m-%d') AS open_day, '20010620' AS ds
    FROM pool_saving
"""


def _first_days(bank):
    return first_open_date(bank.saving, PARAMS.cutoff).select(
        "user_id", F.date_format("open_date_saving", "yyyy-MM-dd").alias("open_day")
    )


@query(FIRST_DAYS)
def write_partition_idempotent(bank):
    table = ScratchTable(bank, "idempotent")
    for _ in range(2):
        table.write(_first_days(bank), PARAMS.ds)
    return table.read().select("user_id", "open_day", "ds")


@query("""
    SELECT user_id, acct_num, '20010620' AS ds, lpad(CAST(status AS VARCHAR), 2, '0') AS batch
    FROM saving_now
""")
def write_partition_batch(bank):
    table = ScratchTable(bank, "batches")
    rows = bank.saving.select("user_id", "acct_num", "status")
    name = F.lpad(F.col("status").cast("string"), 2, "0")
    table.write(rows.withColumn("batch", name).drop("status"), PARAMS.ds)
    # Batch 03 once more, on its own.
    again = rows.filter(F.col("status") == 3).drop("status")
    table.write(again, PARAMS.ds, batch="03")
    return table.read().select("user_id", "acct_num", "ds", "batch")


@query(FIRST_DAYS)
def write_skip_empty(bank):
    table = ScratchTable(bank, "skip_empty")
    rows = _first_days(bank)
    table.write(rows, PARAMS.ds)
    table.write(rows.filter(F.col("open_day") < "1900"), PARAMS.ds, skip_if_empty=True)
    return table.read().select("user_id", "open_day", "ds")


@query("""
    SELECT user_id, type, ds FROM v_loan WHERE ds <> '20010614'
""")
def drop_partition(bank):
    table = ScratchTable(bank, "dropped")
    loans = bank.view("v_loan")
    for ds in ("20010614", "20010615"):
        table.write(loans.filter(F.col("ds") == ds).select("user_id", "type"), ds)
    sinks.drop_partition(bank.spark, table.name, ds="20010614")
    return table.read().select("user_id", "type", "ds")


@query("SELECT ds, count(*) AS row_count FROM v_saving GROUP BY ds")
def partition_stats(bank):
    return sinks.partition_rows(bank.view("v_saving"), "ds")


@query("""
    SELECT year, month, CAST(sum(length(tr_acc) + length(trremk)) AS BIGINT) AS bytes,
           greatest(1, CAST(floor(sum(length(tr_acc) + length(trremk)) / 10000) AS INTEGER))
             AS files
    FROM v_trx GROUP BY year, month
""")
def output_file_count(bank):
    size = (F.length("tr_acc") + F.length("trremk")).cast("bigint")
    sizes = bank.trx.groupBy("year", "month").agg(F.sum(size).alias("bytes"))
    return sizes.withColumn("files", sinks.file_count(F.col("bytes"), 10_000))


@query("""
    SELECT user_id, acct_num FROM v_saving WHERE substring(md5(acct_num), 1, 8) < '1999999a'
""")
def sample_rows(bank):
    rows = bank.view("v_saving").select("user_id", "acct_num")
    return sinks.sample_rows(rows, 0.1, ["acct_num"])


@query("""
    SELECT user_id, type, '20010620' AS ds, '2001-06-20 08:00:00' AS modified_date, '1' AS batch
    FROM v_loan
""")
def audit_columns(bank):
    rows = bank.view("v_loan").select("user_id", "type")
    in_utc = F.to_utc_timestamp("modified_date", F.current_timezone())
    return sinks.audit_columns(rows, PARAMS.ds, bank.modified, "1").withColumn(
        "modified_date", F.date_format(in_utc, "yyyy-MM-dd HH:mm:ss")
    )


@query("""
    SELECT user_id, saving_casa_aktif_count_na,
           CAST(saving_casa_aktif_sum_na AS DOUBLE) AS saving_casa_aktif_sum_na
    FROM totals
""")
def stage_rollup(bank):
    staged = stage(portfolio_rollup(bank.saving), "rollup")
    return doubles(
        staged.select("user_id", "saving_casa_aktif_count_na", "saving_casa_aktif_sum_na")
    )


@query("""
    SELECT user_id, acct_num, '20010620' AS ds, lpad(CAST(status AS VARCHAR), 2, '0') AS batch
    FROM saving_now
""")
def publish_snapshot(bank):
    """Read from the log after a version with other batches was replaced, and one batch once more."""
    table = ScratchTable(bank, "published")
    rows = bank.saving.select("user_id", "acct_num", F.lpad(F.col("status").cast("string"), 2, "0").alias("batch"))
    table.write(rows.withColumn("batch", F.concat(F.lit("x"), "batch")), PARAMS.ds)
    table.write(rows, PARAMS.ds)
    table.write(rows.filter("batch = '01'").drop("batch"), PARAMS.ds, batch="01")
    return publish.read_snapshot(bank.spark, table.name, PARAMS.ds).select("user_id", "acct_num", "ds", "batch")
