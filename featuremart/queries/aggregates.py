"""Aggregates."""

import uuid

from pyspark.sql import functions as F

from featuremart.operators.aggregates import (
    count_distinct_if,
    median_by,
    sum_or_null,
    sum_or_zero,
)
from featuremart.operators.aggregates import measure_matrix as matrix_of
from featuremart.operators.distinct_counts import account_bitmaps, distinct_counts, number_accounts
from featuremart.operators.scratch import scratch_path, stage
from featuremart.operators.windows import batch_of
from featuremart.oracles.parts import MATRIX_AS_DOUBLES, income_remark, other_remark
from featuremart.plans.balances import balance_accounts
from featuremart.plans.customer_pool import account_summary
from featuremart.plans.customer_pool import first_open_date as first_day
from featuremart.plans.income import income_by_user, kept_income, moved_income
from featuremart.plans.portfolio import portfolio_rollup
from featuremart.plans.ratios import balance_totals, flow_measures, flows_by_user, ratio
from featuremart.plans.ratios import ledger_entries
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


def doubles(df):
    """Decimal columns as doubles."""
    return df.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


@query("""
    SELECT user_id, strftime(open_date_saving, '%Y-%m-%d %H:%M:%S') AS open_date_saving
    FROM pool_saving
""")
def first_open_date(bank):
    return first_day(bank.saving, PARAMS.cutoff).select("user_id", stamped("open_date_saving"))


@query("""
    SELECT trim(user_id) AS user_id,
           CAST(max(CASE WHEN status = 1 THEN 1 ELSE 0 END) AS INTEGER) AS is_active
    FROM saving_now GROUP BY 1
""")
def any_active(bank):
    return account_summary(bank.saving).select("user_id", "is_active")


@query("""
    SELECT user_id,
           count(DISTINCT CASE WHEN status = 1 AND curr_type = 'IDR' THEN acct_num END)
             AS aktif_idr_count,
           count(DISTINCT CASE WHEN status <> 1 AND curr_type <> 'IDR' THEN acct_num END)
             AS nonaktif_nonidr_count
    FROM balances GROUP BY user_id
""")
def cond_count_distinct(bank):
    status, currency = F.col("status"), F.col("curr_type")
    return count_distinct_if(
        balance_accounts(bank.saving), "user_id", "acct_num",
        {
            "aktif_idr_count": (status == 1) & (currency == "IDR"),
            "nonaktif_nonidr_count": (status != 1) & (currency != "IDR"),
        },
    )


@query("""
    SELECT user_id,
           CAST(sum(CASE WHEN flag = 'DEPO' AND status = 1 THEN deposit_balance END) AS DOUBLE)
             AS deposit_sum
    FROM balances GROUP BY user_id
""")
def cond_sum_null(bank):
    active_deposit = (F.col("flag") == "DEPO") & (F.col("status") == 1)
    total = sum_or_null(active_deposit, F.col("deposit_balance")).cast("double")
    return balance_accounts(bank.saving).groupBy("user_id").agg(total.alias("deposit_sum"))


@query("""
    SELECT tr_acc AS acct_num, count(CASE WHEN tr_type = 'C' THEN 1 END) AS credit_count,
           count(CASE WHEN tr_type = 'D' THEN 1 END) AS debit_count
    FROM trx_clean WHERE trx_day BETWEEN '20001217' AND '20010615' GROUP BY tr_acc
""")
def cond_count(bank):
    entries = ledger_entries(bank.trx, *bank.income_range)
    return entries.groupBy("acct_num").agg(*flow_measures()).select(
        "acct_num", "credit_count", "debit_count"
    )


@query("""
    SELECT tr_acc AS acct_num,
           CAST(sum(CASE WHEN tr_type = 'C' THEN amt ELSE 0 END) AS DOUBLE) AS credit_sum
    FROM trx_clean WHERE trx_day BETWEEN '20001217' AND '20010615' GROUP BY tr_acc
""")
def cond_sum_zero(bank):
    credits = sum_or_zero(F.col("tr_type") == "C", F.col("amt")).cast("double")
    entries = ledger_entries(bank.trx, *bank.income_range)
    return entries.groupBy("acct_num").agg(credits.alias("credit_sum"))


@query("SELECT user_id, CAST(income AS DOUBLE) AS income FROM income_users")
def income_sum(bank):
    return doubles(income_by_user(bank.saving, bank.trx, *bank.income_range))


@query("""
    SELECT batch, median(balance) AS balance, median(status) AS status
    FROM (SELECT CAST(floor(CAST(acct_num AS BIGINT) / 1000) + 1 AS INTEGER) AS batch,
                 CASE WHEN branch IS NOT NULL THEN credit_balance END AS balance,
                 CAST(status AS DOUBLE) AS status
          FROM v_saving)
    GROUP BY batch
""")
def median_by_batch(bank):
    rows = bank.view("v_saving").select(
        batch_of(F.col("acct_num").cast("bigint") + 1, 1000).alias("batch"),
        F.when(F.col("branch").isNotNull(), F.col("credit_balance")).alias("balance"),
        "status",
    )
    return median_by(rows, "batch", ["balance", "status"])


@query(f"""
    SELECT user_id, {MATRIX_AS_DOUBLES} FROM matrix
""")
def measure_matrix(bank):
    return doubles(matrix_of(balance_accounts(bank.saving), "user_id", "acct_num"))


@query("""
    SELECT user_id, saving_casa_aktif_count_na,
           CAST(saving_casa_aktif_sum_na AS DOUBLE) AS saving_casa_aktif_sum_na
    FROM totals
""")
def casa_totals(bank):
    return doubles(
        portfolio_rollup(bank.saving).select(
            "user_id", "saving_casa_aktif_count_na", "saving_casa_aktif_sum_na"
        )
    )


@query("""
    SELECT t.user_id,
           CAST(t.saving_casa_aktif_sum_na AS DOUBLE)
             / nullif(CAST(coalesce(f.credit_sum, 0) AS DOUBLE), 0) AS casa_per_credit,
           CAST(t.saving_casa_aktif_sum_na + t.dep_sum AS DOUBLE)
             / nullif(CAST(coalesce(f.debit_sum, 0) AS DOUBLE), 0) AS casatd_per_debit
    FROM totals t LEFT JOIN flows f ON t.user_id = f.user_id
""")
def balance_flow_ratio(bank):
    accounts = balance_accounts(bank.saving)
    flows = flows_by_user(accounts, bank.trx, *bank.ratio_range)
    return balance_totals(accounts).join(flows, "user_id", "left").select(
        "user_id",
        ratio("casa_sum", "credit_sum").alias("casa_per_credit"),
        ratio("casatd_sum", "debit_sum").alias("casatd_per_debit"),
    )


@query(f"""
    SELECT try_cast(tr_acc AS BIGINT) AS account, CAST(sum(amt) AS DOUBLE) AS income FROM trx_clean
    WHERE trx_day BETWEEN '20010603' AND '20010608' AND try_cast(tr_acc AS BIGINT) IS NOT NULL
      AND {income_remark('trremk', 'trancd')} AND {other_remark('trremk')} AND tr_type = 'C'
    GROUP BY account
""")
def income_moving_window(bank):
    """Kept day totals; the window moves by two days, and one day comes late."""
    name = f"featuremart_days_{uuid.uuid4().hex}"
    kept = kept_income(bank.spark, name, scratch_path(bank.spark, "days"))
    early = bank.trx.filter("NOT (month = '06' AND day = '05' AND tr_acc >= '000000000500')")
    moved_income(kept, early, "20010601", "20010606", bank.modified)
    income = moved_income(kept, bank.trx, "20010603", "20010608", bank.modified, late=["20010605"])
    return doubles(income)


@query("""
    SELECT 'day and product' AS level, ds, keterangan, count(DISTINCT acct_num) AS accounts
    FROM v_saving GROUP BY ds, keterangan
    UNION ALL
    SELECT 'product', NULL, keterangan, count(DISTINCT acct_num) FROM v_saving GROUP BY keterangan
    UNION ALL
    SELECT 'all', NULL, NULL, count(DISTINCT acct_num) FROM v_saving
""")
def count_distinct_merged(bank):
    """Accounts by day and product, whose bitmaps give those of products and of all."""
    saving = bank.view("v_saving")
    numbers = number_accounts(saving, "acct_num")
    keys = ["ds", "keterangan"]
    bitmaps = stage(account_bitmaps(saving, numbers, keys, "acct_num"), "bitmaps")
    levels = [("day and product", keys), ("product", keys[1:]), ("all", [])]
    counts = [distinct_counts(bitmaps, by).withColumn("level", F.lit(level)) for level, by in levels]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.select("level", *keys, "accounts")
