"""Ratio features of the pool: balance over the money that moved in 30 days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.cleansing import as_money, cleanse_table
from featuremart.operators.aggregates import (
    CASA_CELLS,
    CELLS,
    active_cells,
    in_cells,
    sum_or_zero,
    with_cells,
)
from featuremart.operators.joins import skew_join
from featuremart.operators.snapshots import ledger_range
from featuremart.plans.balances import balance_accounts

WINDOW_DAYS = 30


def balance_measures() -> list[Column]:
    """Active balance in a group of accounts with cells, without and with deposits."""
    return [
        sum_or_zero(in_cells(active_cells(CASA_CELLS)), F.col("_amount")).alias("casa_sum"),
        sum_or_zero(in_cells(active_cells(CELLS)), F.col("_amount")).alias("casatd_sum"),
    ]


def balance_totals(accounts: DataFrame) -> DataFrame:
    """Active balance per user, without and with deposits."""
    return with_cells(accounts).groupBy("user_id").agg(*balance_measures())


def ledger_entries(ledger: DataFrame, start: str, end: str) -> DataFrame:
    """Cleansed credits and debits of the range."""
    entries = cleanse_table(ledger_range(ledger, start, end))
    return entries.select(
        F.col("tr_acc").cast("string").alias("acct_num"),
        "tr_type",
        as_money(entries, "amt").alias("amt"),
    ).filter(F.col("acct_num").isNotNull())


def flow_measures() -> list[Column]:
    """Number and sum of the credits and of the debits in a group of ledger entries."""
    credit, debit = F.col("tr_type") == "C", F.col("tr_type") == "D"
    return [
        F.count_if(credit).alias("credit_count"),
        sum_or_zero(credit, F.col("amt")).alias("credit_sum"),
        F.count_if(debit).alias("debit_count"),
        sum_or_zero(debit, F.col("amt")).alias("debit_sum"),
    ]


def flows_by_account(ledger: DataFrame, start: str, end: str) -> DataFrame:
    """The flow measures of accounts with a credit or a debit, grouped before any join."""
    moved = F.trim("tr_type").isin("C", "D")
    entries = ledger_entries(ledger.filter(moved), start, end)
    return entries.groupBy("acct_num").agg(*flow_measures())


def flows_by_user(
    accounts: DataFrame, ledger: DataFrame, start: str, end: str
) -> DataFrame:
    """The flow measures per user; an account of two users counts for both."""
    owned = accounts.filter(F.col("acct_num").isNotNull()).select("acct_num", "user_id")
    flows = flows_by_account(ledger, start, end)
    names = [c for c in flows.columns if c != "acct_num"]
    return (
        skew_join(owned, flows, "acct_num", "inner")
        .groupBy("user_id")
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def totals_by_user(accounts: DataFrame, ledger: DataFrame, start: str, end: str) -> DataFrame:
    """Balances and flow measures per user from one pass over the accounts.

    The flows come as one row per account, so an account's balance is counted once.
    """
    flows = flows_by_account(ledger, start, end)
    names = [c for c in flows.columns if c != "acct_num"]
    return (
        with_cells(accounts)
        .join(flows, "acct_num", "left")
        .groupBy("user_id")
        .agg(*balance_measures(), *[F.sum(name).alias(name) for name in names])
    )


def ratio(part: str, whole: str) -> Column:
    """Quotient of two sums with NULL taken as 0; NULL where the divisor is 0."""
    return F.try_divide(
        F.coalesce(F.col(part).cast("double"), F.lit(0.0)),
        F.coalesce(F.col(whole).cast("double"), F.lit(0.0)),
    )


def ratio_features(
    pool: DataFrame, saving: DataFrame, ledger: DataFrame, start: str, end: str
) -> DataFrame:
    """Two ratios per pool row."""
    totals = totals_by_user(balance_accounts(saving), ledger, start, end)
    return (
        cleanse_table(pool)
        .select("user_id")
        .join(totals, "user_id", "left")
        .select(
            "user_id",
            ratio("casa_sum", "credit_sum").alias("transaction_ratio_sumcasa_sumtrxcred_na_l30d"),
            ratio("casatd_sum", "debit_sum").alias(
                "transaction_ratio_sumcasatd_sumtrxdeb_na_l30d"
            ),
        )
    )
