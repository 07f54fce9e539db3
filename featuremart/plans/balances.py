"""Accounts with balances, as the portfolio and the ratio features need them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.classes import account_flag
from featuremart.functions.cleansing import as_money, cleanse_table, int_column, upper_trimmed


def balance_accounts(saving: DataFrame) -> DataFrame:
    """Cleansed accounts that have a branch, flagged as deposit or not."""
    accounts = cleanse_table(saving).filter(F.col("branch").isNotNull())
    return accounts.select(
        "user_id",
        F.col("acct_num").cast("string").alias("acct_num"),
        int_column(accounts, "status").alias("status"),
        as_money(accounts, "credit_balance").alias("credit_balance"),
        as_money(accounts, "deposit_balance").alias("deposit_balance"),
        upper_trimmed(F.col("curr_type")).alias("curr_type"),
        upper_trimmed(F.col("keterangan")).alias("keterangan"),
        account_flag(F.col("acct_num")).alias("flag"),
    ).filter(F.col("user_id").isNotNull())
