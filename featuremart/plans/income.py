"""Income feature of the pool: credits that look like an income, over 180 days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.classes import income_entry
from featuremart.functions.cleansing import as_account_key, as_money, cleanse_table
from featuremart.operators.joins import skew_join
from featuremart.operators.rolling import ENTRIES, MONEY, MovingTotals, day_names
from featuremart.operators.snapshots import ledger_range

WINDOW_DAYS = 180


def income_by_account(ledger: DataFrame, start: str, end: str, *extra: Column) -> DataFrame:
    """Income per account. Grouping before the join keeps a busy account off the network.

    The tests are on the raw text: none of the wordings starts or ends with a space, so
    padding does not matter to them, and the cheap test on the type comes first.
    """
    entries = ledger_range(ledger, start, end).filter(
        (F.trim("tr_type") == "C") & income_entry(F.col("trremk"), F.col("trancd"))
    )
    return (
        entries.select(
            as_account_key(F.col("tr_acc")).alias("account"),
            as_money(entries, "amt").alias("amt"),
        )
        .groupBy("account")
        .agg(F.sum("amt").alias("income"), *extra)
        .filter(F.col("account").isNotNull())
    )


def user_accounts(saving: DataFrame) -> DataFrame:
    """User and numeric account number of every account."""
    return (
        cleanse_table(saving)
        .select("user_id", as_account_key(F.col("acct_num")).alias("account"))
        .filter(F.col("user_id").isNotNull() & F.col("account").isNotNull())
    )


def income_by_user(saving: DataFrame, ledger: DataFrame, start: str, end: str) -> DataFrame:
    return income_of_users(saving, income_by_account(ledger, start, end))


def income_of_users(saving: DataFrame, income: DataFrame) -> DataFrame:
    """Income per user from income per account."""
    return (
        skew_join(user_accounts(saving), income, "account", "inner")
        .groupBy("user_id")
        .agg(F.sum("income").alias("income"))
    )


def kept_income(spark: SparkSession, name: str, folder: str | None = None) -> MovingTotals:
    """Income per account and day, kept in table ``name`` (see ``rolling``)."""
    return MovingTotals(spark, name, "account", {"income": MONEY}, folder)


def moved_income(
    kept: MovingTotals, ledger: DataFrame, start: str, end: str, modified: datetime, late: Sequence[str] = ()
) -> DataFrame:
    """Income per account over the window, reading only days of the ledger that are new or ``late``."""
    window = f"{WINDOW_DAYS}d"
    new = kept.missing_days(day_names(start, end))
    for day in sorted({*new, *[d for d in late if start <= d <= end]}):
        counted = income_by_account(ledger, day, day, F.count(F.lit(1)).alias(ENTRIES))
        kept.put_day(day, counted, modified)
    return kept.move(window, start, end, modified).select("account", "income")


def income_features(
    pool: DataFrame, saving: DataFrame, ledger: DataFrame, start: str, end: str
) -> DataFrame:
    """Income per pool row, 0 when there is none."""
    return with_income(pool, income_by_user(saving, ledger, start, end))


def with_income(pool: DataFrame, by_user: DataFrame) -> DataFrame:
    """The pool's users with their income."""
    income = F.coalesce(F.col("income").cast("double"), F.lit(0.0))
    return (
        cleanse_table(pool)
        .select("user_id")
        .join(by_user, "user_id", "left")
        .select("user_id", income.alias("ddhist_na_income_sum_180d"))
    )
