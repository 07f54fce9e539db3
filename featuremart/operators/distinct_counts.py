"""Exact distinct counts that add up: bitmaps of numbered accounts, merged without their rows.

Accounts get the numbers 1, 2, ... once and keep them. A bitmap covers 32,768 numbers, so the accounts of
a key are one row per stretch in which it has any. Bitmaps of days, products or branches are kept; those
of a month or of all products are theirs merged, and a count is the number of bits that are set.

A bitmap takes 4 KB before compression, however few accounts it holds. The form is meant for keys with
many accounts each; counts per user are better taken by grouping (``aggregates``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.operators.scratch import stage
from featuremart.operators.windows import number_rows


def number_accounts(df: DataFrame, account: str, known: DataFrame | None = None) -> DataFrame:
    """One row (account, number) per account of ``df`` and of ``known``.

    Accounts in ``known``, an earlier result, keep their numbers; others follow after the greatest. Missing
    accounts get none. No task holds all accounts.
    """
    found = df.select(account).filter(F.col(account).isNotNull()).distinct()
    start = 0
    if known is not None:
        found = found.join(known, account, "left_anti")
        start = known.agg(F.max("number")).first()[0] or 0
    numbered = number_rows(stage(found, "accounts"), [account], "number").select(
        account, (F.col("number") + F.lit(start)).cast("bigint").alias("number")
    )
    return numbered if known is None else known.select(account, "number").unionByName(numbered)


def account_bitmaps(df: DataFrame, numbers: DataFrame, keys: Sequence[str], account: str) -> DataFrame:
    """The accounts of every combination of ``keys``: rows (keys, stretch, accounts).

    Repeated rows are combined before they meet the numbers. A key whose accounts are all missing has
    one row with an empty bitmap; an account without a number is an error.
    """
    rows = df.select(*keys, account).distinct().join(numbers, account, "left")
    number = F.when(F.col(account).isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce("number", F.raise_error(F.lit("an account has no number")).cast("bigint"))
    )
    return (
        rows.withColumn("_number", number)
        .groupBy(*keys, F.bitmap_bucket_number("_number").alias("stretch"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("accounts"))
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The bitmaps of coarser ``keys``; those of several tables are merged after ``unionByName``."""
    return bitmaps.groupBy(*keys, "stretch").agg(F.bitmap_or_agg("accounts").alias("accounts"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str] = (), name: str = "accounts") -> DataFrame:
    """Distinct accounts of every combination of ``keys``."""
    sizes = merge_bitmaps(bitmaps, keys).select(*keys, F.bitmap_count("accounts").alias("_size"))
    return sizes.groupBy(*keys).agg(F.coalesce(F.sum("_size"), F.lit(0)).alias(name))
