"""Distinct counts by bitmaps equal those taken from the rows, also where they are merged."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featuremart.operators.aggregates import count_distinct_if
from featuremart.operators.distinct_counts import (
    account_bitmaps,
    distinct_counts,
    merge_bitmaps,
    number_accounts,
)
from featuremart.operators.scratch import stage

SCHEMA = "day string, product string, account string"


def rows(df):
    return Counter(map(tuple, df.collect()))


def ledger(spark, n, accounts, seed=0):
    rng = random.Random(seed)
    made = [(f"d{rng.randrange(4)}", rng.choice(["a", "b", None]), f"{rng.randrange(accounts)}") for _ in range(n)]
    made += [("d0", "a", None), ("d9", "none", None)] + made[: n // 3]  # missing accounts, repeated rows
    return stage(spark.createDataFrame(made, SCHEMA), "ledger")


def counted(df, *keys):
    return rows(df.groupBy(*keys).agg(F.countDistinct("account")))


def test_counts_of_all_levels(spark):
    df = ledger(spark, 3000, 700)
    numbers = number_accounts(df, "account")
    assert sorted(r.number for r in numbers.collect()) == list(range(1, numbers.count() + 1))
    bitmaps = stage(account_bitmaps(df, numbers, ["day", "product"], "account"), "bitmaps")
    for keys in (["day", "product"], ["day"], ["product"], []):
        assert rows(distinct_counts(bitmaps, keys)) == counted(df, *keys)


def test_numbers_in_several_stretches(spark):
    ids = spark.range(100_000).select(
        F.lit("d").alias("day"), (F.col("id") % 3).cast("string").alias("product"), F.col("id").cast("string").alias("account")
    )
    df = ids.union(ids.filter("product = '1'"))
    bitmaps = stage(account_bitmaps(df, number_accounts(df, "account"), ["day", "product"], "account"), "bitmaps")
    assert bitmaps.select("stretch").distinct().count() == 4
    assert rows(distinct_counts(bitmaps, ["product"])) == counted(df, "product")
    assert distinct_counts(bitmaps).first()[0] == 100_000


def test_new_days_are_merged_without_the_old_rows(spark):
    old, new = ledger(spark, 500, 300), ledger(spark, 500, 600, seed=1)
    first = stage(number_accounts(old, "account"), "numbers")
    both = stage(number_accounts(new, "account", first), "numbers")
    assert not rows(first) - rows(both)
    assert both.select("number").distinct().count() == both.count()
    kept = stage(merge_bitmaps(account_bitmaps(old, first, ["day", "product"], "account"), ["product"]), "kept")
    added = account_bitmaps(new, both, ["product"], "account")
    assert rows(distinct_counts(kept.unionByName(added), ["product"])) == counted(old.union(new), "product")


def test_equal_to_the_grouped_form(spark):
    df = ledger(spark, 800, 90).filter("product IS NOT NULL")
    grouped = count_distinct_if(df, "day", "account", {"a": F.col("product") == "a"})
    bitmaps = account_bitmaps(df.filter("product = 'a'"), number_accounts(df, "account"), ["day"], "account")
    assert rows(distinct_counts(bitmaps, ["day"])) == rows(grouped.filter("a > 0"))


def test_empty_and_unnumbered(spark):
    df = ledger(spark, 20, 5)
    none = df.limit(0)
    assert number_accounts(none, "account").count() == 0
    assert number_accounts(none, "account", number_accounts(df, "account")).count() == 5
    assert distinct_counts(account_bitmaps(none, number_accounts(df, "account"), ["day"], "account"), ["day"]).count() == 0
    with pytest.raises(Exception, match="no number"):
        account_bitmaps(df, number_accounts(none, "account"), ["day"], "account").collect()
