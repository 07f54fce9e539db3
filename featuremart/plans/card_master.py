"""Card holder master: one row per user and card with the day the card was opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.classes import EXCLUDED_IDS
from featuremart.functions.cleansing import cleanse_table
from featuremart.functions.dates import before, local_time
from featuremart.operators.joins import skew_join

# Length of a user id that is taken as it is; a user with any other is known by the CRM id.
USER_ID_LENGTH = 7


def person_ids(persons: DataFrame) -> DataFrame:
    """The greatest user id per (hashed) national id."""
    return (
        persons.filter(F.col("id_number").isNotNull() & ~F.col("id_number").isin(*EXCLUDED_IDS))
        .groupBy(F.col("id_number").alias("id_hash"))
        .agg(F.max("user_id").alias("user_id"))
    )


def card_owners(holders: DataFrame, persons: DataFrame) -> DataFrame:
    """Users behind every card account; national ids meet under their hash."""
    accounts = holders.filter(
        F.col("acc_number").isNotNull() & F.col("id_number").isNotNull()
    ).select(F.col("acc_number").alias("cust_number"), F.md5("id_number").alias("id_hash"))
    return (
        skew_join(accounts.distinct(), person_ids(persons), "id_hash", "inner")
        .select("cust_number", "user_id")
        .distinct()
    )


def override_user_id(own: Column, crm: Column) -> Column:
    """The CRM id, where there is one, for a user whose own id has an unusual length."""
    return F.when((F.length(own) != USER_ID_LENGTH) & crm.isNotNull(), crm).otherwise(own)


def card_master(
    cards: DataFrame, holders: DataFrame, persons: DataFrame, crm: DataFrame, cutoff: str
) -> DataFrame:
    """Join cards to users. ``cards`` and ``holders`` hold one snapshot each.

    The first day of a card is found before anything is joined, so each card travels once
    however often it is listed. A customer with several CRM rows gives several result rows.
    """
    cards, holders, persons, crm = map(cleanse_table, (cards, holders, persons, crm))
    first_days = (
        cards.filter(F.col("cust_number").isNotNull())
        .groupBy("cust_number", F.col("card_number").alias("acctno_cc"))
        .agg(local_time(F.min("open_date")).alias("open_date_cc"))
        .filter(before(F.col("open_date_cc"), cutoff))
    )
    crm_ids = crm.filter(F.col("cust_nmbr").isNotNull()).select(
        F.col("cust_nmbr").alias("cust_number"), F.col("user_id").alias("crm_id")
    )
    owners = skew_join(
        card_owners(holders, persons), crm_ids, "cust_number", "left", null_keys=False
    ).select("cust_number", override_user_id(F.col("user_id"), F.col("crm_id")).alias("user_id"))
    return skew_join(first_days, owners, "cust_number", "inner").select(
        "user_id", "acctno_cc", "open_date_cc"
    )
