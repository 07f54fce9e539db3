"""Customer pool: users with a savings account, their attributes and two labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.classes import (
    ACTIVE,
    INCOME_CLASSES,
    LOWEST_INCOME,
    education_class,
    eligible_saving,
    income_class,
    occupation_class,
)
from featuremart.functions.cleansing import int_column
from featuremart.functions.dates import age_years, before, birth_day
from featuremart.operators.aggregates import any_flag
from featuremart.operators.joins import skew_join


# Stands for accounts without a user while users are joined; no trimmed id is a blank. A key that
# is never NULL leaves both parts of a left join nothing to filter, so they share one shuffle.
NO_USER = " "


def account_summary(saving: DataFrame, no_user: str | None = None) -> DataFrame:
    """Per user: the first day of an eligible account, and whether any account is active.

    Both come from one pass over the snapshot. Accounts without a user count as one, known as
    ``no_user``.
    """
    user = F.trim("user_id") if no_user is None else F.coalesce(F.trim("user_id"), F.lit(no_user))
    return saving.groupBy(user.alias("user_id")).agg(
        F.min(F.when(eligible_saving(saving), F.col("open_date"))).alias("open_date_saving"),
        any_flag(int_column(saving, "status") == ACTIVE).alias("is_active"),
    )


def first_open_date(saving: DataFrame, cutoff: str) -> DataFrame:
    """Users with an eligible account opened before ``cutoff``, and the first such day."""
    return (
        saving.filter(eligible_saving(saving))
        .groupBy(F.trim("user_id").alias("user_id"))
        .agg(F.min("open_date").alias("open_date_saving"))
        .filter(before(F.col("open_date_saving"), cutoff))
    )


def known_income_class(income):
    """Class of an income that is stated, NULL for one that is not."""
    return F.when(income.isNotNull(), income_class(income))


def known_persons(persons: DataFrame) -> DataFrame:
    """Persons with a user id, trimmed."""
    return persons.filter(F.col("user_id").isNotNull()).withColumn("user_id", F.trim("user_id"))


def second_incomes(income_backup: DataFrame) -> DataFrame:
    """One row per user with the distinct income classes of the second source.

    There are but a few classes (an income that is not stated is one of them), so the array is
    short however often a user is listed.
    """
    stated = known_income_class(F.col("penghasilan_per_bulan"))
    labels = [*INCOME_CLASSES, None]
    found = income_backup.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *[
            any_flag(stated.eqNullSafe(F.lit(label).cast("string"))).alias(f"has_{i}")
            for i, label in enumerate(labels)
        ]
    )
    classes = [
        F.when(F.col(f"has_{i}") == 1, F.struct(F.lit(label).cast("string").alias("income2")))
        for i, label in enumerate(labels)
    ]
    return found.select("user_id", F.array_compact(F.array(*classes)).alias("incomes"))


def person_attributes(persons: DataFrame, income_backup: DataFrame) -> DataFrame:
    """Attributes of every person; income from the second source where the first has none.

    A person with several classes in the second source gives a row for each of them.
    """
    own = (
        known_persons(persons)
        .select(
            "user_id",
            F.date_format("tanggal_lahir", "yyyy-MM-dd").alias("tanggal_lahir"),
            "jenis_kelamin",
            "kode_jenis_pekerjaan",
            "jenis_pekerjaan",
            "kode_pendidikan",
            "pendidikan",
            known_income_class(F.col("penghasilan_per_bulan")).alias("income1"),
        )
        .distinct()
    )
    described = [c for c in own.columns if c != "income1"]
    return (
        own.join(second_incomes(income_backup), "user_id", "left")
        .select(*own.columns, F.explode_outer("incomes").alias("second"))
        .select(
            *described,
            F.coalesce("income1", "second.income2", F.lit(LOWEST_INCOME)).alias("penghasilan_per_bulan"),
        )
    )


def customer_pool(
    saving: DataFrame,
    persons: DataFrame,
    income_backup: DataFrame,
    card_master: DataFrame,
    cutoff: str,
    as_of: str,
) -> DataFrame:
    """Assemble the pool from one snapshot each of accounts, second incomes and card holders.

    A user is inactive when no account of the snapshot is active.
    """
    users = account_summary(saving, NO_USER).filter(before(F.col("open_date_saving"), cutoff))
    attributes = person_attributes(persons, income_backup)
    spread = [c for c in attributes.columns if c != "user_id"]
    described = skew_join(users, attributes, "user_id", "left", known_persons(persons), null_keys=False).select(
        F.when(F.col("user_id") != NO_USER, F.col("user_id")).alias("user_id"),
        *[c for c in users.columns if c != "user_id"],
        *spread[:-1],
        F.coalesce("penghasilan_per_bulan", F.lit(LOWEST_INCOME)).alias("penghasilan_per_bulan"),
    ).distinct()
    card_holders = (
        card_master.filter(before(F.col("open_date_cc"), cutoff))
        .select("user_id", F.lit(1).alias("is_credit_card"))
        .distinct()
    )
    inactive = (F.col("is_active") == 0) & F.col("user_id").isNotNull()
    return described.join(card_holders, "user_id", "left").select(
        "user_id",
        "tanggal_lahir",
        age_years(birth_day(F.col("tanggal_lahir")), as_of).alias("usia"),
        "jenis_kelamin",
        education_class(F.col("kode_pendidikan")).alias("pendidikan"),
        occupation_class(F.col("kode_jenis_pekerjaan")).alias("jenis_pekerjaan"),
        "penghasilan_per_bulan",
        "open_date_saving",
        F.lit(cutoff).alias("event_date"),
        F.coalesce("is_credit_card", F.lit(0)).alias("is_credit_card"),
        inactive.cast("int").alias("is_inactive"),
    )
