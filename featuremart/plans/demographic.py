"""Demographic features of the pool: attributes, region of the first account, active loan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.classes import ACTIVE, LOAN_TYPES, eligible_saving, region_class
from featuremart.functions.cleansing import cleanse_table, int_column
from featuremart.functions.dates import before
from featuremart.operators.joins import skew_join
from featuremart.operators.windows import keep_first


def branch_regions(branch: DataFrame, exclude_regions: Sequence[str] = ()) -> DataFrame:
    """Region class of every branch; a branch without region is left out."""
    region = F.col("rgdesc")
    named = cleanse_table(branch).filter(region.isNotNull() & F.col("branch").isNotNull())
    if exclude_regions:
        named = named.filter(~region.isin(*[name.strip(" ") for name in exclude_regions]))
    return named.select("branch", region_class(region).alias("region")).distinct()


def first_accounts(saving: DataFrame, cutoff: str) -> DataFrame:
    """The first eligible account with a branch, per user, if opened before ``cutoff``.

    Accounts opened on the same day are told apart by account number and branch.
    """
    accounts = cleanse_table(saving)
    accounts = accounts.filter(
        eligible_saving(accounts) & F.col("user_id").isNotNull() & F.col("branch").isNotNull()
    ).select("user_id", "open_date", "acct_num", "branch")
    order = [F.asc_nulls_first(c) for c in ("open_date", "acct_num", "branch")]
    return keep_first(accounts, "user_id", order).filter(before(F.col("open_date"), cutoff))


def active_loan_users(loan: DataFrame) -> DataFrame:
    """Users with an active loan of a listed type."""
    return (
        cleanse_table(loan)
        .filter((int_column(loan, "status") == ACTIVE) & F.col("type").isin(*LOAN_TYPES))
        .select("user_id", F.lit(1).alias("has_loan"))
        .distinct()
    )


def demographic_features(
    pool: DataFrame,
    saving: DataFrame,
    branch: DataFrame,
    loan: DataFrame,
    cutoff: str,
    exclude_regions: Sequence[str] = (),
) -> DataFrame:
    """Features per pool row; ``pool``, ``saving`` and ``loan`` hold one snapshot each.

    The branch table carries no broadcast hint: Spark broadcasts it while it is below the
    size limit of the session and shuffles it (splitting a large branch) beyond.
    """
    regions = (
        skew_join(
            first_accounts(saving, cutoff), branch_regions(branch, exclude_regions), "branch", "inner"
        )
        .select("user_id", F.col("open_date").alias("open_date_saving"), "region")
    )
    return (
        cleanse_table(pool)
        .join(regions, ["user_id", "open_date_saving"], "left")
        .join(active_loan_users(loan), "user_id", "left")
        .select(
            "user_id",
            F.col("usia").alias("demog_personal_usia_na_na"),
            F.col("pendidikan").alias("demog_personal_pendidikan_na_na"),
            F.col("jenis_pekerjaan").alias("demog_personal_jenis_pekerjaan_na_na"),
            F.col("penghasilan_per_bulan").alias("demog_personal_penghasilan_perbulan_na_na"),
            F.col("region").alias("demog_id_rgdesc_na_na"),
            F.coalesce("has_loan", F.lit(0)).alias("demog_is_pinjaman_aktif_na_na"),
        )
    )
