"""Inference dataset: the features of users to be scored, with reproducible ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.cleansing import PARTITION_COLUMNS, cleanse_table
from featuremart.operators.scratch import stage
from featuremart.operators.windows import number_rows, row_id

# Names of the features.
DEMOGRAPHIC = (
    "demog_personal_usia_na_na",
    "demog_personal_pendidikan_na_na",
    "demog_personal_jenis_pekerjaan_na_na",
    "demog_personal_penghasilan_perbulan_na_na",
    "demog_id_rgdesc_na_na",
    "demog_is_pinjaman_aktif_na_na",
)
PORTFOLIO = ("saving_casa_aktif_count_na", "saving_casa_aktif_sum_na")
INCOME = ("ddhist_na_income_sum_180d",)
RATIOS = (
    "transaction_ratio_sumcasa_sumtrxcred_na_l30d",
    "transaction_ratio_sumcasatd_sumtrxdeb_na_l30d",
)
# The order in which the model takes its features.
FEATURES = DEMOGRAPHIC + PORTFOLIO + INCOME + RATIOS


def cleansed_mart(mart: DataFrame, clean_ids: bool) -> DataFrame:
    """Cleansed text; ids that are clean already stay untouched, and with them the buckets of a mart."""
    return cleanse_table(mart, (*PARTITION_COLUMNS, "user_id") if clean_ids else PARTITION_COLUMNS)


def distinct_rows(
    mart: DataFrame, features: tuple[str, ...], clean_ids: bool = False
) -> DataFrame:
    """The different rows of a mart; a user whose rows differ keeps all of them."""
    return cleansed_mart(mart, clean_ids).select("user_id", *features).distinct()


def candidates(pool: DataFrame, demographic: DataFrame, clean_ids: bool = False) -> DataFrame:
    """Active users without a card, with their demographic features."""
    users = (
        cleansed_mart(pool, clean_ids)
        .filter((F.col("is_credit_card") == 0) & (F.col("is_inactive") == 0))
        .select("user_id")
        .distinct()
    )
    features = distinct_rows(demographic, DEMOGRAPHIC, clean_ids)
    return users.join(features, "user_id", "left")


def assemble_features(
    pool: DataFrame,
    demographic: DataFrame,
    portfolio: DataFrame,
    income: DataFrame,
    ratios: DataFrame,
    clean_ids: bool = False,
) -> DataFrame:
    """All features of the candidates; amounts that are missing are 0.

    Every side is brought to the user key once, so the joins share one partitioning. Marts that are
    bucketed by the user have it already; ``clean_ids`` says that their ids need no cleansing.
    """
    out = candidates(pool, demographic, clean_ids)
    for mart, features in ((portfolio, PORTFOLIO), (income, INCOME), (ratios, RATIOS)):
        out = out.join(distinct_rows(mart, features, clean_ids), "user_id", "left")
    amounts = [
        F.coalesce(F.col(name), F.lit(0)).alias(name) for name in PORTFOLIO + INCOME + RATIOS
    ]
    return out.select("user_id", *DEMOGRAPHIC, *amounts).distinct()


def inference_dataset(
    pool: DataFrame,
    demographic: DataFrame,
    portfolio: DataFrame,
    income: DataFrame,
    ratios: DataFrame,
    ds: str,
    clean_ids: bool = False,
) -> DataFrame:
    """The assembled features with an id per row. Every input holds one snapshot.

    The numbering follows the user and the demographic features, then the amounts: all columns,
    which tell the rows apart. It reads the rows twice, so they are written once before. Each partition comes out sorted by id and holds whole ranges of ids.
    """
    assembled = assemble_features(pool, demographic, portfolio, income, ratios, clean_ids)
    rows = stage(assembled, "assembled")
    numbered = number_rows(
        rows, ["user_id", *DEMOGRAPHIC], ties=PORTFOLIO + INCOME + RATIOS
    )
    return numbered.select(
        row_id(ds, F.col("row_number")).alias("id"), "user_id", *FEATURES
    )
