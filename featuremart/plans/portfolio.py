"""Portfolio features of the pool: number and balance of active accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.cleansing import cleanse_table
from featuremart.operators.aggregates import (
    CASA_CELLS,
    Cell,
    active_cells,
    measure_matrix,
    measure_totals,
    null_safe_total,
)
from featuremart.plans.balances import balance_accounts


def portfolio_rollup(saving: DataFrame, cells: Sequence[Cell] = CASA_CELLS) -> DataFrame:
    """The measures of all cells per user, and count and balance over the active cells."""
    active = [cell.name for cell in active_cells(cells)]
    return measure_matrix(balance_accounts(saving), "user_id", "acct_num", cells).withColumns(
        {
            "saving_casa_aktif_count_na": null_safe_total(f"{name}_count" for name in active),
            "saving_casa_aktif_sum_na": null_safe_total(f"{name}_sum" for name in active),
        }
    )


def portfolio_features(pool: DataFrame, saving: DataFrame) -> DataFrame:
    """Features per pool row; NULL for a user without accounts."""
    count, total = "saving_casa_aktif_count_na", "saving_casa_aktif_sum_na"
    totals = measure_totals(
        balance_accounts(saving), "user_id", "acct_num", active_cells(CASA_CELLS), count, total
    ).withColumn(total, F.col(total).cast("double"))
    return cleanse_table(pool).select("user_id").join(totals, "user_id", "left")
