"""Conditional aggregates per key, without one Expand per distinct count."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product as combinations_of

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.classes import ACTIVE


def any_flag(condition: Column) -> Column:
    """1 when the condition holds for any row of the group, else 0 (never NULL)."""
    return F.max(F.when(condition, 1).otherwise(0))


def sum_or_null(condition: Column, amount: Column) -> Column:
    """Sum over the rows that meet the condition; NULL when none does."""
    return F.sum(F.when(condition, amount))


def sum_or_zero(condition: Column, amount: Column) -> Column:
    """Sum over the rows that meet the condition, a row that does not counting as 0."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def null_safe_total(columns: Iterable[str]) -> Column:
    """Row-wise sum with NULL taken as 0."""
    terms = [F.coalesce(F.col(name), F.lit(0)) for name in columns]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def count_distinct_if(
    df: DataFrame, key: str, account: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """Per key and condition, the number of distinct accounts that meet the condition.

    Grouping by (key, account) first makes each count a plain sum of flags. One conditional
    distinct count per condition would make Spark copy every row once per condition.
    """
    accounts = df.groupBy(key, account).agg(
        *[any_flag(condition).alias(name) for name, condition in conditions.items()]
    )
    known = F.col(account).isNotNull()
    return accounts.groupBy(key).agg(
        *[F.count_if(known & (F.col(name) == 1)).alias(name) for name in conditions]
    )


# Product family, name part, account flag it needs and balance column.
FAMILIES = (
    ("TABUNGAN", "tab", "NON_DEPO", "credit_balance"),
    ("GIRO", "giro", "NON_DEPO", "credit_balance"),
    ("DEPOSITO", "dep", "DEPO", "deposit_balance"),
)


@dataclass(frozen=True)
class Cell:
    """One cell of the measure matrix: rows of one family, state and currency."""

    number: int
    short: str
    active: bool
    local: bool  # in IDR

    @property
    def name(self) -> str:
        state = "aktif" if self.active else "nonaktif"
        return f"saving_{self.short}_{state}_{'idr' if self.local else 'nonidr'}"


CELLS = tuple(
    Cell(number, short, active, local)
    for number, ((_, short, _, _), active, local) in enumerate(
        combinations_of(FAMILIES, (True, False), (True, False))
    )
)
# Savings and current accounts.
CASA_CELLS = tuple(cell for cell in CELLS if cell.short != "dep")


def active_cells(cells: Sequence[Cell]) -> tuple[Cell, ...]:
    return tuple(cell for cell in cells if cell.active)


def with_cells(df: DataFrame) -> DataFrame:
    """Add ``_cell``, the number of the cell a row is in, and ``_amount``, its balance there.

    A row is in one cell at most; the number is NULL when it is in none.
    """
    family, amount = F, F
    for i, (name, _, flag, balance) in enumerate(FAMILIES):
        is_family = (F.col("flag") == flag) & (F.col("keterangan") == name)
        family = family.when(is_family, F.lit(i))
        amount = amount.when(F.col("_family") == i, F.col(balance))
    inactive = (F.col("status") != ACTIVE).cast("int")
    foreign = (F.col("curr_type") != "IDR").cast("int")
    return (
        df.withColumn("_family", family)
        .withColumns({"_cell": F.col("_family") * 4 + inactive * 2 + foreign, "_amount": amount})
        .drop("_family")
    )


def in_cells(cells: Sequence[Cell]) -> Column:
    return F.col("_cell").isin(*[cell.number for cell in cells])


def accounts_by_cell(
    df: DataFrame, key: str, account: str, cells: Sequence[Cell]
) -> DataFrame:
    """One row per key, cell and account, with the balance of the account there.

    As a row is in one cell at most, it travels as (key, account, cell, amount) whatever the
    number of measures. Grouping by all of these turns distinct counts into plain ones and
    spreads the accounts of a large key over many tasks. A row in none of the cells just
    keeps its key in the result.
    """
    here = in_cells(cells)
    rows = with_cells(df).select(
        key,
        F.when(here, F.col("_cell")).alias("_cell"),
        F.when(here, F.col(account)).alias("_account"),
        F.when(here, F.col("_amount")).alias("_amount"),
    )
    return rows.groupBy(key, "_account", "_cell").agg(F.sum("_amount").alias("_amount"))


def measure_matrix(
    df: DataFrame, key: str, account: str, cells: Sequence[Cell] = CELLS
) -> DataFrame:
    """Distinct accounts and balance of every cell per ``key``, in one pass over ``df``.

    Both groupings combine rows before they shuffle. A row without account takes part in the
    sums only.
    """
    measures = []
    for cell in cells:
        hit = F.col("_cell") == cell.number
        measures += [
            F.count_if(hit & F.col("_account").isNotNull()).alias(f"{cell.name}_count"),
            sum_or_null(hit, F.col("_amount")).alias(f"{cell.name}_sum"),
        ]
    return accounts_by_cell(df, key, account, cells).groupBy(key).agg(*measures)


def measure_totals(
    df: DataFrame, key: str, account: str, cells: Sequence[Cell], count: str, total: str
) -> DataFrame:
    """The sums of the counts and of the balances of the matrix over ``cells``, without it."""
    return (
        accounts_by_cell(df, key, account, cells)
        .groupBy(key)
        .agg(
            F.count("_account").alias(count),
            F.coalesce(F.sum("_amount"), F.lit(0)).alias(total),
        )
    )


def number_or_null(value: Column) -> Column:
    """The value as a double, NaN as NULL."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def median_by(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Exact median of every column per group; NaN is taken as missing.

    Meant for groups of bounded size, such as scoring batches.
    """
    return df.groupBy(group).agg(
        *[F.median(number_or_null(F.col(c))).alias(c) for c in columns]
    )
