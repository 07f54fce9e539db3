"""Cleansing of padded, blank and badly typed text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

# Partition columns are never rewritten: a rewritten one can no longer prune partitions.
PARTITION_COLUMNS = ("ds", "batch", "year", "month", "day")


def cleansed(text: Column) -> Column:
    """Trim spaces; text that is empty or spells NAN becomes NULL.

    The length is known without reading the text, so only three-byte texts are folded.
    """
    trimmed = F.trim(text)
    size = F.octet_length(trimmed)
    return F.when((size > 0) & ((size != 3) | (F.upper(trimmed) != "NAN")), trimmed)


def cleanse_table(df: DataFrame, exclude: Iterable[str] = PARTITION_COLUMNS) -> DataFrame:
    """Cleanse every text column of ``df`` except the named ones, in one projection."""
    kept = {name.lower() for name in exclude}
    return df.select(
        *[
            cleansed(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, StringType) and field.name.lower() not in kept
            else F.col(f"`{field.name}`")
            for field in df.schema
        ]
    )


def upper_trimmed(text: Column) -> Column:
    return F.trim(F.upper(text))


def digits_of_id(text: Column, min_digits: int = 16) -> Column:
    """Digits of a national id, NULL when fewer than ``min_digits`` are left."""
    digits = F.regexp_replace(text.cast("string"), r"[^\p{Nd}]", "")
    return F.when(F.length(digits) >= min_digits, digits)


def as_int(value: Column) -> Column:
    """Whole number in a text, NULL when there is none."""
    return F.trim(value.cast("string")).try_cast("int")


def int_column(df: DataFrame, name: str) -> Column:
    """A column as whole numbers; one that holds them already is taken as it is."""
    if isinstance(df.schema[name].dataType, IntegralType):
        return F.col(name)
    return as_int(F.col(name))


def as_account_key(value: Column) -> Column:
    """64-bit account number; text that is no number gives NULL and so never joins."""
    return F.trim(value.cast("string")).try_cast("bigint")


def as_money(df: DataFrame, name: str) -> Column:
    """Amount column that sums exactly: floating point is read as two decimals.

    A floating-point sum depends on the order in which tasks finish; a decimal one does not.
    """
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return F.col(name).cast("decimal(18,2)")
    return F.col(name)
