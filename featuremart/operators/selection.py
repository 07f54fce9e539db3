"""Exact medians of whole columns, with no task that holds a column's values.

Values fall into ordered intervals, and one aggregation counts those of all columns at once. A running
count over the intervals, a bounded number of them, tells in which one a rank lies; the next pass looks
only at the values of that interval, cut finer. It ends when an interval holds one value, however often.

The first pass cuts by sign and magnitude, PER_OCTAVE intervals between a number and its double, so
that columns of any spread are cut alike; the next ones cut evenly between the least and the greatest value found.
Both are monotone in floating point, so the order of intervals is that of the values. Four or five
passes do for any doubles; each reads the numbers alone, from a written copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.aggregates import number_or_null
from featuremart.operators.scratch import stage

PER_OCTAVE = 16
#: Above the logarithm of any double; intervals of positive numbers are positive.
OFFSET = 1100 * PER_OCTAVE
CUTS = 1 << 14


def magnitude_interval(value: Column) -> Column:
    """Place of a number among intervals by sign and magnitude; zero and the infinities have their own."""
    size = F.abs(value)
    place = F.when(size == 0, 0).when(size == float("inf"), 2 * OFFSET).otherwise(
        F.floor(F.log2(size) * PER_OCTAVE) + OFFSET
    )
    return F.when(value < 0, -place).otherwise(place).cast("int")


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per number that is there: place of its column, value."""
    cells = [
        F.struct(F.lit(i).alias("name"), number_or_null(F.col(f"`{c}`").cast("double")).alias("value"))
        for i, c in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def _intervals(values: DataFrame) -> DataFrame:
    return values.groupBy("name", "rank", "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _holding(intervals: DataFrame) -> DataFrame:
    """The interval of each rank, and the rank inside it; one row per column and rank."""
    before = Window.partitionBy("name", "rank").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        intervals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("name", "rank", (F.col("rank") - F.col("before")).alias("inner"), "low", "high")
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The median of each column as ``F.median`` gives it: nulls and NaN left out, None without any value.

    Two ranks for each column are all that comes to the driver.
    """
    numbers = stage(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]), "numbers")
    values = _values(numbers, columns)
    counted = values.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {row["name"]: row["n"] for row in counted}
    # (column, rank asked for) -> rank among the values from low to high; no bounds at first.
    wanted = {(c, r): (r, None, None) for c, n in sizes.items() for r in {(n - 1) // 2, n // 2}}
    found: dict[tuple[int, int], float] = {}
    while wanted:
        keys = list(wanted)
        cases = []
        for i, (column, _) in enumerate(keys):
            rank, low, high = wanted[keys[i]]
            value = F.col("value")
            mine = F.col("name") == column
            if low is None:
                place = magnitude_interval(value)
            else:
                mine = mine & value.between(low, high)
                # Both bounds have one sign and nearly one size, so their difference is a number.
                place = F.floor((value - low) / (high - low) * CUTS).cast("int")
            cases.append(F.when(mine, F.struct(
                F.lit(i).alias("name"), F.lit(rank).cast("long").alias("rank"), place.alias("place"), "value"
            )))
        cut = values.select(F.explode(F.array_compact(F.array(*cases))).alias("cell")).select("cell.*")
        held = _holding(_intervals(cut)).collect()
        wanted_now = {}
        for row in held:
            key = keys[row["name"]]
            if row["low"] == row["high"]:
                found[key] = row["low"]
            else:
                wanted_now[key] = (row["inner"], row["low"], row["high"])
        wanted = wanted_now
    out: dict[str, float | None] = dict.fromkeys(columns)
    for i, name in enumerate(columns):
        if i in sizes:
            low, high = found[i, (sizes[i] - 1) // 2], found[i, sizes[i] // 2]
            out[name] = low if low == high else 0.5 * low + 0.5 * high
    return out
