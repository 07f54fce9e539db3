"""Joins that stay even when one key holds a large share of a side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    right_keys: DataFrame | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Join on one shared column so that adaptive execution can split a hot key of either side.

    Adaptive execution splits a large partition by the map tasks that wrote it, whatever its rows
    hold, and repeats the other side's partition per piece; the sessions of ``build_session`` also
    force that where the next step needs the rows together again (another session has to set
    ``spark.sql.adaptive.forceOptimizeSkewedJoin``, or such joins stay whole). It can do so on both
    sides of an inner join, but on the left of a left join only. So a left join is made of two: the
    inner join, and the left rows whose key the right side lacks, for which its distinct keys do.
    Both read the same shuffle of the left rows that have a key. The result is that of the plain
    join, null keys included.

    The two sides stand in the plan more than once, so a chain of such joins grows fast. Where the
    right side has one row per key, a plain left join does. ``right_keys`` are the keys of the right
    side where there is a shorter way to them; ``null_keys`` False says that the left has no null key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported: {how}")
    if how == "inner":
        return left.join(right, on)
    keyed = left.filter(F.col(on).isNotNull()) if null_keys else left
    known = (right if right_keys is None else right_keys).select(on).distinct()
    alone = keyed.join(known, on, "left_anti")
    if null_keys:
        alone = alone.unionByName(left.filter(F.col(on).isNull()))
    return keyed.join(right, on).unionByName(alone, allowMissingColumns=True)
