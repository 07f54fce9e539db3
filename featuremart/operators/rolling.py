"""Totals over a window of days that moves, kept from run to run.

Totals of each day by key are kept as snapshots of a table of days. The totals of a window are kept
too, together with the days they hold and the version of each. When the window moves, the days that
come in are added and those that go are subtracted, so a run reads the kept totals and the days at both
ends, not the window. A day that was written again, for rows that came late, is one more version: the
one held is subtracted and the new one added.

Sums are of decimals and whole numbers, which take subtraction exactly. ``entries`` counts what a key's
totals are of; a key without entries in the window has no row. The totals and the list of days are
published in one step, so they always fit each other, and of two runs that move a window at once one
gets a ``Conflict``. Where a version that is held is no longer there, or where most days change, the
window is summed from its days again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators import publish
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.snapshots import NoSnapshot

ENTRIES = "entries"
MONEY = "decimal(38,2)"


class MovingTotals:
    """Daily totals in table ``name`` and windows over them in ``name``_windows.

    ``key`` names the key; ``measures`` maps each sum to its type, MONEY or ``bigint``.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, measures: dict[str, str], folder: str | None = None):
        self.spark, self.days, self.windows = spark, name, f"{name}_windows"
        self.key, self.measures = key, {**measures, ENTRIES: "bigint"}
        self.folders = {t: f"{folder}/{t}" if folder else None for t in (self.days, self.windows)}

    def _typed(self, df: DataFrame, sign: int = 1) -> DataFrame:
        sums = [(F.coalesce(F.col(m), F.lit(0)) * sign).cast(t).alias(m) for m, t in self.measures.items()]
        return df.select(self.key, *sums)

    def put_day(self, day: str, totals: DataFrame, modified: datetime) -> None:
        """Keep the totals of one day (``yyyyMMdd``), in place of those kept before; one row per key."""
        # An older version stays as long as a window may hold it.
        write_snapshot(
            self._typed(totals), self.days, day, modified, statistics=False,
            location=self.folders[self.days], keep=3,
        )

    def kept_days(self, start: str, end: str) -> dict[str, int]:
        """The version of each kept day of a range, both ends included; only the catalog is asked."""
        found = publish.newest_numbers(self.spark, self.days)
        return {day: found[day] for day in sorted(found) if start <= day <= end}

    def missing_days(self, days: Iterable[str]) -> list[str]:
        """Those of ``days`` that are not kept yet, in order."""
        found = publish.newest_numbers(self.spark, self.days)
        return [day for day in sorted(days) if day not in found]

    def _day(self, day: str, number: int, sign: int) -> DataFrame:
        return self._typed(publish.read_snapshot(self.spark, self.days, day, number), sign)

    def held(self, window: str) -> tuple[publish.Version, dict[str, int]]:
        """The published version of a window and the version of each day in it."""
        if not self.spark.catalog.tableExists(self.windows):
            return publish.Version(), {}
        version = publish.current(self.spark, self.windows, window)
        if not version.number:
            return version, {}
        rows = publish.read_snapshot(self.spark, self.windows, window, version.number)
        found = rows.filter("batch = 'days'").select("day", "day_version").collect()
        return version, {row.day: row.day_version for row in found}

    def totals(self, window: str) -> DataFrame:
        """The totals of a window as it was last moved: key, measures and entries."""
        rows = publish.read_snapshot(self.spark, self.windows, window)
        return rows.filter("batch = 'totals'").select(self.key, *self.measures)

    def change(self, window: str, start: str, end: str) -> tuple[list[tuple[str, int, int]], bool, publish.Version, dict[str, int]]:
        """What a move takes: (day, version, sign) to sum, whether upon the kept totals, and both states."""
        version, held = self.held(window)
        wanted = self.kept_days(start, end)
        plus = wanted.items() - held.items()
        minus = held.items() - wanted.items()
        there = all(number in publish.numbers(self.spark, self.days, day) for day, number in minus)
        upon = bool(version.number) and there and len(plus) + len(minus) < len(wanted)
        steps = [(d, n, 1) for d, n in sorted(plus)] + [(d, n, -1) for d, n in sorted(minus)]
        if not upon:
            steps = [(d, n, 1) for d, n in wanted.items()]
        return steps, upon, version, wanted

    def move(self, window: str, start: str, end: str, modified: datetime) -> DataFrame:
        """Move a window to the days from ``start`` to ``end`` and give its totals."""
        steps, upon, version, wanted = self.change(window, start, end)
        if upon and not steps:
            return self.totals(window)
        parts = [self._day(*step) for step in steps]
        if upon:
            parts.append(self.totals(window))
        if not parts:
            raise NoSnapshot(f"{self.days} keeps no day from {start} to {end}")
        summed = (
            reduce(DataFrame.unionByName, parts)
            .groupBy(self.key)
            .agg(*[F.sum(m).cast(t).alias(m) for m, t in self.measures.items()])
            .filter(F.col(ENTRIES) != 0)
        )
        listed = self.spark.createDataFrame(list(wanted.items()), "day string, day_version bigint")
        rows = summed.withColumn("batch", F.lit("totals")).unionByName(
            listed.withColumn("batch", F.lit("days")), allowMissingColumns=True
        )
        write_snapshot(
            rows, self.windows, window, modified, statistics=False,
            location=self.folders[self.windows], former=version if version.number else None,
        )
        return self.totals(window)


def day_names(start: str, end: str) -> Sequence[str]:
    """All days of a range as ``yyyyMMdd``."""
    first, last = (datetime.strptime(d, "%Y%m%d") for d in (start, end))
    return [f"{first + timedelta(days=i):%Y%m%d}" for i in range((last - first).days + 1)]
