"""Dates of a run, derived from the run date alone so that every run can be repeated."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days of the month on which the marts are built, lags in days.
RUN_DAYS = (6, 20)
DATA_LAG_DAYS = 5
CARD_LAG_DAYS = 2


def compact(day: date) -> str:
    """The ``yyyyMMdd`` text that names a daily snapshot."""
    return day.strftime("%Y%m%d")


@dataclass(frozen=True)
class RunParams:
    """All snapshot names and cutoffs of one run."""

    run_date: date

    @property
    def ds(self) -> str:
        """Snapshot written by the marts of this run."""
        return compact(self.run_date)

    @property
    def month(self) -> str:
        return self.run_date.strftime("%Y%m")

    @property
    def is_run_day(self) -> bool:
        return self.run_date.day in RUN_DAYS

    @property
    def data_date(self) -> date:
        """Last day whose data is taken as complete."""
        return self.run_date - timedelta(days=DATA_LAG_DAYS)

    @property
    def data_ds(self) -> str:
        return compact(self.data_date)

    @property
    def cutoff(self) -> str:
        """Accounts and cards opened on or after this ``yyyy-MM-dd`` day are not yet counted."""
        return self.data_date.isoformat()

    @property
    def card_ds(self) -> str:
        """Snapshot written by the card holder master."""
        return compact(self.run_date - timedelta(days=CARD_LAG_DAYS))

    @property
    def card_cutoff(self) -> str:
        return self.run_date.isoformat()

    def days_before(self, days: int) -> str:
        """Snapshot name ``days`` days before the last complete day."""
        return compact(self.data_date - timedelta(days=days))


def run_params_columns(run_date: Column, offsets: tuple[int, ...] = (30, 90, 180)) -> list[Column]:
    """The same values as columns, for a column of run dates."""
    day = run_date.cast("date")
    lagged = F.date_sub(day, DATA_LAG_DAYS)
    return [
        F.date_format(day, "yyyyMMdd").alias("ds"),
        F.date_format(day, "yyyyMM").alias("month"),
        F.date_format(lagged, "yyyyMMdd").alias("data_ds"),
        F.date_format(lagged, "yyyy-MM-dd").alias("cutoff"),
        F.date_format(F.date_sub(day, CARD_LAG_DAYS), "yyyyMMdd").alias("card_ds"),
        *[
            F.date_format(F.date_sub(lagged, n), "yyyyMMdd").alias(f"l{n}d")
            for n in offsets
        ],
        F.dayofmonth(day).isin(*RUN_DAYS).cast("int").alias("is_run_day"),
    ]
