"""Date arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_day(value: Column | str) -> Column:
    """A ``yyyyMMdd`` Python text as a date literal; a column is taken as it is."""
    return F.to_date(F.lit(value), "yyyyMMdd") if isinstance(value, str) else value


def birth_day(text: Column) -> Column:
    """Date in a ``yyyy-MM-dd`` text, NULL when it is no such date."""
    return F.try_to_date(text, "yyyy-M-d")


def age_years(birth: Column, as_of: Column | str) -> Column:
    """Completed years from ``birth`` (a date column) to ``as_of``.

    A birthday on 29 February is reached on 1 March of a common year, which
    ``months_between`` does not give.
    """
    day = as_day(as_of)
    before_birthday = F.date_format(day, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(day) - F.year(birth) - before_birthday.cast("int")


def local_time(utc: Column, hours: int = 7) -> Column:
    """Shift a UTC timestamp to local time (UTC+7 unless told otherwise)."""
    return utc + F.make_dt_interval(hours=F.lit(hours))


def before(moment: Column, cutoff: str) -> Column:
    """True when ``moment`` is before the start of the ``yyyy-MM-dd`` day ``cutoff``."""
    return moment < F.lit(cutoff).cast("timestamp_ntz")
