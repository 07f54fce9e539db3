"""Where queries and their oracle texts are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.oracles.parts import with_parts
from featuremart.sources.bank import Bank

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    """Register a function of a ``Bank`` under its own name, with its oracle text."""

    def add(build: Callable[[Bank], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: build(Bank(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_parts(oracle)
        return build

    return add


def stamped(name: str) -> Column:
    """A timestamp as text, so that both engines show it alike."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def rounded(name: str) -> Column:
    """A probability to nine digits; the last bits of ``exp`` differ between engines."""
    return F.round(name, 9).alias(name)
