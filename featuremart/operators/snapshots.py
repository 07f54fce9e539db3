"""Choosing and reading partitions."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


class NoSnapshot(LookupError):
    """No partition fits the request."""


def list_partitions(spark: SparkSession, table: str) -> list[dict[str, str]] | None:
    """Partitions of a catalog table, newest text first; None when it has none.

    Only the catalog is asked. A partition without a value is left out.
    """
    if not spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
        F.col("col_name") == "# Partition Information"
    ).take(1):
        return None
    names = [
        row.partition
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
        if HIVE_NULL not in row.partition
    ]
    if not names:
        return None
    # Names of columns and values are escaped as in paths.
    return [
        dict(map(unquote, part.split("=", 1)) for part in name.split("/"))
        for name in sorted(names, reverse=True)
    ]


def latest_partition(spark: SparkSession, table: str) -> dict[str, str]:
    """Newest partition of a catalog table."""
    found = list_partitions(spark, table)
    if not found:
        raise NoSnapshot(f"{table} has no partitions")
    return found[0]


def partition_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct partitions of a DataFrame as ``k=v/k=v`` text and as columns."""
    text = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in columns])
    return (
        df.select(*columns)
        .dropna(how="any")
        .distinct()
        .select(text.alias("partition"), *columns)
    )


def latest_snapshot(df: DataFrame, column: str = "ds") -> str:
    """Greatest snapshot name in ``df``; reads the snapshot column only."""
    found = df.agg(F.max(column)).first()[0]
    if found is None:
        raise NoSnapshot(f"no snapshot in column {column}")
    return found


def nearest_snapshot(df: DataFrame, upto: str, column: str = "ds") -> str:
    """Latest non-empty snapshot at or before ``upto``; reads the snapshot column only."""
    found = df.filter(F.col(column) <= upto).agg(F.max(column)).first()[0]
    if found is None:
        raise NoSnapshot(f"no snapshot up to {upto}")
    return found


def nearest_partition(spark: SparkSession, table: str, upto: str) -> str:
    """``nearest_snapshot`` for a catalog table.

    The catalog names the candidates; the newest one that holds a row is taken, which as a rule is
    the first one looked into. While nothing is found, twice as many are looked into at once: n empty
    ones cost about log2(n) jobs, which read no column but the snapshot's name.
    """
    names = {found["ds"] for found in list_partitions(spark, table) or ()}
    older = sorted((n for n in names if n <= upto), reverse=True)
    df, size = spark.read.table(table), 1
    if older and not snapshot(df, older[0]).isEmpty():
        return older[0]
    while older := older[size:]:
        size = min(2 * size, len(older))
        some = df.filter(F.col("ds").between(older[size - 1], older[0]))
        found = some.agg(F.max("ds")).first()[0]
        if found is not None:
            return found
    raise NoSnapshot(f"{table} has no snapshot up to {upto}")


def snapshot(df: DataFrame, ds: str, column: str = "ds") -> DataFrame:
    """Rows of one snapshot. The test is on the raw column, so it prunes partitions."""
    return df.filter(F.col(column) == F.lit(ds))


def newest_rows(df: DataFrame, upto: str | None = None, column: str = "ds") -> DataFrame:
    """Rows of the newest snapshot (at or before ``upto``), looked up inside the query.

    Same rows as ``latest_snapshot`` or ``nearest_snapshot`` followed by ``snapshot``, without
    a job of its own before the plan exists. For a table whose catalog lists its partitions
    the named snapshot is better, as it prunes when the query is planned.
    """
    candidates = df if upto is None else df.filter(F.col(column) <= F.lit(upto))
    return df.filter(F.col(column) == candidates.agg(F.max(column)).scalar())


def ledger_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Ledger rows of the days ``start`` to ``end`` (``yyyyMMdd``, both included).

    The range on the year alone adds nothing to the result; a metastore can answer it, while
    the composed day is tested on the partitions that are left.
    """
    day = F.concat("year", "month", "day")
    return df.filter(F.col("year").between(start[:4], end[:4])).filter(day.between(start, end))


def inputs_ready(df_by_name: dict[str, DataFrame], ds: str) -> DataFrame:
    """One row per input: does it hold rows of snapshot ``ds``?"""
    checks = [
        df.filter(F.col("ds") == F.lit(ds))
        .limit(1)
        .agg(F.count(F.lit(1)).cast("int").alias("is_ready"))
        .select(F.lit(name).alias("input"), "is_ready")
        for name, df in df_by_name.items()
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionAll(check)
    return out
