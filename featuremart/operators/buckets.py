"""Marts bucketed by a key: joins and groupings on it read them as they lie, without a shuffle.

The buckets belong to the table, so all its snapshots agree. A version of a snapshot is written to a
folder of its own (see ``publish``), while Spark writes buckets through a table only: the folder is
filled by a table that exists for that write, and whose files stay when it is dropped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from featuremart.functions.cleansing import cleansed


@dataclass(frozen=True)
class Buckets:
    """``number`` buckets by the hash of ``column``."""

    column: str
    number: int


def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    """How a catalog table is bucketed; None when it is not, or by several columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name IN ('Num Buckets', 'Bucket Columns')")
    found = {row.col_name: row.data_type for row in rows.collect()}
    columns = [name.strip().strip("`") for name in found.get("Bucket Columns", "").strip("[]").split(",")]
    if columns == [""] or len(columns) > 1:
        return None
    return Buckets(columns[0], int(found["Num Buckets"]))


def with_clean_key(df: DataFrame, buckets: Buckets) -> DataFrame:
    """The key cleansed. A reader who cleansed it could no longer use the buckets."""
    if not isinstance(df.schema[buckets.column].dataType, StringType):
        return df
    return df.withColumn(buckets.column, cleansed(F.col(buckets.column)))


def write_buckets(df: DataFrame, table: str, folder: str, buckets: Buckets, *partitions: str) -> None:
    """Write ``df`` to ``folder`` as the buckets of ``table``, one file per bucket that has rows.

    Rows stream into the file of their bucket, however many share a key.
    """
    spark = df.sparkSession
    filler = f"{table}__{uuid.uuid4().hex}"
    writer = df.repartition(buckets.number, buckets.column).write.format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    try:
        writer.bucketBy(buckets.number, buckets.column).option("path", folder).saveAsTable(filler)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {filler}")
