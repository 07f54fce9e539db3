"""First or last row per key, and row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading hex digits of the hash that name a bucket: 16 ** 3 = 4096 buckets. An id has nine
# digits, so a bucket holds some 250,000 rows at most.
BUCKET_DIGITS = 3
SEQUENCE_DIGITS = 9


def keep_first(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps one row per key and task before it shuffles, so a key with very many rows
    sends only a few. The order has to be total for the result to be repeatable.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def number_rows(
    df: DataFrame, by: Sequence[str], name: str = "row_number", ties: Sequence[str] = ()
) -> DataFrame:
    """Number the rows 1..n without passing them through one task.

    The order is that of a hash of the columns ``by``: as mixed as a random order, yet the same
    in every run; rows alike in those follow the columns ``ties``. Together they must tell the rows
    apart. Rows are numbered inside buckets of the hash; each bucket starts where the sizes of the
    buckets before it end.
    """
    order_hash = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in by]))
    bucket = F.substring(order_hash, 1, BUCKET_DIGITS)
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    # This window sees one row per bucket, 4096 at most.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *by, *ties)
    return (
        df.withColumns({"_hash": order_hash, "_bucket": bucket})
        .withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_hash", "_bucket", "_place", "_start")
    )


def row_id(ds: str, sequence: Column, source: str = "02", width: int = SEQUENCE_DIGITS) -> Column:
    """Id: snapshot, source code, sequence number of ``width`` digits (19 characters in all)."""
    fits = sequence < F.lit(10**width)
    digits = F.when(fits, F.lpad(sequence.cast("string"), width, "0")).otherwise(
        F.raise_error(F.lit(f"more rows than an id of {width} digits can number"))
    )
    return F.concat(F.lit(ds), F.lit(source), digits)


def sequence_of(row_id_column: Column, width: int = SEQUENCE_DIGITS) -> Column:
    """Sequence number inside an id."""
    return F.substring(row_id_column, -width, width).cast("bigint")


def batch_of(sequence: Column, batch_size: int) -> Column:
    """Batch number 1, 2, ... of a sequence number that starts at 1."""
    return (F.floor((sequence - 1) / F.lit(batch_size)) + 1).cast("int")


def batch_name(batch: Column, rows: int, batch_size: int) -> Column:
    """Batch number as text, padded with zeros to the width of the number of batches."""
    total = max(1, -(-rows // batch_size))
    return F.lpad(batch.cast("string"), len(str(total)), "0")
