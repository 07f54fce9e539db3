"""Writing marts: one partition per run, replaced as a whole when a run is repeated."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators import publish
from featuremart.operators.buckets import Buckets, buckets_of, with_clean_key, write_buckets
from featuremart.operators.publish import partition_spec
from featuremart.operators.scratch import forget

TARGET_FILE_BYTES = 128 * 1024 * 1024


def audit_columns(
    df: DataFrame, ds: str, modified: datetime, batch: str | None = None
) -> DataFrame:
    """Append the snapshot name, the batch if there is one, and the time of the run."""
    stamps = {"ds": F.lit(ds), "modified_date": F.lit(modified)}
    if batch is not None:
        stamps["batch"] = F.lit(batch)
    return df.withColumns(stamps)


def file_count(total_bytes: Column, target_bytes: int = TARGET_FILE_BYTES) -> Column:
    """Files of about ``target_bytes`` that hold ``total_bytes``, at least one."""
    return F.greatest(F.lit(1), F.floor(total_bytes / F.lit(target_bytes)).cast("int"))


def sample_rows(df: DataFrame, fraction: float, by: Sequence[str]) -> DataFrame:
    """Share of the rows, chosen by a hash of the columns ``by``.

    A row is in the sample or not whatever the partitioning, so a recomputed task takes the
    same rows again.
    """
    limit = F.lit(f"{round(fraction * 16**8):08x}")
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in by])
    return df if fraction >= 1 else df.filter(F.substring(F.md5(text), 1, 8) < limit)


def sorted_output(df: DataFrame, *columns: str) -> DataFrame:
    """Total order over all files: ranges of the columns, sorted inside each."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def drop_partition(spark: SparkSession, table: str, **values: str) -> None:
    """Drop one partition of a catalog table, if it is there."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_spec(values)})")


def write_snapshot(
    df: DataFrame,
    table: str,
    ds: str,
    modified: datetime,
    batch: str | None = None,
    skip_if_empty: bool = False,
    rebalance: bool = True,
    statistics: bool = True,
    location: str | None = None,
    former: publish.Version | None = None,
    keep: int = 2,
    buckets: Buckets | None = None,
) -> bool:
    """Replace one snapshot of a catalog table and tell whether anything was written.

    With ``batch`` one (ds, batch) partition is replaced. Without it the whole snapshot is; a
    column ``batch`` in ``df`` then spreads it over batch partitions, all in one job, and batches of
    an earlier run that the result lacks are dropped. The table is made when it is not there yet. A
    result whose columns are not those of the table is an error.

    Rows go to a folder of their own and are published in one step (see ``publish``). A run that fails
    before that leaves the old snapshot as it was, and so does one that finds that another writer has
    published the snapshot since ``former``, the version at the start unless given: a ``Conflict``.
    ``keep`` versions stay for readers that are still at work. A result without rows empties the snapshot.

    ``rebalance`` lets Spark size the files from what the shuffle measured (set the size with
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and split a partition that is too
    large; no trial run is needed. Turn it off to keep rows in the order they come in.

    ``buckets`` is how a table that is not there yet is made; one that is there stays as it is. The key
    of a bucketed table is cleansed, and its files are its buckets.
    """
    spark = df.sparkSession
    in_batches = batch is not None or "batch" in df.columns
    spread = in_batches and batch is None
    partitions = ["ds", "batch"] if in_batches else ["ds"]
    out = audit_columns(df, ds, modified, batch)
    if not spark.catalog.tableExists(table):
        if skip_if_empty and df.isEmpty():
            return False
        empty = out.filter(F.lit(False)).write.partitionBy(*partitions).format("parquet")
        if buckets:
            empty = empty.bucketBy(buckets.number, buckets.column)
        (empty.option("path", location) if location else empty).saveAsTable(table)
    columns = spark.table(table).columns
    if set(columns) != set(out.columns):
        odd = sorted(set(columns) ^ set(out.columns))
        raise ValueError(f"{table} and the result differ in the columns {odd}")
    fixed = {"ds": ds} if batch is None else {"ds": ds, "batch": batch}
    former = former or publish.adopt(spark, table, ds)
    out = out.select(*[c for c in columns if c not in fixed])
    folder = publish.new_folder(spark, table, ds)
    free = [name for name in partitions if name not in fixed]
    buckets = buckets_of(spark, table)
    if buckets:
        write_buckets(with_clean_key(out, buckets), table, folder, buckets, *free)
    else:
        if rebalance:
            out = out.hint("rebalance", *map(F.col, free))
        out.write.partitionBy(*free).parquet(folder)
    if skip_if_empty and spark.read.schema(out.schema).parquet(folder).isEmpty():
        forget(spark, folder)
        return False
    if spread:
        folders = publish.written_batches(spark, folder, out.schema)
        if None in folders:
            forget(spark, folder)
            raise ValueError("a row has no batch")
    elif batch is not None:
        folders = {**former.folders, batch: folder}
    else:
        folders = {publish.WHOLE: folder}
    try:
        publish.commit(spark, table, ds, former, folders)
    except publish.Conflict:
        forget(spark, folder)
        raise
    publish.settle(spark, table, ds)
    publish.vacuum(spark, table, ds, keep)
    if statistics:
        for_partitions = ", ".join([partition_spec(fixed), *free])
        spark.sql(f"ANALYZE TABLE {table} PARTITION ({for_partitions}) COMPUTE STATISTICS")
    return True


def partition_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per partition, what the statistics of a partition state."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
