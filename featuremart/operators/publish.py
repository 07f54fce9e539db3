"""Publishing a snapshot in one step, however many partitions it has.

The data of a new version lies in a folder of its own, which no reader knows. A log table beside the
mart names the versions of each snapshot: one catalog partition (ds, version), whose rows list the
folder of every batch. Adding that partition is the switch. The catalog lets only one writer add the
version that follows the one it started from; another one gets a ``Conflict`` and has changed nothing.

``read_snapshot`` reads the newest version in the log, so it sees a snapshot before or after a switch,
never between. After the switch ``settle`` points the mart's own partitions at the folders, for readers
that ask the catalog. Of a snapshot with one partition that is one catalog call, too. A writer that dies
between the two leaves the old partitions there; the next writer, or a call of ``settle``, brings them up.

Folders stay until ``vacuum``, so readers that planned before a switch can finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featuremart.operators.scratch import forget
from featuremart.operators.snapshots import NoSnapshot, list_partitions

#: Names the whole of a snapshot that has no batches.
WHOLE = ""


class Conflict(RuntimeError):
    """Another writer has published the snapshot since this one started."""


@dataclass(frozen=True)
class Version:
    """A published version: its number (0: none yet) and the folder of each batch."""

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)


def partition_spec(values: Mapping[str, str]) -> str:
    quoted = {n: v.replace("\\", "\\\\").replace("'", "\\'") for n, v in values.items()}
    return ", ".join(f"{name}='{value}'" for name, value in quoted.items())


def log_table(table: str) -> str:
    return f"{table}__versions"


def location(spark: SparkSession, table: str, values: Mapping[str, str] | None = None) -> str:
    """Where the catalog says a table or one of its partitions lies."""
    part = f" PARTITION ({partition_spec(values)})" if values else ""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}{part}").filter("col_name = 'Location'").collect()
    return rows[0].data_type


def new_folder(spark: SparkSession, table: str, ds: str) -> str:
    """A folder for a version; readers of the table's own folder pass it over."""
    return f"{location(spark, table)}/_versions/{quote(ds, safe='')}-{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, table: str, ds: str) -> list[int]:
    if not spark.catalog.tableExists(log_table(table)):
        return []
    found = spark.sql(f"SHOW PARTITIONS {log_table(table)} PARTITION ({partition_spec({'ds': ds})})")
    return sorted(int(row.partition.rsplit("=", 1)[1]) for row in found.collect())


def newest_numbers(spark: SparkSession, table: str) -> dict[str, int]:
    """The newest version of every published snapshot, from one question to the catalog."""
    if not spark.catalog.tableExists(log_table(table)):
        return {}
    found: dict[str, int] = {}
    for values in list_partitions(spark, log_table(table)) or ():
        found[values["ds"]] = max(found.get(values["ds"], 0), int(values["version"]))
    return found


def _load(spark: SparkSession, table: str, ds: str, number: int) -> Version:
    rows = spark.table(log_table(table)).filter(
        (F.col("ds") == ds) & (F.col("version") == _name(number))
    )
    return Version(number, {row.batch: row.folder for row in rows.select("batch", "folder").collect()})


def _name(number: int) -> str:
    return f"{number:012d}"


def current(spark: SparkSession, table: str, ds: str) -> Version:
    """The newest version of a snapshot; number 0 where none was published."""
    numbers = _numbers(spark, table, ds)
    return _load(spark, table, ds, numbers[-1]) if numbers else Version()


def commit(spark: SparkSession, table: str, ds: str, former: Version, folders: Mapping[str, str]) -> Version:
    """Publish ``folders`` as the version after ``former``, or raise ``Conflict``."""
    log = log_table(table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {log} (batch STRING, folder STRING) USING parquet "
        "PARTITIONED BY (ds STRING, version STRING)"
    )
    path = new_folder(spark, table, ds) + "-list"
    rows = spark.createDataFrame(list(folders.items()), "batch string, folder string")
    rows.coalesce(1).write.parquet(path)
    values = partition_spec({"ds": ds, "version": _name(former.number + 1)})
    try:
        spark.sql(f"ALTER TABLE {log} ADD PARTITION ({values}) LOCATION '{path}'")
    except AnalysisException as error:
        forget(spark, path)
        if error.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        raise Conflict(f"{table} has a newer version of {ds} than {former.number}") from error
    return Version(former.number + 1, dict(folders))


def adopt(spark: SparkSession, table: str, ds: str) -> Version:
    """The newest version; partitions that were written before there was a log become the first."""
    found = current(spark, table, ds)
    if found.number:
        return found
    old = [p for p in list_partitions(spark, table) or () if p["ds"] == ds]
    if not old:
        return found
    folders = {p.get("batch", WHOLE): location(spark, table, p) for p in old}
    try:
        return commit(spark, table, ds, found, folders)
    except Conflict:  # another writer took them in
        return current(spark, table, ds)


def settle(spark: SparkSession, table: str, ds: str) -> Version:
    """Point the partitions of the snapshot at its newest version, and drop those it lacks.

    A version that comes in meanwhile is settled as well, so of several writers the last one's stays.
    """
    done = None
    while done is None or done.number != (newest := current(spark, table, ds)).number:
        done = current(spark, table, ds)
        there = {
            p.get("batch", WHOLE) for p in list_partitions(spark, table) or () if p["ds"] == ds
        }
        for batch, folder in done.folders.items():
            spec = partition_spec(_values(ds, batch))
            change = f"PARTITION ({spec}) SET LOCATION" if batch in there else f"ADD IF NOT EXISTS PARTITION ({spec}) LOCATION"
            spark.sql(f"ALTER TABLE {table} {change} '{folder}'")
        for batch in there.difference(done.folders):
            spec = partition_spec(_values(ds, batch))
            # Dropping a partition deletes its folder, which a reader may still need.
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{new_folder(spark, table, ds)}'")
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return newest


def _values(ds: str, batch: str) -> dict[str, str]:
    return {"ds": ds} if batch == WHOLE else {"ds": ds, "batch": batch}


def written_batches(spark: SparkSession, folder: str, schema: StructType) -> dict[str, str]:
    """The folder of each batch below a folder that was written by batch; no column is read."""
    files = spark.read.schema(schema).parquet(folder).select(
        F.col("batch").cast("string").alias("batch"),
        F.regexp_extract(F.input_file_name(), "^(.*)/[^/]*$", 1).alias("folder"),
    )
    return {row.batch: unquote(row.folder) for row in files.distinct().collect()}


def numbers(spark: SparkSession, table: str, ds: str) -> list[int]:
    """The versions of a snapshot that are still there, the newest last."""
    return _numbers(spark, table, ds)


def read_snapshot(spark: SparkSession, table: str, ds: str, number: int | None = None) -> DataFrame:
    """A published version of a snapshot, the newest unless given, whole, with the columns of the table."""
    version = current(spark, table, ds) if number is None else _load(spark, table, ds, number)
    if not version.number or (number is not None and number not in _numbers(spark, table, ds)):
        raise NoSnapshot(f"{table} has no published snapshot {ds}")
    schema = spark.table(table).schema
    names = {"ds", "batch"} if WHOLE not in version.folders and "batch" in schema.names else {"ds"}
    data = type(schema)([f for f in schema if f.name not in names])
    parts = [
        spark.read.schema(data).parquet(folder).withColumns(
            {name: F.lit(value) for name, value in _values(ds, batch).items()}
        )
        for batch, folder in version.folders.items()
    ]
    if not parts:
        return spark.table(table).filter(F.lit(False))
    return reduce(DataFrame.unionByName, parts).select(*schema.names)


def vacuum(spark: SparkSession, table: str, ds: str, keep: int = 2) -> int:
    """Delete what only versions before the newest ``keep`` have; tell how many folders went."""
    numbers = _numbers(spark, table, ds)
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return 0
    used = {f for n in kept for f in _load(spark, table, ds, n).folders.values()}
    gone = {f for n in old for f in _load(spark, table, ds, n).folders.values()} - used
    for folder in gone:
        forget(spark, folder)
    for number in old:
        spec = partition_spec({"ds": ds, "version": _name(number)})
        spark.sql(f"ALTER TABLE {log_table(table)} DROP IF EXISTS PARTITION ({spec})")
    return len(gone)
