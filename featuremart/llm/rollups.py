"""Token counts as rollups that are maintained by deltas.

The rollup is a folder of committed batches. A batch holds signed changes (inserts +1, deletes -1,
revisions 0 documents with the difference in tokens), summed by source, language and tokenizer
version; totals are the sums over all batches, so any order of commits gives the same totals. A batch
is committed under its own name and counts once its success marker is there. Committing a name again
does nothing, so a job that is run again after a failure cannot count twice; a batch that broke off
has no marker, is not read, and is replaced by the next try.

A change is summed in the tasks before it is shuffled, so a source with most of the rows sends one row
per task.

Edge cases. A null text has no tokens but is a document. Null sources and languages are groups of
their own. Repeated rows count each. Groups whose documents and tokens are both back at zero are left
out. Without batches, or with empty ones, there are no totals. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.bpe import encode_all

KEYS = ["source", "lang", "tokenizer"]
LEDGER = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(text: Column, tokenizer: str) -> Column:
    """Number of token ids of each text, special tokens left out."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([len(ids) // 4 for ids in encode_all(tokenizer, texts)], dtype="int64")

    return count(text)


def inserts(rows: DataFrame) -> DataFrame:
    """Changes that add rows (source, lang, tokenizer, tokens)."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("docs"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    """Changes that take rows away again."""
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Changes of rows that were counted with ``tokens`` and now have ``new_tokens``."""
    return rows.select(
        *KEYS, F.lit(0).cast("long").alias("docs"), (F.col("new_tokens") - F.col("tokens")).alias("tokens")
    )


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that count."""
    where, files = _files(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    done = [n for n in names if files.exists(_files(spark, f"{path}/{n}/_SUCCESS")[0])]
    return sorted(n.removeprefix("batch-") for n in done if n.startswith("batch-"))


def commit(path: str, batch: str, changes: DataFrame) -> bool:
    """Sum the changes and commit them as a batch; False if the batch was there already."""
    if batch in committed(changes.sparkSession, path):
        return False
    summed = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    summed.write.mode("overwrite").parquet(f"{path}/batch-{batch}")
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
    names = [f"{path}/batch-{n}" for n in committed(spark, path)]
    rows = spark.read.schema(LEDGER).parquet(*names) if names else spark.createDataFrame([], LEDGER)
    return (
        rows.groupBy(*KEYS)
        .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        .filter("n_docs <> 0 or n_tokens <> 0")
    )


def corpus_counts(docs: DataFrame, path: str, tokenizer: str, version: str) -> DataFrame:
    """Totals of a corpus after three batches, each of which is sent twice.

    All documents are inserted; documents whose text is that of one with a smaller id are deleted;
    and the counts of those that remain are revised to include an end id.
    """
    from featuremart.llm.common import packed, staged

    counted, _ = staged(
        packed(docs).select(
            "id", "text_hash", F.length("row.text").alias("chars"), F.col("row.source").alias("source"),
            F.col("row.lang").alias("lang"), F.lit(version).alias("tokenizer"),
            token_counts(F.col("row.text"), tokenizer).alias("tokens"),
        ),
        "counted",
    )
    text = ["text_hash", "chars"]
    first = counted.filter("chars is not null").groupBy(*text).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    copies = counted.join(first, text).filter("id > first")
    end = (F.col("tokens") + 1).alias("new_tokens")
    kept = counted.select("*", end), copies.select(*counted.columns, end)
    batches = {
        "insert": inserts(counted),
        "delete-copies": deletes(copies),
        # What remains is all rows without the copies: the revision of the copies is taken back.
        "end-ids": revisions(kept[0]).union(
            revisions(kept[1]).withColumn("tokens", -F.col("tokens"))
        ),
    }
    for name, changes in batches.items():
        commit(path, name, changes)
        commit(path, name, changes)
    return totals(docs.sparkSession, path)
