"""Helpers the operators share: row identity, staging, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.operators.scratch import forget, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(2**63)


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows as one struct ``row``, beside the key that names them: ``id`` and ``text_hash``.

    Packing keeps the columns of the input apart from those an operator adds, whatever their names.
    Rows with the same key are copies of one row, or have the same id and text.
    """
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )


def id_or_null(name: str = "id") -> Column:
    """The id as it was in the input."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def blocks(texts: Sequence[str | None], size: int) -> Iterator[slice]:
    """Stretches of ``texts`` of at least ``size`` characters each, but for the last one.

    A batch is worked on a stretch at a time, so memory goes with the longest text, not with the batch.
    """
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "") + 1
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def staged(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read again, and where it lies; options are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of ``edges`` (a, b: long) reaches; columns node, component.

    Alternates large-star and small-star steps: every node links its larger, then its smaller
    neighbours to the least one it knows, until each component is a star. A step needs two
    aggregations that combine before the shuffle and two joins; the number of steps grows with
    the logarithm of the longest chain. Each step is written to the shared folder, which cuts the
    lineage, and the step before it is deleted.
    """
    spark = edges.sparkSession
    links = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).filter("u > v").distinct()
    links, path = staged(links, "links")
    known = None
    while True:
        state = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == known or not state["n"]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select("v", "v").distinct()
            )
        known = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e"))
            .select("e.u", "e.v")
            .filter("u > v")
            .distinct()
        )
        links, new = staged(small, "links")
        forget(spark, path)
        path = new
