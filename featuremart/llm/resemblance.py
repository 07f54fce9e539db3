"""Near duplicates by resemblance: the Jaccard similarity of the sets of five-word shingles.

Two documents are linked if it is 0.8 or more; components of links are the near-duplicate groups.

Candidates come from SimHash fingerprints of the different shingles. Fingerprints of 64 bits within two
bits are found by the pivots of ``simhash``. A pair at 0.8 differs in about ten bits of 64, too many
for any table of 64 bits to be sure of, so documents also meet in cells: a document has BANDS cells, each
the hash of ROWS minima of its shingle hashes under different multipliers; a pair at the threshold shares
none of them with a chance of (1 - 0.8^ROWS)^BANDS = 1e-11, a more similar one with less. Documents that
fingerprints or cells tie together form a cluster.

Inside a cluster every pair whose fingerprints of 64 * WIDE bits are further apart than ten standard
deviations over what a pair at the threshold has (97 bits of 256) is discarded, of random pairs all but
one in about 16,000, and the similarity of what survives is counted exactly from the texts. A cluster too
large for one task is cut into blocks by a hash, and each pair of blocks is a task's work. Documents with
the same shingles are one member throughout, so copies cost nothing.

Edge cases. A null text counts as empty; texts without words are copies of each other; one of fewer
than five words is a single shingle. Rows with a null id are linked like others but never name a
component with an id in it. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.common import NO_ID, components, packed, staged
from featuremart.llm.simhash import first_of, majority, print_links, shingle_hashes

WORDS = 5
LEAST = 0.8
BANDS = 48
ROWS = 4
BLOCK = 1024
CHUNK = 512
MULTIPLIERS = np.random.default_rng(5).integers(2**63, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
#: 64-bit words of the fingerprints that are compared inside a cluster.
WIDE = 4
STEPS = np.random.default_rng(6).integers(2**63, 2**64, WIDE, dtype=np.uint64)
CELLS = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("print", T.LongType()),
    T.StructField("cells", T.ArrayType(T.LongType())),
])


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Different shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, words))


def name_of(members: np.ndarray) -> int:
    """One number for a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(members.astype("<u8").tobytes(), 42)).view(np.int64))


def cells_of(members: np.ndarray) -> np.ndarray:
    """The cells of a set of shingles; none if it is empty."""
    if not len(members):
        return np.empty(0, dtype=np.int64)
    least = np.full(len(MULTIPLIERS), 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(members), CHUNK):
        np.minimum(least, (members[i : i + CHUNK, None] * MULTIPLIERS).min(axis=0), out=least)
    bands = least.astype("<u8").reshape(BANDS, ROWS)
    return np.array(
        [xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], dtype=np.uint64
    ).view(np.int64)


def cell_column(text: Column, words: int) -> Column:
    @F.pandas_udf(CELLS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles(t, words) for t in texts]
            yield pd.DataFrame({
                "node": [name_of(s) for s in sets], "print": [int(majority(s).view("<i8")[0]) for s in sets],
                "cells": [cells_of(s) for s in sets],
            })

    return of(text)


def wide_print(members: np.ndarray) -> np.ndarray:
    """SimHash fingerprint of a set of shingles in WIDE words."""
    mixed = members[:, None] + STEPS
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return majority(mixed ^ (mixed >> np.uint64(31))).view("<u8")


def radius(least: float) -> int:
    """Bits of wide fingerprints beyond which no pair of this similarity is expected.

    Sets of similarity s have a cosine of 2s / (1 + s) or more, and a bit differs with a chance of the
    angle over pi; ten standard deviations are added.
    """
    chance = np.arccos(2 * least / (1 + least)) / np.pi
    bits = 64 * WIDE
    return int(np.ceil(bits * chance + 10 * np.sqrt(bits * chance * (1 - chance))))


def similar(
    sets: list[np.ndarray], blocks: np.ndarray, least: float = LEAST, counts: dict[str, int] | None = None
) -> list[tuple[int, int]]:
    """Links of a spanning forest over the similar pairs.

    Where there are two blocks, only pairs of both are looked at. ``counts`` gets how many pairs ``met``
    that were not connected yet, and how many of them the fingerprints left to be ``verified``.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(codes, np.cumsum(sizes)[:-1])
    prints = np.stack([wide_print(s) for s in sets])
    far = radius(least)
    cross = len(np.unique(blocks)) > 1
    root = np.arange(len(sets))
    held = np.zeros(codes.max(initial=0) + 1, dtype=bool)
    found = []
    met = verified = 0
    for i in range(len(sets) - 1):
        apart = root[i + 1 :] != root[i]
        if cross:
            apart &= blocks[i + 1 :] != blocks[i]
        others = i + 1 + np.flatnonzero(apart)
        near = others[np.bitwise_count(prints[others] ^ prints[i]).sum(axis=1, dtype=np.int64) <= far]
        met += len(others)
        held[own[i]] = True
        for j in near.tolist():
            if root[j] == root[i]:
                continue
            verified += 1
            both = np.count_nonzero(held[own[j]])
            if both >= least * (sizes[i] + sizes[j] - both) - 1e-9:
                found.append((i, j))
                root[root == root[j]] = root[i]
        held[own[i]] = False
    if counts is not None:
        counts.update(met=met, verified=verified)
    return found


def clusters(nodes: DataFrame) -> DataFrame:
    """node, cluster of the nodes (node, print, cells) that a fingerprint or a cell ties to another."""
    met = nodes.select("node", F.explode("cells").alias("cell"))
    shared = met.groupBy("cell").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    ties = met.join(shared.filter("least < most").select("cell", "least"), "cell").filter("node <> least")
    first = nodes.groupBy("print").agg(F.min("node").alias("least"))
    alike = nodes.join(first, "print").filter("node <> least")
    # Of nodes with one fingerprint, the least stands for all in the search by pivots.
    near = (
        print_links(first.select("print"))
        .join(first.select(F.col("print").alias("a"), F.col("least").alias("node")), "a")
        .join(first.select(F.col("print").alias("b"), "least"), "b")
    )
    both = [part.select(F.col("node").alias("a"), F.col("least").alias("b")) for part in (ties, alike, near)]
    return components(both[0].union(both[1]).union(both[2])).withColumnRenamed("component", "cluster")


def links(texts: DataFrame, words: int = WORDS, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the similar nodes of each cluster (node, cluster, text)."""
    sizes = texts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    cut = F.when(F.col("n") <= block, 1).otherwise(F.ceil(2 * F.col("n") / block)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = (
        texts.join(sizes, "cluster")
        .withColumn("blocks", cut)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")))
        .withColumn("other", other)
        .withColumn("sub", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
        .select("cluster", "sub", "node", "block", "text")
    )

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        found = similar([shingles(t, words) for t in rows["text"]], rows["block"].to_numpy(), least)
        names = rows["node"].to_numpy()
        return pd.DataFrame([(names[i], names[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return pairs.groupBy("cluster", "sub").applyInPandas(verify, "a long, b long")


def classes(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """One row per document: id, text_hash, root (names the component), first (its smallest id)."""
    rows = packed(docs).select("id", "text_hash", cell_column(F.col("row.text"), words).alias("found"))
    rows, _ = staged(rows.select("id", "text_hash", "found.*"), "cells")
    cells = rows.select("node", "print", "cells").dropDuplicates(["node"])
    shown = rows.groupBy("node").agg(F.min(F.struct("id", "text_hash")).alias("row"))
    tied = clusters(cells).join(shown, "node").select("node", "cluster", "row.*")
    texts = (
        packed(docs).select("id", "text_hash", F.col("row.text").alias("text"))
        .join(tied, ["id", "text_hash"])
        .dropDuplicates(["node"])
        .select("node", "cluster", "text")
    )
    texts, _ = staged(texts, "texts")
    roots = components(links(texts, words, least)).withColumnRenamed("node", "linked")
    known = F.when(F.col("id") != NO_ID, F.col("id"))
    nodes = rows.groupBy("node").agg(F.min(known).alias("least"))
    nodes = nodes.join(roots, F.col("node") == F.col("linked"), "left").select(
        "node", "least", F.coalesce("component", "node").alias("root")
    )
    first = nodes.groupBy("root").agg(F.min("least").alias("first"))
    named = nodes.join(first, "root").select("node", "root", "first")
    return rows.select("id", "text_hash", "node").join(named, "node")


def one_of_each(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """The documents without those similar to one of smaller id; columns of ``docs``."""
    return first_of(docs, classes(docs, words, least))
