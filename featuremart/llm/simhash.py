"""Near-duplicate documents by SimHash fingerprints and tables of distances to pivots.

A fingerprint has 64 bits; bit i is set if more than half of the hashes of the document's shingles
have it. Two documents are linked if their fingerprints differ in at most two bits.

Candidates come from pivot distance tables, by the triangle inequality: the distances of linked
fingerprints to any pivot differ by two at most. There are two kinds of pivots.

Local pivots say who meets: zero, and for each of the 16 nibbles of a fingerprint four references that
are zero outside it (bits 0011, 0101, 1001 and 1111 inside). A distance relative to that of the zero
pivot depends on the pivot's own nibble only, so two differing bits change the relative distances of
two nibbles at most: linked fingerprints agree in all relative distances of at least 14 nibbles, and
so in two of four groups of nibbles. Fingerprints meet in a cell if they do agree in two groups. (The
four relative distances tell the values of a nibble apart, so a cell is one of equal nibbles.)

Spanning pivots, 32 random fingerprints, discard: of those who meet, pairs whose largest difference over
the distances to them exceeds two go, and only what survives has its Hamming distance taken. Of pairs
at random in a cell fewer than one in a thousand survive.

A cell that more than CELL distinct fingerprints share is divided again: they can only differ in the
other eight nibbles, linked ones in two of those, so they meet in 28 cells by the other six. Those
cells hold at most 256 distinct fingerprints, as only two nibbles are free. Cells are worked on
inside a task and give the links of a spanning forest, never all pairs, so nothing grows with the
square of a group. Copies count once throughout, as only distinct fingerprints enter the table.

Edge cases. A null text counts as empty. A text without words has the fingerprint zero and is linked
like any other. Rows with a null id get the smallest id of their component, or null if it has none.
Repeated rows are all returned. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.common import NO_ID, components, id_or_null, packed, staged

MAX_BITS = 2
CELL = 256
NIBBLES = 16
PATTERNS = (0b0011, 0b0101, 0b1001, 0b1111)
PIVOTS = np.array([0] + [p << (4 * n) for n in range(NIBBLES) for p in PATTERNS], dtype=np.uint64)
SPANNING = np.random.default_rng(64).integers(0, 2**64, 32, dtype=np.uint64)
GROUPS = 4
SIZE = NIBBLES // GROUPS
LONGS = T.ArrayType(T.LongType())
LINKS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of so many words, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    h = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([h(b" ".join(parts), 42)], dtype=np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(parts) - words + 1].tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    return np.fromiter(
        (h(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts)
    )


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    return int(majority(shingle_hashes(text, words)).view("<i8")[0])


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that over half of the hashes have, as bytes; a hash is a number or a row of them."""
    if hashes.ndim == 1:
        hashes = hashes[:, None]
    width = 8 * hashes.shape[1]
    ones = np.zeros(8 * width, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        octets = np.ascontiguousarray(hashes[i : i + 65536], dtype="<u8").view(np.uint8).reshape(-1, width)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")


def fingerprint_column(text: Column, words: int = 3) -> Column:
    @F.pandas_udf(T.LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return of(text)


def distances(prints: np.ndarray, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(prints.view(np.uint64)[:, None] ^ pivots[None, :]).astype(np.int8)


def nibble_codes(table: np.ndarray) -> np.ndarray:
    """Number 0..15 of the relative distances of each nibble, which take 16 different values."""
    sizes = np.array([p.bit_count() for p in PATTERNS], dtype=np.int8)
    relative = (table[:, 1:] - table[:, :1]).reshape(len(table), NIBBLES, len(PATTERNS))
    a, b, c, s = np.moveaxis((sizes - relative) // 2, 2, 0)  # set bits below each pattern
    first = (a + b + c - s) // 2
    return first + 2 * (a - first) + 4 * (b - first) + 8 * (c - first)


def _packed(codes: np.ndarray, chosen: list[int]) -> np.ndarray:
    key = np.zeros(len(codes), dtype=np.int64)
    for n in chosen:
        key = key * 16 + codes[:, n]
    return key


def cells(prints: np.ndarray) -> np.ndarray:
    """Cell of each fingerprint for each of the six pairs of groups."""
    codes = nibble_codes(distances(prints))
    pairs = combinations(range(GROUPS), 2)
    group = [list(range(g * SIZE, (g + 1) * SIZE)) for g in range(GROUPS)]
    return np.stack([_packed(codes, group[i] + group[j]) for i, j in pairs], axis=1)


def inner_cells(prints: np.ndarray, pair: int) -> np.ndarray:
    """Cells inside a large cell of a pair of groups: 28 choices of six of the free nibbles."""
    codes = nibble_codes(distances(prints))
    kept = list(combinations(range(GROUPS), 2))[pair]
    free = [n for n in range(NIBBLES) if n // SIZE not in kept]
    return np.stack([_packed(codes, list(c)) for c in combinations(free, 6)], axis=1)


def survivors(table: np.ndarray, at: int, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Those of ``others`` whose distances to all spanning pivots are near those of ``at``."""
    return others[np.abs(table[others] - table[at]).max(axis=1) <= max_bits]


def forest(
    prints: np.ndarray, max_bits: int = MAX_BITS, counts: dict[str, int] | None = None
) -> list[tuple[int, int]]:
    """Links of a spanning forest over the linked fingerprints of one cell.

    ``counts`` gets how many pairs ``met`` and how many of them were ``verified``.
    """
    table = distances(prints, SPANNING)
    unsigned = prints.view(np.uint64)
    left = np.arange(len(prints))
    found = []
    met = verified = 0
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = survivors(table, at, left, max_bits)
            met, verified = met + len(left), verified + len(near)
            new = near[np.bitwise_count(unsigned[near] ^ unsigned[at]) <= max_bits]
            if len(new):
                queue += new.tolist()
                found += [(int(prints[at]), int(prints[n])) for n in new]
                left = np.setdiff1d(left, new, assume_unique=True)
    if counts is not None:
        counts.update(met=met, verified=verified)
    return found


@F.pandas_udf(LONGS)
def _cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for prints in batches:
        yield pd.Series(list(cells(prints.to_numpy(dtype=np.int64))))


@F.pandas_udf(LONGS)
def _inner(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for prints, tables in batches:
        out = np.zeros((len(prints), 28), dtype=np.int64)
        for pair in tables.unique():
            at = (tables == pair).to_numpy()
            out[at] = inner_cells(prints[at].to_numpy(dtype=np.int64), int(pair))
        yield pd.Series(list(out))


@F.pandas_udf(LINKS)
def _forest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for members in batches:
        yield pd.Series([
            [{"a": a, "b": b} for a, b in forest(np.asarray(m, dtype=np.int64))] for m in members
        ])


def print_links(prints: DataFrame, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all fingerprints (``print``, distinct) within two bits."""
    met = prints.select("print", F.posexplode(_cells("print")).alias("pair", "cell"))
    shared = met.groupBy("pair", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met, _ = staged(met.join(shared, ["pair", "cell"]), "cells")
    small = met.filter(F.col("n") <= cell).groupBy("pair", "cell").agg(
        F.collect_list("print").alias("members")
    )
    large = (
        met.filter(F.col("n") > cell)
        .select("print", "pair", "cell", F.posexplode(_inner("print", "pair")).alias("choice", "inner"))
        .groupBy("pair", "cell", "choice", "inner")
        .agg(F.collect_list("print").alias("members"))
        .filter(F.size("members") > 1)
    )
    return (
        small.select("members").union(large.select("members"))
        .select(F.explode(_forest("members")).alias("link"))
        .select("link.a", "link.b")
    )


def classes(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, text_hash, print, first (smallest id of the component).

    Also ``root``, the smallest fingerprint of the component, which names it even if ids repeat.
    """
    rows = packed(docs, doc_id, text).select(
        "id", "text_hash", fingerprint_column(F.col(f"row.`{text}`"), words).alias("print")
    )
    rows, _ = staged(rows, "prints")
    known = F.when(F.col("id") != NO_ID, F.col("id"))
    prints = rows.groupBy("print").agg(F.min(known).alias("least"))
    roots = components(print_links(prints.select("print"))).withColumnRenamed("node", "print")
    prints = prints.join(roots, "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("root")
    )
    first = prints.groupBy("root").agg(F.min("least").alias("first"))
    named = prints.join(first, "root").select("print", "root", "first")
    return rows.join(named, "print")


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    return classes(docs, words).select(
        id_or_null().alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = 3) -> DataFrame:
    """The documents without those linked to one of smaller id; columns of ``docs``.

    Of several rows that carry the smallest id of a component, one stays.
    """
    return first_of(docs, classes(docs, words))


def first_of(docs: DataFrame, named: DataFrame) -> DataFrame:
    """One document of each component (id, text_hash, root, first)."""
    best = Window.partitionBy("root").orderBy("id", "text_hash")
    kept = (
        named
        .select("id", "text_hash", "root", F.col("id").eqNullSafe(
            F.coalesce("first", F.lit(NO_ID))).alias("is_first"))
        .filter("is_first")
        .withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .select("id", "text_hash")
    )
    same = Window.partitionBy("id", "text_hash").orderBy(F.xxhash64("row"))
    return (
        packed(docs)
        .join(kept, ["id", "text_hash"])
        .withColumn("place", F.row_number().over(same))
        .filter("place = 1")
        .select("row.*")
    )
