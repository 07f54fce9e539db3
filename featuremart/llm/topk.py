"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers (floor of 1024 times each component); a component is a term, its value the
term's weight. Documents are ordered by their dominant terms and cut into ranges of ``BLOCK``
documents. A block keeps a forward index (the integers of its documents) and, for each term, the
largest and smallest weight in it. For a query the sum over terms of the larger of query weight times
either bound is at least the score of any document of the block. Blocks are taken in descending
order of that sum and scored through their forward indexes until the sum falls below the k-th score
found so far; a block whose sum equals it is still scored, as ties go to the smaller id. A query that
has not yet met k documents starts with its own best block; the other blocks of a chunk come in one
order for all queries, by their greatest sum. The result is exact whatever is pruned.

Blocks travel in chunks of ``CHUNK`` documents, queries in blocks of ``QUERIES``; both have a fixed
size in bytes and are written once. Every chunk meets every query block once, in a product of the two
written tables: ``LANES`` parts of the documents at most with ``PARTS`` parts of the queries at most.
A task reads its part of both from the files, so no copy of either is shuffled, none is broadcast, and
the number of tasks is bounded. A task streams its chunks past its query blocks and keeps the k best
and the k-th score of each query from chunk to chunk; a window joins the tasks' k best. What is moved
is k rows for each query and lane, so it grows with the number of queries.

Edge cases. Vectors that are null or hold a null or non-finite component take no part, neither do rows
with a null id. Vectors of different lengths meet as if the shorter had zeros at its end. Equal rows
are one query, but candidates each; a row is no candidate of a query with its own id. An empty table
gives no rows. Other columns are not looked at. Components and scores are 64-bit integers: a component
that does not fit, or a pair whose terms could add up to more, is an error, never a wrong score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import staged

SCALE = 1024
K = 10
BLOCK = 128
CHUNK = 4096
QUERIES = 4096
#: Parts of the documents and of the query blocks that meet, at most.
LANES = 64
PARTS = 512
#: Chunks in a file: a reader or writer may hold a file's rows at once.
FILE = 16
#: Components and scores are 64-bit integers.
LIMIT = 2.0**63
#: Larger than what rounding adds to a product, as a share of its terms.
SLACK = 1e-9


def integer_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``terms`` (array of long) of the vectors that take part."""

    def whole(x):
        scaled = x * scale
        return F.when(F.abs(scaled) < LIMIT, F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a component does not fit 64 bits")).cast("long")
        )

    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("embedding").isNotNull() & finite & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(wide, whole).alias("terms"),
    )


def packed_rows(ids: np.ndarray, rows: list) -> pd.DataFrame:
    """One row that holds many vectors: their ids and integers as bytes, as narrow as they fit."""
    width = max((len(r) for r in rows), default=0)
    matrix = np.zeros((len(rows), width), dtype="<i8")
    for i, r in enumerate(rows):
        matrix[i, : len(r)] = r
    ends = (matrix.min(), matrix.max()) if matrix.size else (0, 0)
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= ends[0] and ends[1] <= np.iinfo(t).max)
    return pd.DataFrame([{
        "ids": np.asarray(ids, dtype="<i8").tobytes(), "width": width,
        "matrix": matrix.astype(kind).tobytes(),
    }])


def unpacked(ids: bytes | pa.Buffer, width: int, matrix: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Copies, so that what they were read from can go; bytes or Arrow buffers."""
    ids = np.frombuffer(ids, dtype="<i8").copy()
    kind = f"<i{len(matrix) // max(1, len(ids) * width) or 8}"
    return ids, np.frombuffer(matrix, dtype=kind).reshape(len(ids), width).astype(np.int64)


def dominant(terms: pd.Series) -> pd.Series:
    """Order of the documents: index and sign of the largest and second largest components."""
    out = []
    for row in terms:
        row = np.asarray(row, dtype=np.float64)
        key = 0
        for i in np.argsort(-np.abs(row), kind="stable")[:2]:
            key = (key << 24) + 2 * int(i) + (1 if row[i] > 0 else 0) + 1
        out.append(key)
    return pd.Series(out, dtype="int64")


def chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """ids, width, matrix: ranges of documents in the order of their dominant terms."""

    @F.pandas_udf("long")
    def order(terms: pd.Series) -> pd.Series:
        return dominant(terms)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        held: list = []
        for batch in batches:
            ids += batch["vec_id"].tolist()
            held += batch["terms"].tolist()
            while len(ids) >= size:
                yield packed_rows(ids[:size], held[:size])
                ids, held = ids[size:], held[size:]
        if ids:
            yield packed_rows(ids, held)

    return (
        rows.withColumn("place", order("terms"))
        .repartitionByRange("place", "vec_id")
        .sortWithinPartitions("place", "vec_id")
        .select("vec_id", "terms")
        .mapInPandas(cut, "ids binary, width long, matrix binary")
    )


def exact_type(a: np.ndarray, b: np.ndarray) -> type | None:
    """The narrower floating point type in which all products of the rows are exact, if there is one.

    The terms of a product add up to no more than the product of the two lengths.
    """
    size = 1 + SLACK
    for x in (a, b):
        wide = x.astype(np.float64)
        size *= np.sqrt(np.einsum("ij,ij->i", wide, wide).max(initial=0))
    return np.float32 if size < 2.0**24 else np.float64 if size < 2.0**53 else None


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows; in floating point where that is exact.

    Fails where the terms of a product could add up to more than 64 bits.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if kind := exact_type(a, b):
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    wide_a, wide_b = a.astype(np.float64), b.astype(np.float64)
    most = np.abs(wide_a).max() * np.abs(wide_b).max() * a.shape[1]
    if most >= LIMIT / 2 and (np.abs(wide_a) @ np.abs(wide_b).T).max() >= LIMIT * (1 - SLACK):
        raise OverflowError("a score does not fit 64 bits")
    return a @ b.T


def upper_bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """At least the score of every query with every document between ``least`` and ``most``."""
    parts = [(np.maximum(queries, 0), most), (np.minimum(queries, 0), least)]
    wide = [(a.astype(np.float64), b.astype(np.float64)) for a, b in parts]
    size = sum(np.abs(a) @ np.abs(b).T for a, b in wide)
    if not size.size or size.max() < 2.0**53:
        return sum(a @ b.T for a, b in wide).astype(np.int64)
    bound = sum(a @ b.T for a, b in wide) + size * SLACK  # rounded, so raised
    out = np.clip(bound, -LIMIT, LIMIT / 2).astype(np.int64)
    out[bound >= LIMIT / 2] = np.iinfo(np.int64).max
    return out


class Best:
    """The k best documents of each query of a block among the chunks it has met."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int = K):
        self.query_ids, self.queries = query_ids, queries
        self.top = np.full((len(queries), k), np.iinfo(np.int64).min)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.held = np.zeros((len(queries), k), dtype=bool)

    def meet(
        self, ids: np.ndarray, docs: np.ndarray, block: int = BLOCK, seen: list | None = None
    ) -> None:
        """Take in a chunk. ``seen`` gets the number of (query, block) pairs that were scored."""
        width = max(self.queries.shape[1], docs.shape[1])
        queries = np.pad(self.queries, ((0, 0), (0, width - self.queries.shape[1])))
        docs = np.pad(docs, ((0, 0), (0, width - docs.shape[1])))
        kind = exact_type(queries, docs)
        wide = [x.astype(kind) for x in (queries, docs)] if kind else []
        starts = range(0, len(docs), block)
        most = np.array([docs[a : a + block].max(axis=0) for a in starts])
        least = np.array([docs[a : a + block].min(axis=0) for a in starts])
        bounds = upper_bounds(queries, most, least)
        todo = np.ones(bounds.shape, dtype=bool)

        def score(b: int, who: np.ndarray) -> None:
            part = slice(b * block, (b + 1) * block)
            scores = wide[0][who] @ wide[1][part].T if kind else inner(queries[who], docs[part])
            good = scores >= self.top[who, -1].astype(scores.dtype)[:, None]
            row, at = np.divmod(np.flatnonzero(good), good.shape[1])
            other = ids[part][at] != self.query_ids[who[row]]
            row, at = row[other], at[other]
            self.keep(who[row], ids[part][at], scores[row, at].astype(np.int64))
            todo[who, b] = False
            if seen is not None:
                seen.append(len(who))

        first = bounds.argmax(axis=1)
        new = np.flatnonzero(~self.held[:, -1])
        for b in np.unique(first[new]):
            score(b, new[first[new] == b])
        for b in np.argsort(-bounds.max(axis=0).astype(np.float64), kind="stable"):
            who = np.flatnonzero(todo[:, b] & (~self.held[:, -1] | (bounds[:, b] >= self.top[:, -1])))
            if len(who):
                score(b, who)

    def keep(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge documents found for the queries numbered ``rows`` into their k best."""
        if not len(rows):
            return
        some, at = np.unique(rows, return_inverse=True)
        held = self.held[some]
        at = np.concatenate([np.nonzero(held)[0], at])
        ids = np.concatenate([self.ids[some][held], ids])
        scores = np.concatenate([self.top[some][held], scores])
        order = np.lexsort((ids, -scores, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        best = rank < self.held.shape[1]
        place = some[at[best]], rank[best]
        self.ids[place], self.top[place], self.held[place] = ids[order][best], scores[order][best], True

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id and score of its k best, in their order."""
        who, place = np.nonzero(self.held)
        return who, self.ids[who, place], self.top[who, place]


def best_in_chunk(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, docs: np.ndarray, k: int = K,
    block: int = BLOCK, seen: list | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the query, id and score of the k best documents of a chunk for each query.

    ``seen`` gets the number of (query, block) pairs that were scored.
    """
    best = Best(query_ids, queries, k)
    best.meet(ids, docs, block, seen)
    return best.found()


def top_k(
    vectors: DataFrame, every: int = 100, k: int = K, chunk: int = CHUNK, queries: int = QUERIES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row whose id is divisible by ``every``."""
    rows = integer_rows(vectors)
    asked = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "terms"])
    by_query = staged(
        chunks(asked, queries).withColumn("block", F.monotonically_increasing_id()), "queries",
        maxRecordsPerFile=FILE,
    )[0].select("block", *[F.col(c).alias(f"query_{c}") for c in ("ids", "width", "matrix")])
    by_doc = staged(chunks(rows, chunk), "chunks", maxRecordsPerFile=FILE)[0]
    parts = min(PARTS, max(1, by_query.count()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in batches:  # some 64 MB at most, which pandas would copy

            def vectors(i: int, kind: str = "") -> tuple[np.ndarray, np.ndarray]:
                ids, width, matrix = (batch.column(f"{kind}{c}")[i] for c in ("ids", "width", "matrix"))
                return unpacked(ids.as_buffer(), width.as_py(), matrix.as_buffer())

            for i, block in enumerate(batch.column("block").to_pylist()):
                if block not in best:
                    best[block] = Best(*vectors(i, "query_"), k)
                best[block].meet(*vectors(i))
        for block, held in best.items():
            who, found, scores = held.found()
            yield pa.RecordBatch.from_pydict({
                "block": np.full(len(who), block), "query": who, "query_id": held.query_ids[who],
                "vec_id": found, "score": scores,
            })

    ranked = Window.partitionBy("block", "query", "query_id").orderBy(F.desc("score"), "vec_id")
    return (
        by_doc.coalesce(LANES)
        .crossJoin(by_query.repartition(parts).hint("shuffle_replicate_nl"))
        .mapInArrow(score, "block long, query long, query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS t FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.t, v.t)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.t, v.t) DESC, v.vec_id) AS rank
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
) WHERE rank <= 10
"""
