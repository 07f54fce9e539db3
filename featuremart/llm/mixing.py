"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a weight; together they share ``share`` of all words. A target stops at ``most``
times its source's size, and the excess is shared again by weight until no target is above. A source
whose target is r times its size takes each document floor(r) times and once more with probability
frac(r). Which documents those are is a balanced sample: the cube method moves the vector of
inclusion probabilities through the null space of the constraints (words and documents of the
sample), so both totals stay what they are in expectation, until all but two probabilities are zero
or one. With two constraints three open units always leave a direction: the cross product of
(1, 1, 1) and their sizes. What remains of a source is landed on the outcome nearest its words, and
where that is still off by most of a document, one drawn document is exchanged for one that is not.

Equal rows (same id, text and source) are one unit with a multiplicity, so a row that is repeated
very often is no hot group: of n rows with probability p, floor(n p) are certain and one is drawn
with the rest. Units are dealt to groups of bounded size by a hash; each group flies on its own and
leaves two open units at most, which meet in groups again until a source is one group. All draws
come from hashes of the rows, so reruns agree.

Edge cases. A null text has size 0 and is never taken. Sources are ordered by code point, null last.
A source without words has target 0. Repeated rows share what their unit takes as evenly as can be.
An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left
from collections.abc import Sequence
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import WORD, id_or_null, packed, staged

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
GROUP_ROWS = 50_000
EXACT = 1e-9
UNIT = "id long, text_hash long, source string, size long, n long, base long, chance double, bucket long"


def targets(
    sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST,
) -> dict[str | None, float]:
    """Words each source is to give. ``sizes`` holds one number per source."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in names if s in open_)
        part = {s: left * weight[s] / total for s in names if s in open_}
        full = [s for s in part if part[s] > most * sizes[s]]
        if not full:
            return out | part
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.discard(s)
    return out


def flight(sizes: Sequence[int], chances: list[float], rng: random.Random) -> list[float]:
    """Chances after the flight phase: all but two are 0 or 1 and both totals are kept.

    Two open units of the same size fly on, as moving chance between them keeps both totals.
    """
    chances = list(chances)
    active: list[int] = []
    for k in range(len(chances)):
        if not EXACT < chances[k] < 1 - EXACT:
            chances[k] = float(round(chances[k]))
            continue
        active.append(k)
        while len(active) > 1:
            if len(active) == 2:
                a, b = active
                if sizes[a] != sizes[b]:
                    break
                way = (1.0, -1.0)
            else:
                a, b, c = (sizes[i] for i in active)
                way = (b - c, c - a, a - b)
                if not any(way):
                    way = (1.0, -1.0, 0.0)
            ahead = behind = float("inf")
            for i, w in zip(active, way, strict=True):
                if w:
                    up, down = (1 - chances[i]) / abs(w), chances[i] / abs(w)
                    ahead = min(ahead, up if w > 0 else down)
                    behind = min(behind, down if w > 0 else up)
            step = ahead if rng.random() * (ahead + behind) < behind else -behind
            for i, w in zip(active, way, strict=True):
                chances[i] += step * w
                if not EXACT < chances[i] < 1 - EXACT:
                    chances[i] = float(round(chances[i]))
            active = [i for i in active if EXACT < chances[i] < 1 - EXACT]
    return chances


def landing(sizes: Sequence[int], chances: list[float]) -> list[float]:
    """Ends the open units on the outcome nearest in words, then in documents."""
    open_ = [i for i, p in enumerate(chances) if 0 < p < 1]
    words = sum(chances[i] * sizes[i] for i in open_)
    docs = sum(chances[i] for i in open_)

    def off(ends):
        return (
            abs(sum(e * sizes[i] for e, i in zip(ends, open_, strict=True)) - words),
            abs(sum(ends) - docs), ends,
        )

    best = min(product((0, 1), repeat=len(open_)), key=off)
    out = list(chances)
    for i, end in zip(open_, best, strict=True):
        out[i] = float(end)
    return out


def exchange(sizes: Sequence[int], before: list[float], landed: list[float]) -> list[float]:
    """Exchanges one drawn unit for one that is not if that brings the words nearer.

    Only units that were open ``before`` the flight take part; the number of documents stays.
    """
    off = sum(s * (e - p) for s, p, e in zip(sizes, before, landed, strict=True))
    free = [i for i, p in enumerate(before) if EXACT < p < 1 - EXACT]
    drawn = [i for i in free if landed[i] == 1]
    rest = sorted((i for i in free if landed[i] == 0), key=lambda i: sizes[i])
    known = [sizes[i] for i in rest]
    best, least = None, abs(off)
    for i in drawn:
        at = bisect_left(known, sizes[i] - off)
        for j in rest[max(0, at - 1) : at + 1]:
            if abs(off - sizes[i] + sizes[j]) < least:
                best, least = (i, j), abs(off - sizes[i] + sizes[j])
    out = list(landed)
    if best:
        out[best[0]], out[best[1]] = 0.0, 1.0
    return out


def _fly(level: int, last: bool):
    def group(rows: pd.DataFrame) -> pd.DataFrame:
        source = rows["source"].iloc[0]
        name = repr((source if isinstance(source, str) else None, int(rows["bucket"].iloc[0]), level))
        rng = random.Random(zlib.crc32(name.encode("utf-8", "surrogatepass")))
        order = list(range(len(rows)))
        keys = list(zip(-rows["size"], rows["text_hash"], rows["id"], strict=True))
        order.sort(key=keys.__getitem__)
        rows = rows.iloc[order]
        sizes, before = rows["size"].tolist(), rows["chance"].tolist()
        after = flight(sizes, before, rng)
        if last:
            after = exchange(sizes, before, landing(sizes, after))
        return rows.assign(chance=after)

    return group


def units(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per different (id, text, source): id, text_hash, source, size, n rows, source_size,
    target, and ``taken_times``, how often the n rows are taken together."""
    spark = docs.sparkSession
    found, _ = staged(
        packed(docs)
        .select(
            "id", "text_hash", F.col("row.source").alias("source"),
            F.coalesce(F.regexp_count(F.col("row.text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("id", "text_hash", "source", "size")
        .agg(F.count(F.lit(1)).alias("n")),
        "units",
    )
    sources = found.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("size"), F.count(F.lit(1)).alias("units")
    ).collect()  # one row per source
    sizes = {r["source"]: r["size"] for r in sources}
    wanted = targets(sizes, weights, share, most)
    ratio = spark.createDataFrame(
        [(s, sizes[s], wanted[s], wanted[s] / sizes[s] if sizes[s] else 0.0,
          -(-r["units"] // group_rows)) for r in sources for s in [r["source"]]],
        "source string, source_size long, target double, ratio double, buckets long",
    )
    expected = F.col("n") * F.when(F.col("size") > 0, F.col("ratio")).otherwise(0.0)
    rounded = F.round(expected, 0)
    whole = F.when(F.abs(expected - rounded) < EXACT, rounded).otherwise(F.floor(expected))
    rows = found.alias("f").join(
        ratio.select(F.col("source").alias("s"), "ratio", "buckets"),
        F.col("source").eqNullSafe(F.col("s")),
    ).select(
        "id", "text_hash", "source", "size", "n", whole.cast("long").alias("base"),
        F.greatest(expected - whole, F.lit(0.0)).alias("chance"),
        F.pmod(F.xxhash64("id", "text_hash"), F.col("buckets")).alias("bucket"),
    )
    buckets, level, settled = max([-(-r["units"] // group_rows) for r in sources] or [0]), 0, []
    while buckets:
        last = buckets == 1
        rows, _ = staged(
            rows.groupBy("source", "bucket").applyInPandas(_fly(level, last), UNIT), f"level{level}"
        )
        if last:
            break
        settled.append(rows.filter("chance in (0.0, 1.0)"))
        rows = rows.filter("chance not in (0.0, 1.0)").withColumn(
            "bucket", F.floor(F.col("bucket") / (group_rows // 2))
        )
        buckets, level = -(-buckets // (group_rows // 2)), level + 1
    for done in settled:
        rows = rows.union(done)
    return rows.join(
        ratio.select(F.col("source").alias("s"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("s")),
    ).select(
        "id", "text_hash", "source", "size", "n", "source_size", "target",
        (F.col("base") + F.col("chance").cast("long")).alias("taken_times"),
    )


def _times(i):
    """Times the i-th (from 0) of n equal rows is taken."""
    return F.floor(F.col("taken_times") / F.col("n")).cast("long") + (
        F.lit(i) < F.col("taken_times") % F.col("n")
    ).cast("long")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    each = units(docs, **options).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return each.select(
        id_or_null().alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * _times(F.col("i"))).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns of ``docs``."""
    taken = units(docs, **options).filter("taken_times > 0").select(
        "id", "text_hash", F.xxhash64("source").alias("source_hash"), "n", "taken_times"
    )
    same = Window.partitionBy("id", "text_hash", "source_hash").orderBy(F.xxhash64("row"))
    return (
        packed(docs)
        .withColumn("source_hash", F.xxhash64("row.source"))
        .join(taken, ["id", "text_hash", "source_hash"])
        .withColumn("i", F.row_number().over(same) - 1)
        .withColumn("times", _times(F.col("i")))
        .filter("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("row.*")
    )
