"""Best-fit packing of documents into sequences by bin completion.

A document is its token ids and an end id. One longer than a sequence is cut into pieces, all but the
first of full length. What is to be packed is then known by its length alone, so the search works
on the number of pieces of each length: at most as many numbers as a sequence has tokens, whatever
the size of the corpus. A plan is a list of fillings (lengths of one sequence) with multiplicities.

Bin completion takes the longest length left and enumerates fillings around it: one, two or three
lengths more that leave least waste. A filling is dominated by one that puts a longer piece in the
place of shorter ones at no more waste, so of equal waste the one with the longest pieces comes
first. Depth-first search follows the fillings; a branch is pruned if its waste so far exceeds what
a better plan than the incumbent could waste in all. The first incumbent is best-fit decreasing; the
search ends at the lower bound (all tokens over the sequence length), or after ``NODES`` fillings,
which bounds the driver's work, not the rows that are packed. Each filling is used as often as the
counts allow, so a plan has few fillings: every one uses up a length but for less than the pieces
it takes of it.

Pieces of one length are then numbered and dealt to the places of that length in the plan. They are
numbered in buckets of a hash, so no task holds all pieces of a frequent length.

Edge cases. A null text counts as empty and is the end id alone. Repeated rows are packed each. Rows
with a null id have a null doc_id. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.bpe import encode_all
from featuremart.llm.common import id_or_null, packed, staged

LENGTH = 2048
END_ID = 0
NODES = 20_000
ROWS_PER_BUCKET = 500_000

Filling = tuple[int, ...]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """id, text_hash, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            encoded = encode_all(tokenizer, batch["text"])
            for doc, mark, ids in zip(batch["id"], batch["text_hash"], encoded, strict=True):
                ids += end
                n = len(ids) // 4
                stop = n - (n - 1) // length * length  # end of the first piece
                start = piece = 0
                while start < n:
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * stop])
                    out.append((doc, mark, piece, start, stop - start, crc))
                    start, stop, piece = stop, stop + length, piece + 1
            yield pd.DataFrame(
                out, columns=["id", "text_hash", "piece", "start", "length", "ids_crc32"]
            )

    return packed(docs).select("id", "text_hash", F.col("row.text").alias("text")).mapInPandas(
        cut, "id long, text_hash long, piece int, start long, length long, ids_crc32 long"
    )


def floors(counts: np.ndarray) -> np.ndarray:
    """Largest length present that is at most each number; zero where there is none."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def fillings(counts: np.ndarray, top: int, room: int, width: int = 3) -> list[Filling]:
    """Undominated fillings of ``room`` beside ``top``, least waste first, longest pieces first."""
    fits = floors(counts)
    found: set[Filling] = set()

    def add(parts: list[int]) -> None:
        chosen, left = [], room
        for part in sorted(parts, reverse=True):
            used = chosen.count(part) + (part == top)
            if part and part <= left and counts[part] > used:
                chosen.append(part)
                left -= part
        while left and (part := int(fits[left])):  # best fit for what is left
            while part and counts[part] <= chosen.count(part) + (part == top):
                part = int(fits[part - 1])
            if not part:
                break
            chosen.append(part)
            left -= part
        found.add(tuple(sorted(chosen, reverse=True)))

    def two(size: int) -> list[tuple[int, int]]:
        """Pairs of lengths that fill ``size`` best."""
        one = np.flatnonzero(counts[: size + 1] > 0)[::-1]
        other = fits[size - one]
        order = np.argsort(-(one + other), kind="stable")[:width]
        return [(int(one[i]), int(other[i])) for i in order]

    add([int(fits[room])])
    for a, b in two(room):
        add([a, b])
    longest = int(fits[room])
    while longest and len(found) < 2 * width:
        for a, b in two(room - longest):
            add([longest, a, b])
        longest = int(fits[longest - 1])
        if not any(room - sum(f) for f in found):
            break
    return sorted(found, key=lambda f: (room - sum(f), [-p for p in f]))


def best_fit_decreasing(counts: np.ndarray, length: int) -> list[tuple[Filling, int]]:
    """Fillings with multiplicities: the longest piece that fits what is left, again and again."""
    counts, plan = counts.copy(), []
    while len(at := np.flatnonzero(counts)):
        filling, left = [], length
        fits = floors(counts)
        part = int(at[-1])
        while part:
            filling.append(part)
            left -= part
            part = int(fits[left])
            while part and counts[part] <= filling.count(part):
                part = int(fits[part - 1])
        times = min(int(counts[p]) // filling.count(p) for p in set(filling))
        plan.append((tuple(filling), times))
        np.subtract.at(counts, filling, times)
    return plan


def complete_bins(counts: np.ndarray, length: int = LENGTH, nodes: int = NODES):
    """A plan: fillings and how often each is used. ``counts[n]``: pieces of length n."""
    total = int((counts * np.arange(len(counts))).sum())
    least = -(-total // length)
    best = best_fit_decreasing(counts, length)
    fewest = sum(n for _, n in best)
    state = {"nodes": nodes, "best": best, "fewest": fewest}
    # Each frame: counts, bins so far, waste so far, plan so far, fillings not yet tried.
    frames = [(counts.copy(), 0, 0, None, None)]
    while frames and state["fewest"] > least and state["nodes"] > 0:
        now, bins, waste, plan, options = frames.pop()
        at = np.flatnonzero(now)
        if not len(at):
            if bins < state["fewest"]:
                steps = []
                while plan:
                    plan, step = plan
                    steps.append(step)
                state["fewest"], state["best"] = bins, steps
            continue
        top = int(at[-1])
        if options is None:
            options = fillings(now, top, length - top)
        if not options:
            continue
        filling = (top, *options[0])
        if len(options) > 1:
            frames.append((now, bins, waste, plan, options[1:]))
        state["nodes"] -= 1
        times = min(int(now[p]) // filling.count(p) for p in set(filling))
        lost = waste + times * (length - sum(filling))
        if lost > (state["fewest"] - 1) * length - total:  # cannot beat the incumbent
            continue
        after = now.copy()
        np.subtract.at(after, list(filling), times)
        frames.append((after, bins + times, lost, (plan, (filling, times)), None))
    return state["best"]


def places(plan: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For each length the places in number order: first number, pieces a bin, first bin, offset."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    first_bin = 0
    for filling, times in plan:
        offset = 0
        for part in dict.fromkeys(filling):
            each = filling.count(part)
            rows.setdefault(part, []).append((taken.get(part, 0), each, first_bin, offset))
            taken[part] = taken.get(part, 0) + each * times
            offset += each * part
        first_bin += times
    return {part: np.array(x, dtype=np.int64) for part, x in rows.items()}


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, nodes: int = NODES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut, _ = staged(pieces(docs, tokenizer, length), "pieces")
    sizes = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # by length: bounded
    counts = np.zeros(length + 1, dtype=np.int64)
    for row in sizes:
        counts[row["length"]] = row["n"]
    where = places(complete_bins(counts, length, nodes))
    buckets = int(max(1, -(-counts.max() // ROWS_PER_BUCKET)))
    key = ["id", "text_hash", "piece"]
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    inside = Window.partitionBy("length", "bucket").orderBy(*key)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    number = F.col("first") + F.row_number().over(inside) - 1

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, numbers in batches:
            lengths, numbers = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
            out = np.zeros((2, len(lengths)), dtype=np.int64)
            for part in np.unique(lengths):
                rows, at = where[int(part)], np.flatnonzero(lengths == part)
                first, each, first_bin, offset = rows[
                    np.searchsorted(rows[:, 0], numbers[at], side="right") - 1
                ].T
                nth = numbers[at] - first
                out[0, at] = first_bin + nth // each
                out[1, at] = offset + nth % each * part
            yield pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    return (
        cut.join(starts, ["length", "bucket"])
        .withColumn("number", number)
        .withColumn("place", place("length", "number"))
        .select(
            id_or_null().alias("doc_id"), "piece", "start", "length", "ids_crc32",
            "place.sequence_id", "place.offset",
        )
    )
