"""Runs of repeated words: stretches with a small period, found on the words of whole texts.

A run is a stretch of words with smallest period q, at least four periods and six words long, which
no neighbouring word extends. In it the words kp and (k + 1)p are equal at three neighbouring places
or more of the grid of multiples of p, for its period p. So the grid of each p is looked through,
over all p a harmonic sum of places, and at the places left the longest common extensions forward and
backward give the whole stretch. Of equal stretches found with several p the least p is the period.

Extensions are answered from a difference cover modulo 21. Only the suffixes that start in the cover, 5 of
21, are sorted: by their first 21 words, then by doubling. Two places compare a few words, 20 at most,
until both are in the cover; from there the least common prefix between their ranks, from a sparse table,
is the answer. Backward ones come from the reversed words.

Documents are worked on in stretches of about a million characters, between words of their own that keep
runs inside a document; those without a place on any grid end there and are not sorted. Memory and
work go with the stretch, which a single longer document may exceed (n log n in its words).

Edge cases. A null or empty text, and one of spaces only, has no words, no runs and an empty result.
Rows with a null id keep it; repeated rows are searched each. An empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import blocks, id_or_null, packed

PERIODS = 4
LEAST = 6
#: A difference cover: any distance modulo MODULUS lies between two of its members.
COVER = np.array([0, 1, 4, 14, 16])
MODULUS = 21
BLOCK = 1 << 20
SPACES = " \t\n\r\x0b\f"
RUNS = "array<struct<start:long,length:long,period:long>>"


def synchronising() -> np.ndarray:
    """Words to go from two places, by their residues, until both are in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    step = np.arange(MODULUS)
    both = inside[(step[:, None, None] + step) % MODULUS] & inside[(step[None, :, None] + step) % MODULUS]
    return both.argmax(axis=2)


SYNCHRONISE = synchronising()
#: Place of a residue in the cover.
PLACE = np.searchsorted(COVER, np.arange(MODULUS))


class Extensions:
    """Longest common extensions of places of ``words``, whose last word is found nowhere else."""

    def __init__(self, words: np.ndarray):
        size = -(-len(words) // MODULUS) * MODULUS
        top = int(words.max()) + 1
        # Padding words are all different, so no extension reaches into them.
        self.words = np.concatenate([words, top + np.arange(size + MODULUS - len(words))])
        self.samples = (np.arange(0, size, MODULUS)[:, None] + COVER).ravel()
        names = self._first_names(top + size + MODULUS)
        levels, reach = [names], 1
        while names.max() + 1 < len(names):  # as long as two sampled suffixes look alike
            after = np.full(len(names), -1, dtype=np.int64)
            shift = reach * len(COVER)
            after[: max(len(names) - shift, 0)] = names[shift:]
            names = np.unique(names * (len(names) + 1) + after + 1, return_inverse=True)[1]
            levels.append(names)
            reach *= 2
        self.rank = names
        self.table = self._sparse_table(levels)

    def _first_names(self, alphabet: int) -> np.ndarray:
        """Order of the sampled suffixes by their first MODULUS words."""
        each = 62 // max(int(alphabet).bit_length(), 1)  # words that fit in one key
        keys = []
        for start in range(0, MODULUS, each):
            key = np.zeros(len(self.samples), dtype=np.int64)
            for offset in range(start, min(start + each, MODULUS)):
                key = key * alphabet + self.words[self.samples + offset]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        changed = np.zeros(len(order), dtype=bool)
        for key in keys:
            changed[1:] |= key[order][1:] != key[order][:-1]
        names = np.empty(len(order), dtype=np.int64)
        names[order] = np.cumsum(changed)
        return names

    def _sparse_table(self, levels: list[np.ndarray]) -> list[np.ndarray]:
        """Least common prefixes of neighbours in rank order, over 1, 2, 4, ... of them."""
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common, size = np.zeros(len(a), dtype=np.int32), len(order)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(np.maximum(a, b) < size)
            same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
            common[same] += MODULUS << level
            a[same] += len(COVER) << level
            b[same] += len(COVER) << level
        # Prefixes that differ go on for less than MODULUS words.
        open_, x, y = np.arange(len(common)), self.samples[order[:-1]], self.samples[order[1:]]
        for _ in range(MODULUS):
            open_ = open_[self.words[x[open_] + common[open_]] == self.words[y[open_] + common[open_]]]
            common[open_] += 1
        table = [common]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from the places ``a`` and ``b`` on, which differ."""
        shift = SYNCHRONISE[a % MODULUS, b % MODULUS]
        found, open_ = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        for _ in range(MODULUS):
            open_ = open_[shift[open_] > found[open_]]
            if not len(open_):
                break
            at = found[open_]
            open_ = open_[self.words[a[open_] + at] == self.words[b[open_] + at]]
            found[open_] += 1
        sure = np.flatnonzero(found == shift)
        ranks = []
        for places in (a, b):
            at = places[sure] + shift[sure]
            ranks.append(self.rank[at // MODULUS * len(COVER) + PLACE[at % MODULUS]])
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            found[sure[at]] += np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return found


def grid_places(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods where three neighbouring pairs of the grid of a period are equal."""
    places, periods = [], []
    for period in range(1, longest // PERIODS + 1):
        grid = words[::period]
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(found):
            places.append(found * period)
            periods.append(np.full(len(found), period))
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def block_runs(documents: list[list]) -> list[np.ndarray]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    none = np.empty((0, 3), dtype=np.int64)
    out = [none] * len(documents)
    sizes = np.array([len(d) for d in documents])
    if not len(sizes) or sizes.max() < LEAST:
        return out
    codes, known = pd.factorize(np.array([w for d in documents for w in d], dtype=object))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    # A word of its own before each document and at the end.
    words = np.insert(codes.astype(np.int64), firsts, len(known) + np.arange(len(firsts)))
    begins = firsts + np.arange(len(firsts)) + 1  # of each document's words
    places, _ = grid_places(words, int(sizes.max()))
    hit = np.unique(np.searchsorted(begins, places, side="right") - 1)
    if not len(hit):
        return out
    kept = np.concatenate([words[begins[i] - 1 : begins[i] + sizes[i]] for i in hit])
    words = np.append(kept, len(known) + len(firsts))
    begins = np.concatenate([[0], np.cumsum(sizes[hit] + 1)])[:-1] + 1
    places, periods = grid_places(words, int(sizes[hit].max()))
    forward = Extensions(words)(places, places + periods)
    mirror = len(words) - places  # the word before a place, from the end
    backward = Extensions(words[::-1])(mirror, mirror - periods)
    long = np.flatnonzero(
        (forward + backward >= (PERIODS - 1) * periods) & (forward + backward + periods >= LEAST)
    )
    start, period = places[long] - backward[long], periods[long]
    length = forward[long] + backward[long] + period
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    found = np.stack([start[first], length[first], period[first]], axis=1)
    owner = np.searchsorted(begins, found[:, 0], side="right") - 1
    for i in np.unique(owner):
        mine = found[owner == i]
        mine[:, 0] -= begins[i]
        out[hit[i]] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words without those that a run repeats after its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
    return b" ".join(words).decode()


def repeated_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its ``runs`` and the text that is left, ``collapsed``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in blocks(texts, BLOCK):
                words = [(text or "").encode().split() for text in texts[part]]
                runs = block_runs(words)
                yield pd.DataFrame({
                    "id": batch["id"].iloc[part],
                    "runs": [
                        [dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()]
                        for found in runs
                    ],
                    "collapsed": [collapsed(w, r) for w, r in zip(words, runs, strict=True)],
                })

    return packed(docs).select("id", F.col("row.text").alias("text")).mapInPandas(
        run, f"id long, runs {RUNS}, collapsed string"
    ).select(id_or_null().alias("doc_id"), "runs", "collapsed")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten repeats a stretch of its words up to its end, as its id says.

    A row without an id stays as it is.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (hashed % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.split(F.btrim("text", F.lit(SPACES)), r"[\x20\x09-\x0D]+", -1)
    n, g = F.size(words).cast("long"), F.floor(hashed / 10)
    at = g % n
    period = 1 + F.floor((n - at) / (3 + g % 8))
    unit = F.slice(words, (at + 1).cast("int"), period.cast("int"))
    times = F.ceil((n - at) / period).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - at).cast("int"))
    head = F.slice(words, F.lit(1), at.cast("int"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(chosen, F.array_join(F.concat(head, repeated), " ")).otherwise(F.col("text")).alias("text"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run, and digests of the runs and of the text that is left."""
    order = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
    ))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[
        r[name].cast("string") for name in ("start", "length", "period")
    ]))
    return repeated_runs(docs).select("doc_id", "runs", "collapsed", F.array_max(order).alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
