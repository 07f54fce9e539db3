"""Document quality by a weak-label model and a hashed linear scorer.

Overlapping heuristics vote on each document: good, bad, or no vote. Expectation-maximisation
estimates from the agreement of the votes alone how often each heuristic votes how on good and on bad
documents. It sees every document, as counts by vote pattern: at most 3 ** heuristics patterns,
however many documents there are. The posterior of a pattern is a soft label. A linear model over
hashed token shapes is trained on those labels, on a bounded sample (``MAX_ROWS`` documents of either
side, the first by a hash of the id), and scores every document on its whole text.

Edge cases. A null text counts as empty; empty texts are bad by the length heuristic and get the score
of a text without features. Repeated rows get the same score. If all posteriors fall on one side the
model is constant. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import operator
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.common import id_or_null, packed, staged
from featuremart.llm.linear import Features, Linear, fit, hashed

MAX_ROWS = 3000
ROUNDS = 60
THRESHOLD = 0.5
NONE, BAD, GOOD = 0, 1, 2
HEURISTICS = (
    "symbols", "decorated", "capitals", "exclaims", "stutter", "distinct", "bars", "sentences",
    "plain", "length",
)
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL = range(6)


def _kinds() -> np.ndarray:
    kinds = np.full(0x3000, LOWER, dtype=np.uint8)
    for i in range(len(kinds)):
        c, kind = chr(i), unicodedata.category(chr(i))
        if kind in ("Lu", "Lt"):
            kinds[i] = UPPER
        elif kind[0] == "N":
            kinds[i] = DIGIT
        elif c.isspace():
            kinds[i] = SPACE
        elif c in ".,;:?'\"-()!":
            kinds[i] = STOP
        elif kind[0] in "PSC":
            kinds[i] = SYMBOL
    return kinds


KINDS = _kinds()


PLAIN = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*[.,;:?]?")
DECORATED = re.compile(r"([^\w\s.])\1$")


def vote(bad: bool, good: bool = False) -> int:
    return BAD if bad else GOOD if good else NONE


def votes(text: str | None) -> tuple[int, ...]:
    """The vote of each heuristic; every kind of fault is seen by two or more."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    count = np.bincount(KINDS[np.minimum(codes, len(KINDS) - 1)], minlength=6)
    words = text.split()
    kinds = Counter(words)
    n, letters = max(len(words), 1), max(count[LOWER] + count[UPPER], 1)
    plain = sum(c for w, c in kinds.items() if PLAIN.fullmatch(w)) / n
    decorated = sum(c for w, c in kinds.items() if DECORATED.search(w)) / n
    ends = sum(c for w, c in kinds.items() if w[-1] in ".,;:?") / n
    return (
        vote(count[SYMBOL] > 0.05 * max(len(codes) - count[SPACE], 1)),
        vote(decorated > 0.2),
        vote(count[UPPER] > 0.5 * letters and len(words) >= 5),
        vote(text.count("!!") > 0.1 * n),
        vote(sum(map(operator.eq, words, words[1:])) > 0.15 * n),
        vote(len(kinds) < 0.25 * n and n < 2000),
        vote(kinds["|"] > 0.1 * n),
        vote(ends > 0.8 and n >= 15, 0.03 < ends < 0.5),
        vote(plain < 0.6, plain > 0.9),
        vote(not words, n >= 15),
    )


def pattern_column(text):
    """Votes as one number in base 3."""

    @F.pandas_udf(T.IntegerType())
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [sum(v * 3**i for i, v in enumerate(votes(t))) for t in texts], dtype="int32"
            )

    return code(text)


def unpack(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS):
    """Posterior of good for each pattern, and the accuracy of each heuristic where it votes."""
    cast = unpack(patterns)
    bad, good = (cast == BAD).sum(axis=1), (cast == GOOD).sum(axis=1)
    p = np.where((bad > 1) | (bad > good), 0.05, 0.95)  # at first two bad votes are enough
    weight = counts / max(counts.sum(), 1)
    hot = np.stack([cast == v for v in (NONE, BAD, GOOD)], axis=2).astype(float)
    for _ in range(rounds):
        share = [np.clip((weight * q).sum(), 1e-6, 1 - 1e-6) for q in (1 - p, p)]
        rates = [
            (np.einsum("p,phv->hv", weight * q, hot) + 1e-4) / (s + 3e-4)
            for q, s in zip((1 - p, p), share, strict=True)
        ]
        log = [np.log(s) + np.einsum("phv,hv->p", hot, np.log(r)) for s, r in zip(share, rates, strict=True)]
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    right = share[0] * rates[0][:, BAD] + share[1] * rates[1][:, GOOD]
    cast_at_all = sum(s * (r[:, BAD] + r[:, GOOD]) for s, r in zip(share, rates, strict=True))
    return p, dict(zip(HEURISTICS, right / cast_at_all, strict=True))


def shape_features(token: str) -> tuple[int, ...]:
    """The shape of a token (runs of capitals, small letters, digits and marks) and its end."""
    shape = re.sub(r"[^\W\d_]+", lambda m: "X" if m[0].isupper() else "Xx" if m[0][0].isupper() else "x", token)
    shape = re.sub(r"\d+", "0", shape)
    end = re.search(r"[\W_]*$", token)[0]
    return hashed("s" + shape[:16]), hashed("e" + end[-3:])


def shapes(text: str | None) -> set[str]:
    """Different tokens, and one mark for every doubling of the immediate repeats."""
    words = (text or "").split()
    again = sum(map(operator.eq, words, words[1:]))
    found = set(map(sys.intern, words))
    found.update(f"\x00again{2**k}" for k in range(again.bit_length()) if 8 * again > len(words))
    return found


def train(docs: DataFrame, most: int = MAX_ROWS, seed: int = 1) -> tuple[Linear, dict[str, float]]:
    """The scorer, and the estimated accuracy of each heuristic."""
    rows = packed(docs)
    cast, _ = staged(rows.select("id", "text_hash", pattern_column(F.col("row.text")).alias("pattern")), "votes")
    counts = cast.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).toPandas()  # 3 ** 10 at most
    patterns = counts["pattern"].to_numpy(np.int64)
    if not len(patterns):
        return Linear(), {}
    p, accuracy = estimate(patterns, counts["n"].to_numpy(np.float64))
    soft = docs.sparkSession.createDataFrame(
        list(zip(patterns.tolist(), p.tolist(), strict=True)), "pattern int, good double"
    )
    order = F.xxhash64("id", "text_hash", F.lit(seed))
    marked = cast.join(soft, "pattern").select("id", "text_hash", "good").dropDuplicates(["id", "text_hash"])
    sample = marked.filter("good < 0.5").orderBy(order).limit(most).union(
        marked.filter("good >= 0.5").orderBy(order).limit(most)
    )

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(shape_features)
        for texts in batches:
            yield pd.Series([sorted(features(shapes(t))) for t in texts])

    # The sample is bounded, so it may be broadcast: the documents are not shuffled for it.
    found = (
        rows.join(F.broadcast(sample), ["id", "text_hash"])
        .select("id", "text_hash", "good", describe(F.col("row.text")).alias("features"))
        .dropDuplicates(["id", "text_hash"])
        .orderBy("id", "text_hash")
        .toPandas()
    )
    features = [np.array(f, dtype=np.int64) for f in found["features"]]
    return fit(features, found["good"].to_numpy(np.float64)), accuracy


def scores(docs: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, quality (chance of good), kept."""
    model, _ = train(docs, **options)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(shape_features, model.weights)
        for texts in batches:
            yield pd.Series([model.chance(features(shapes(t))) for t in texts], dtype="float64")

    return (
        packed(docs)
        .select(id_or_null().alias("doc_id"), score(F.col("row.text")).alias("quality"))
        .withColumn("kept", F.col("quality") >= threshold)
    )
