"""Toxicity by a classifier chain over hashed word features.

Categories are predicted one after the other; the model of a category also sees the logits of
those before it. Models are fitted on a bounded sample of labelled rows: at most ``MAX_ROWS`` of
each value of the last category, the first by a hash of the id. For fitting, the earlier logits of a
row come from models that did not see it (out-of-fold); for scoring, from models fitted on all of
the sample. Every document is scored on its whole text, in the tasks, with the models (some
thousand numbers) in the closure; nothing is shuffled.

The categories here derive from the one label of the tables: ``insult`` and ``contempt`` are toxic
rows that hold a listed word, ``unlisted`` toxic rows that hold none (other words, other languages),
and ``toxic`` is the label. A document is rejected if the chance of the last category reaches the
threshold.

Edge cases. A null text counts as empty. A text without any feature of the models is never rejected. Labels that are null, and labels of unknown documents, are
not used; of repeated labels the largest counts. With no labelled rows, or labels of one value,
the models are constant. Repeated rows get the same scores. An empty table gives no rows. Other
columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.linear import EDGES, Features, Linear, fit, tokens, word_features

MAX_ROWS = 3000
FOLDS = 3
THRESHOLD = 0.5
# Words that name a category.
INSULT = ("clown", "idiot", "loser", "moron", "stupid")
CONTEMPT = ("disgusting", "pathetic", "scum", "trash", "worthless")
CATEGORIES = ("insult", "contempt", "unlisted", "toxic")
ROW = T.StructType([
    T.StructField("features", T.BinaryType()),  # sorted int32; as an array each number is an object on the driver
    *[T.StructField(c, T.IntegerType()) for c in CATEGORIES],
])


def categories(text: str | None, toxic: int) -> tuple[int, ...]:
    """Labels of a row for each category of the chain."""
    words = {t.strip(EDGES) for t in tokens(text)}
    insult, contempt = not words.isdisjoint(INSULT), not words.isdisjoint(CONTEMPT)
    return tuple(int(toxic and c) for c in (insult, contempt, not insult and not contempt, True))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS, seed: int = 1) -> DataFrame:
    """features and categories of the bounded sample, ``most`` rows of each label at most."""
    marked = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id", F.lit(seed))
    sample = marked.filter("toxic = 0").orderBy(order, "doc_id").limit(most).union(
        marked.filter("toxic <> 0").orderBy(order, "doc_id").limit(most)
    ).select(F.col("doc_id").alias("label_id"), "toxic")

    @F.pandas_udf(ROW)
    def describe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        features = Features(word_features)
        for texts, toxic in batches:
            yield pd.DataFrame(
                [(np.sort(np.fromiter(features(tokens(t)), "<i4")).tobytes(), *categories(t, int(y)))
                 for t, y in zip(texts, toxic, strict=True)], columns=["features", *CATEGORIES],
            )

    # The sample is bounded, so it may be broadcast: the documents are not shuffled for it.
    return (
        docs.select(F.col("doc_id"), F.col("text"))
        .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", describe("text", "toxic").alias("row"))
        .dropDuplicates(["doc_id"])
        .select("doc_id", "row.*")
    )


def fit_chain(
    rows: list[np.ndarray], targets: np.ndarray, folds: int = FOLDS
) -> list[Linear]:
    """Models of the categories (columns of ``targets``) in order."""
    n, count = targets.shape
    earlier = np.zeros((n, 0))
    models = []
    for c in range(count):
        target = targets[:, c]
        models.append(fit(rows, target, earlier))
        out = np.zeros(n)
        for k in range(folds):
            held = np.arange(n) % folds == k
            model = fit([r for r, h in zip(rows, held, strict=True) if not h], target[~held], earlier[~held])
            for i in np.flatnonzero(held):
                out[i] = model.logit(rows[i].tolist(), earlier[i])
        earlier = np.column_stack([earlier, np.clip(out, -8, 8)])
    return models


def chain_chances(models: Sequence[Linear], ids: set[int]) -> list[float]:
    """Chance of each category for a row with these features."""
    logits: list[float] = []
    for model in models:
        logits.append(float(np.clip(model.logit(ids, logits), -8, 8)))
    return [float(1 / (1 + np.exp(-x))) for x in logits]


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> list[Linear]:
    found = labelled(docs, labels, most).orderBy("doc_id").toPandas()  # bounded by 2 * most rows
    rows = [np.frombuffer(f, dtype="<i4") for f in found.pop("features")]
    return fit_chain(rows, found[list(CATEGORIES)].to_numpy(dtype=np.float64).reshape(-1, len(CATEGORIES)))


def scored(docs: DataFrame, models: Sequence[Linear], threshold: float = THRESHOLD) -> DataFrame:
    """Columns of ``docs`` as struct ``row``, and ``scores``: chance by category, and rejected."""
    fields = [T.StructField(c, T.DoubleType()) for c in CATEGORIES]
    schema = T.StructType([*fields, T.StructField("rejected", T.BooleanType())])

    @F.pandas_udf(schema)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features(word_features, {i for m in models for i in m.weights})
        for texts in batches:
            out = []
            for text in texts:
                ids = features(tokens(text))
                chances = chain_chances(models, ids)
                out.append((*chances, bool(ids) and chances[-1] >= threshold))
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score("text").alias("scores")
    )


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, chance of each category, rejected."""
    return scored(docs, train(docs, labels, **options)).select("row.doc_id", "scores.*")


def clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected; columns of ``docs``."""
    return scored(docs, train(docs, labels, **options)).filter("not scores.rejected").select("row.*")
