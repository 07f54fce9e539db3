"""Scores: probability and treatment flag per row of the inference dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.operators.scoring import (
    TreeModel,
    encode_labels,
    impute_median,
    score,
    treat_flag,
)
from featuremart.operators.windows import batch_name, batch_of, sequence_of
from featuremart.plans.dataset import FEATURES

# Fixed values.
BATCH_SIZE = 500_000
THRESHOLD = 0.0187
REGION = "demog_id_rgdesc_na_na"
CATEGORICAL = (
    "demog_personal_pendidikan_na_na",
    "demog_personal_jenis_pekerjaan_na_na",
    "demog_personal_penghasilan_perbulan_na_na",
    REGION,
)
NUMERIC = tuple(name for name in FEATURES if name not in CATEGORICAL)


def model_inputs(
    dataset: DataFrame,
    labels: DataFrame,
    batch_size: int = BATCH_SIZE,
    unseen: str = "error",
    batches: int | None = None,
    medians: str = "batch",
) -> DataFrame:
    """Rows with a region, in batches: numbers without gaps, labels as codes.

    ``labels`` is the fitted label table (feature, label, code). ``medians`` are taken per
    ``batch`` or over the whole snapshot (``global``).
    """
    if medians not in ("batch", "global"):
        raise ValueError(f"medians must be batch or global, not {medians}")
    rows = dataset.withColumn("batch", batch_of(sequence_of(F.col("id")), batch_size))
    scope = "batch" if medians == "batch" else None
    rows = impute_median(rows.dropna(subset=[REGION]), NUMERIC, scope, batches)
    return encode_labels(rows, labels, CATEGORICAL, unseen)


def model_scores(
    dataset: DataFrame,
    model: TreeModel,
    labels: DataFrame,
    batch_size: int = BATCH_SIZE,
    threshold: float = THRESHOLD,
    rows: int | None = None,
    unseen: str = "error",
    medians: str = "batch",
) -> DataFrame:
    """Score one snapshot of the dataset, all batches in one job.

    ``rows`` is the number of rows of the snapshot if it is known; it decides how wide the
    batch names are.
    """
    total = dataset.count() if rows is None else rows
    inputs = model_inputs(dataset, labels, batch_size, unseen, -(-total // batch_size), medians)
    return score(inputs, model, FEATURES, "pred_proba").select(
        "id",
        "user_id",
        "pred_proba",
        treat_flag(F.col("pred_proba"), threshold).alias("is_treat"),
        batch_name(F.col("batch"), total, batch_size).alias("batch"),
    )
