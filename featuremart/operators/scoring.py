"""Imputation, label encoding and model scoring, all on the executors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.operators.aggregates import median_by, number_or_null
from featuremart.operators.selection import exact_medians

MAX_BROADCAST_ROWS = 100_000
MAX_MODEL_NODES = 1_000_000
# Above this size a model is evaluated on Arrow batches, as its expression would outgrow what
# the JVM compiles into one method.
MAX_EXPRESSION_NODES = 500


def impute_median(
    df: DataFrame, columns: Sequence[str], batch: str | None, batches: int | None = None
) -> DataFrame:
    """Replace missing numbers by the median of the row's scoring batch.

    With ``batch`` None the medians are those of all rows, narrowed down in a few passes (see
    ``selection``), so that no task holds a column's values.

    Columns come back as doubles; a batch without any value keeps NULL. A batch has a fixed
    number of rows, so no task holds more values than that. There is one row of medians per
    batch; they are broadcast when the number of ``batches`` is known and small, and are
    joined as Spark sees fit otherwise.
    """
    if batch is None:
        filled = {}
        for name, median in exact_medians(df, columns).items():
            filled[name] = F.coalesce(number_or_null(F.col(name).cast("double")), F.lit(median).cast("double"))
        return df.withColumns(filled).select(*df.columns)
    medians = median_by(df, batch, columns).select(
        batch, *[F.col(c).alias(f"_median_{c}") for c in columns]
    )
    filled = {c: F.coalesce(number_or_null(F.col(c)), F.col(f"_median_{c}")) for c in columns}
    if batches is not None and batches <= MAX_BROADCAST_ROWS:
        medians = F.broadcast(medians)
    out = df.join(medians, batch, "left").withColumns(filled)
    return out.select(*df.columns)


def fit_labels(df: DataFrame, *columns: str) -> DataFrame:
    """Table (feature, label, code) of the distinct labels of the columns in code-point order.

    A label's place among those of its column is its code. One task sees the distinct labels of a
    column, not its rows.
    """
    place = F.row_number().over(Window.partitionBy("feature").orderBy("label")) - 1
    found = [
        df.select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("label")) for c in columns
    ]
    return reduce(DataFrame.unionAll, found).dropna().distinct().withColumn("code", place)


def apply_labels(df: DataFrame, fitted: DataFrame, column: str, unseen: str = "error") -> DataFrame:
    """Replace the labels of a column by their codes from the label table, by a join.

    The table never comes to the driver. Spark broadcasts it below the size limit of the session and
    shuffles it beyond, where adaptive execution splits a frequent label. A label that was not there
    at fitting (NULL too) is an error, becomes NULL (``null``), or gets one code past the last (``keep``).
    """
    codes = fitted.filter(F.col("feature") == column).select(
        F.col("label").alias(column), F.col("code").alias("_code")
    )
    joined = df.join(codes, column, "left")
    code = F.col("_code")
    if unseen == "keep":
        # One past the last code; the number of codes is one value, looked up inside the query.
        size = codes.agg(F.count(F.lit(1)).cast("int")).scalar()
        code = F.coalesce(code, size)
    elif unseen == "error":
        message = F.concat(
            F.lit("label not seen when fitted: "), F.coalesce(F.col(column), F.lit("NULL"))
        )
        code = F.coalesce(code, F.raise_error(message).cast("int"))
    elif unseen != "null":
        raise ValueError(f"unseen must be error, null or keep, not {unseen}")
    return joined.withColumn(column, code).select(*df.columns)


def encode_labels(
    df: DataFrame, fitted: DataFrame, columns: Sequence[str], unseen: str = "error"
) -> DataFrame:
    """``apply_labels`` for several columns."""
    return reduce(lambda out, column: apply_labels(out, fitted, column, unseen), columns, df)


@dataclass(frozen=True)
class Node:
    """A node of a tree. A split sends values below ``threshold`` to ``yes``, others to ``no``,
    and missing ones to ``missing``; a node without ``feature`` is a leaf with value ``leaf``."""

    tree: int
    node: int
    feature: str | None
    threshold: float | None
    yes: int | None
    no: int | None
    missing: int | None
    leaf: float | None


@dataclass(frozen=True)
class TreeModel:
    """Boosted trees for a two-class model; the probability of class 1 is the logistic
    function of the base margin plus one leaf per tree."""

    nodes: tuple[Node, ...]
    base_score: float = 0.5
    # Compare features with thresholds in single precision, as boosted trees are often trained.
    single: bool = False

    @property
    def margin(self) -> float:
        return log(self.base_score / (1 - self.base_score))

    def trees(self) -> dict[int, dict[int, Node]]:
        out: dict[int, dict[int, Node]] = {}
        for node in self.nodes:
            out.setdefault(node.tree, {})[node.node] = node
        return dict(sorted(out.items()))

    def features(self) -> list[str]:
        return sorted({node.feature for node in self.nodes if node.feature})

    @classmethod
    def from_table(
        cls, df: DataFrame, base_score: float = 0.5, single: bool = False
    ) -> TreeModel:
        """Read the node table of a model; its size is checked before it comes to the driver."""
        names = list(Node.__dataclass_fields__)
        rows = df.select(*names).limit(MAX_MODEL_NODES + 1).collect()
        if len(rows) > MAX_MODEL_NODES:
            raise ValueError(f"model has more than {MAX_MODEL_NODES} nodes")
        return cls(tuple(Node(**row.asDict()) for row in rows), base_score, single)


def tree_expression(nodes: Mapping[int, Node], at: int = 0, single: bool = False) -> Column:
    """One tree as a nested conditional expression."""
    node = nodes[at]
    if node.feature is None:
        return F.lit(float(node.leaf))
    value = number_or_null(F.col(node.feature).cast("double"))  # NaN is missing, as in batches
    threshold = F.lit(float(node.threshold))
    if single:
        value, threshold = value.cast("float"), threshold.cast("float")
    return (
        F.when(value.isNull(), tree_expression(nodes, node.missing, single))
        .when(value < threshold, tree_expression(nodes, node.yes, single))
        .otherwise(tree_expression(nodes, node.no, single))
    )


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def score_expression(model: TreeModel) -> Column:
    """Probability of class 1 as a native expression, compiled into the scan stage."""
    margin = F.lit(model.margin)
    for nodes in model.trees().values():
        margin = margin + tree_expression(nodes, 0, model.single)
    return logistic(margin)


def score_in_batches(df: DataFrame, predict, features: Sequence[str], name: str) -> DataFrame:
    """Append ``predict(values)`` to every row, one Arrow batch at a time.

    ``predict`` takes an array of shape (rows, features) with NaN for missing values and gives
    one probability per row. It reaches every executor once, as a broadcast variable. Only the
    features leave the JVM; all other columns stay as they are.
    """
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(predict))

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = cloudpickle.loads(shared.value)
        for columns in batches:
            values = np.column_stack([c.to_numpy("float64", na_value=np.nan) for c in columns])
            yield pd.Series(model(values))

    return df.withColumn(name, run(*[F.col(f).cast("double") for f in features]))


def tree_predictor(model: TreeModel, features: Sequence[str]):
    """The model as a function on arrays: all rows walk down one tree at a time, level by level."""
    place = {name: i for i, name in enumerate(features)}
    tables = []
    for nodes in model.trees().values():
        row_of = {number: row for row, number in enumerate(sorted(nodes))}
        ordered = [nodes[number] for number in sorted(nodes)]
        leaf = np.array([node.feature is None for node in ordered])
        tables.append((
            leaf,
            np.array([0 if node.feature is None else place[node.feature] for node in ordered]),
            np.array(
                [0.0 if node.feature is None else node.threshold for node in ordered],
                dtype=np.float32 if model.single else np.float64,
            ),
            np.array([
                [row_of[node.yes], row_of[node.no], row_of[node.missing]]
                if node.feature is not None else [0, 0, 0]
                for node in ordered
            ]),
            np.array([node.leaf if node.feature is None else 0.0 for node in ordered]),
            row_of[0],
        ))
    start, kind = model.margin, np.float32 if model.single else np.float64

    def predict(values: np.ndarray) -> np.ndarray:
        values = values.astype(kind)
        rows = np.arange(len(values))
        margin = np.full(len(values), start)
        for leaf, feature, threshold, children, weight, root in tables:
            at = np.full(len(values), root)
            while not leaf[at].all():
                seen = values[rows, feature[at]]
                branch = np.where(np.isnan(seen), 2, np.where(seen < threshold[at], 0, 1))
                at = np.where(leaf[at], at, children[at, branch])
            margin += weight[at]
        return 1.0 / (1.0 + np.exp(-margin))

    return predict


def score(df: DataFrame, model: TreeModel, features: Sequence[str], name: str) -> DataFrame:
    """Score with whichever of the two forms suits the size of the model; both give the same."""
    if len(model.nodes) <= MAX_EXPRESSION_NODES:
        return df.withColumn(name, score_expression(model))
    return score_in_batches(df, tree_predictor(model, features), features, name)


def treat_flag(probability: Column, threshold: float) -> Column:
    """1 when the probability is strictly above the threshold, else 0."""
    return F.when(probability > F.lit(threshold), 1).otherwise(0)


def label_table(spark: SparkSession, fitted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fitted labels as a table (feature, label, code), the form in which they are kept."""
    rows = [
        (feature, label, code)
        for feature, known in fitted.items()
        for code, label in enumerate(known)
    ]
    return spark.createDataFrame(rows, "feature string, label string, code int")


def fitted_labels(labels: DataFrame, version: str | None = None) -> DataFrame:
    """The labels (feature, label, code) of one version of a label table, the greatest if not named.

    A table without a column ``version`` is one version. Choosing is part of the plan, no job of its own.
    """
    if "version" not in labels.columns:
        if version is not None:
            raise ValueError("the label table has no versions")
        return labels.select("feature", "label", "code")
    wanted = F.lit(version) if version is not None else labels.agg(F.max("version")).scalar()
    return labels.filter(F.col("version") == wanted).select("feature", "label", "code")
