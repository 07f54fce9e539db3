"""A hand-written dump of boosted trees scores as an evaluator of its own says."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.operators.model_dump import dump_nodes, read_dump
from featuremart.operators.scoring import TreeModel, score, score_expression

FEATURES = ["a", "b", "c"]


def branch(rng, depth, number):
    """A nested node; children are numbered as in a binary heap, stated in either order."""
    if depth == 0 or rng.random() < 0.15:
        return {"nodeid": number, "leaf": round(rng.uniform(-0.1, 0.1), 9)}
    yes, no = 2 * number + 1, 2 * number + 2
    children = [branch(rng, depth - 1, yes), branch(rng, depth - 1, no)]
    rng.shuffle(children)
    return {
        "nodeid": number, "depth": 9, "split": rng.choice(FEATURES), "gain": 1.5, "cover": 2,
        # Values that differ in double precision and are alike in single precision.
        "split_condition": rng.choice([0.1, 0.30000001, 7, -2.5, 1e-3]),
        "yes": yes, "no": no, "missing": rng.choice([yes, no]), "children": children,
    }


def leaf_of(node, row):
    while "leaf" not in node:
        value = row[node["split"]]
        if value is None or math.isnan(value):
            goes = node["missing"]
        else:
            goes = node["yes"] if np.float32(value) < np.float32(node["split_condition"]) else node["no"]
        node = next(child for child in node["children"] if child["nodeid"] == goes)
    return float(np.float32(node["leaf"]))


def probability(trees, row, base=0.5):
    margin = math.log(base / (1 - base)) + sum(leaf_of(tree, row) for tree in trees)
    return 1 / (1 + math.exp(-margin))


def dumped(spark, trees):
    return spark.createDataFrame([(json.dumps(trees),)], "value string")


def test_dump_of_150_trees(spark, tmp_path):
    rng = random.Random(4)
    trees = [branch(rng, 5, 0) for _ in range(150)]
    (tmp_path / "dump.json").write_text(json.dumps(trees, indent=2))
    model = TreeModel.from_table(read_dump(spark, str(tmp_path / "dump.json")), 0.3, single=True)
    assert len(model.trees()) == 150 and sum(n.feature is None for n in model.nodes) > 1000
    values = [None, math.nan, 0.1, float(np.float32(0.1)), 0.3, 0.30000001, 7.0, -2.5, 1e-3, 5.0, -9.0]
    made = [(i, *[rng.choice(values) for _ in FEATURES]) for i in range(200)]
    df = spark.createDataFrame(made, "i int, a double, b double, c double")
    got = {r.i: r.p for r in score(df, model, FEATURES, "p").collect()}
    for i, *row in made:
        assert got[i] == pytest.approx(probability(trees, dict(zip(FEATURES, row, strict=True)), 0.3), rel=1e-12)


def test_both_forms_agree_on_small_dumps(spark):
    rng = random.Random(5)
    trees = [branch(rng, 2, 0) for _ in range(6)] + [{"nodeid": 0, "leaf": 0.25}]
    model = TreeModel.from_table(dump_nodes(dumped(spark, trees)), single=True)
    df = spark.createDataFrame([(0.1, None, 7.0), (math.nan, 0.3, -2.5)], "a double, b double, c double")
    got = [r.p for r in df.withColumn("p", score_expression(model)).collect()]
    want = [probability(trees, r.asDict()) for r in df.collect()]
    assert got == pytest.approx(want, rel=1e-12)
    assert dump_nodes(dumped(spark, [])).count() == 0


SPLIT = {"nodeid": 0, "split": "a", "split_condition": 1.0, "yes": 1, "no": 2, "missing": 1,
         "children": [{"nodeid": 1, "leaf": 1}, {"nodeid": 2, "leaf": 2}]}


@pytest.mark.parametrize("change", [
    {"split_condition": [1, 2]}, {"split_condition": None}, {"missing": None}, {"nodeid": None}, {"split": None},
])
def test_what_cannot_be_read_is_an_error(spark, change):
    assert dump_nodes(dumped(spark, [SPLIT])).count() == 3
    with pytest.raises(Exception, match="cannot be read in tree 0"):
        dump_nodes(dumped(spark, [{**SPLIT, **change}])).collect()


def test_one_whole_dump_is_asked_for(spark):
    with pytest.raises(Exception, match="not one dump"):
        dump_nodes(dumped(spark, []).union(dumped(spark, []))).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        dump_nodes(spark.createDataFrame([("[{",)], "value string")).collect()
    assert dump_nodes(dumped(spark, [SPLIT])).filter(F.col("feature") == "a").count() == 1
