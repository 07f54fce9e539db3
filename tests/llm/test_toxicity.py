import numpy as np
from pyspark.sql import functions as F

from featuremart.llm import toxicity
from featuremart.llm.linear import Linear, fit


def test_held_out_accuracy(spark, table):
    """Models fitted on half of the labels find the toxic documents of the other half."""
    docs, labels = table("documents", "sf0.1"), table("labels", "sf0.1")
    half = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    models = toxicity.train(docs, half)
    rest = labels.join(half.select("doc_id"), "doc_id", "left_anti").withColumnRenamed("toxic", "label")
    got = toxicity.scored(docs, models).select("row.doc_id", "scores.rejected").join(rest, "doc_id").toPandas()
    caught = got[got.label == 1].rejected.mean()
    wrong = got[got.label == 0].rejected.mean()
    assert caught > 0.75 and wrong < 0.01  # measured: 0.80 and 0.002


def test_chain_feeds_earlier_categories():
    """The last category is the xor of two words: only the chain's product of both shows it."""
    rng = np.random.default_rng(0)
    rows, targets = [], []
    for _ in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append(np.array(sorted([1] * a + [2] * b + [int(rng.integers(10, 30))])))
        targets.append((a & b, a | b, a ^ b))
    models = toxicity.fit_chain(rows, np.array(targets, dtype=float))
    assert [len(m.dense) for m in models] == [0, 1, 2]
    for ids, want in (({1}, 1), ({2}, 1), ({1, 2}, 0), (set(), 0)):
        assert round(toxicity.chain_chances(models, ids)[-1]) == want


def test_fit_on_one_value():
    assert fit([np.array([1])] * 3, np.zeros(3)).chance([1]) < 0.01
    assert fit([], np.zeros(0)).chance([1]) < 0.01
    assert Linear({5: 2.0}, [], -1.0).logit([5, 6]) == 1.0


def test_edge_rows(spark, documents):
    toxic = [(i, f"you are an idiot w{i} and a moron") for i in range(0, 40, 2)]
    fine = [(i, f"you are a friend w{i} and a scholar") for i in range(1, 40, 2)]
    more = [(100, None), (101, ""), (102, "what an IDIOT, a moron!"), (None, "idiot and moron"), (103, "w " * 50000)]
    docs = documents(*toxic, *fine, *more, (102, "what an IDIOT, a moron!"))
    labels = spark.createDataFrame(
        [(i, 1, int(i % 2 == 0)) for i in range(40)] + [(3, 1, 0), (100, 1, None), (999, 1, 1), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = {r.doc_id: r.rejected for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i] == (i % 2 == 0) for i in range(40))
    assert got[102] and got[None] and not got[100] and not got[101] and not got[103]
    out = toxicity.clean(docs, labels)
    assert out.columns == docs.columns and out.count() == 23
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.clean(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.clean(docs, labels.filter("toxic = 0")).count() == docs.count()


def test_sample_holds_three_thousand_rows_of_each_label(spark):
    docs = spark.range(7000).selectExpr("id as doc_id", "concat('word w', id) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    found = toxicity.labelled(docs, labels)
    assert {r.toxic: r["count"] for r in found.groupBy("toxic").count().collect()} == {0: 3000, 1: 3000}
    assert dict(found.dtypes)["features"] == "binary"
