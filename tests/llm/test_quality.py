import numpy as np

from featuremart.llm import quality
from featuremart.llm.queries import QUERIES


def test_agrees_with_the_labels(spark, table):
    """No label is used for training, so all of them are held out."""
    got = QUERIES["op3_weak_label_quality"](spark, "/root/testdata/sf0.1").join(
        table("labels", "sf0.1").withColumnRenamed("quality", "label"), "doc_id"
    ).toPandas()
    assert got[got.label == 1].kept.mean() > 0.99 and got[got.label == 0].kept.mean() < 0.05


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(1)
    n, k = 20000, len(quality.HEURISTICS)
    truth = rng.random(n) < 0.8
    accuracy = np.linspace(0.65, 0.95, k)
    cast = np.where(rng.random((n, k)) < accuracy, truth[:, None], ~truth[:, None]) + 1
    cast[rng.random((n, k)) < 0.3] = quality.NONE
    codes = (cast * 3 ** np.arange(k)).sum(axis=1)
    patterns, counts = np.unique(codes, return_counts=True)
    p, found = quality.estimate(patterns, counts.astype(float))
    assert np.allclose(list(found.values()), accuracy, atol=0.05)
    assert ((p[np.searchsorted(patterns, codes)] > 0.5) == truth).mean() > 0.93


def test_votes_see_each_fault_twice():
    for text in (
        "Bad### text%%% with&&& marks*** all$$$ over### the%%% place&&& here***",
        "SHOUTING!! ALL!! THE!! TIME!! HERE!! AND!! THERE!! TOO!!",
        "again again again again again again other other other other other other other other other other",
        "one | two | three | four | five | six | seven | eight",
    ):
        assert quality.votes(text).count(quality.BAD) >= 2
    assert quality.BAD not in quality.votes("A plain sentence, with words. It goes on for a while, and then ends here.")


def test_edge_rows(documents):
    good = [(i, f"A plain sentence number w{chr(97 + i)}, with words. It goes on for a while, then ends.") for i in range(20)]
    bad = [(i + 50, f"X{chr(65 + i)}!! SHOUTING!! ALL!! THE!! TIME!! HERE!!") for i in range(10)]
    more = [(100, None), (101, ""), (None, "A plain sentence, with words."), (102, "word " * 50000), (0, good[0][1])]
    docs = documents(*good, *bad, *more)
    rows = quality.scores(docs).collect()
    assert len(rows) == docs.count()
    kept = {r.doc_id: r.kept for r in rows}
    assert all(kept[i] for i in range(20)) and not any(kept[i] for i in range(50, 60))
    assert {r.quality for r in rows if r.doc_id == 100} == {r.quality for r in rows if r.doc_id == 101}
    assert quality.scores(docs.limit(0)).count() == 0
