from collections import defaultdict

import corpus_pipeline
import numpy as np

from featuremart.llm import resemblance

SF = "/root/testdata/sf0.01"


def brute_first(rows):
    """Smallest id of the component of each row, by the similarity of every pair."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders, empty = defaultdict(list), []
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for shingle in s:
            for j in holders[shingle]:
                both[j] += 1
            holders[shingle].append(i)
        near = [j for j, n in both.items() if 5 * n >= 4 * (len(s) + len(sets[j]) - n)]
        for j in near if s else empty[:1]:
            root[max(find(i), find(j))] = min(find(i), find(j))
        if not s:
            empty.append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return set(least.values())


def test_stage_equals_brute_force(spark, table):
    docs = table("documents")
    want = brute_first([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(want)


def edited(words, at):
    return " ".join(f"x{w}" if i in at else w for i, w in enumerate(words))


def test_edited_copies_go_and_edge_rows(documents):
    words = [f"w{i}" for i in range(200)]
    rows = [
        (1, " ".join(words)), (2, edited(words, {20, 90, 150})), (3, edited(words, set(range(5, 200, 20)))),
        (4, None), (5, ""), (6, " \n"), (7, "two words"), (7, "TWO words"), (8, "two others"), (None, "no id"),
        (None, "two words"),
    ]
    docs = documents(*rows)
    got = sorted((r.doc_id or 0) for r in resemblance.one_of_each(docs).collect())
    assert got == [0, 1, 3, 4, 7, 8]
    assert resemblance.one_of_each(docs.limit(0)).count() == 0


def test_blocks_find_the_same_components(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(150)]
    texts = [edited(words, set(rng.integers(0, 150, int(rng.integers(1, 8))).tolist())) for _ in range(120)]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "node long, cluster long, text string")
    for block in (16, 1024):
        pairs = resemblance.components(resemblance.links(df, block=block)).collect()
        linked = {r.node: r.component for r in pairs}
        assert {linked.get(i, i) for i in range(120)} == brute_first(list(enumerate(texts)))


def test_fingerprints_tie_and_discard(spark):
    """Nodes within two bits are tied without a common cell; in a cluster fingerprints leave few pairs to verify."""
    rows = [(1, 0b11, [10]), (2, 0b11, [20]), (3, 0b1001, [30]), (4, 2**40 - 1, [40]), (5, 7 << 50, [40]), (6, -1, [])]
    nodes = spark.createDataFrame(rows, "node long, print long, cells array<long>")
    tied = {r.node: r.cluster for r in resemblance.clusters(nodes).collect()}
    assert tied == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64)) for _ in range(300)]
    for i in range(0, 300, 3):  # 54 of 66 in common
        sets[i + 1] = np.unique(np.concatenate([sets[i][6:], sets[i + 1][:6]]))
    counts = {}
    found = resemblance.similar(sets, np.zeros(300), counts=counts)
    assert sorted(found) == [(i, i + 1) for i in range(0, 300, 3)]
    assert counts["met"] > 40_000 and 100 <= counts["verified"] < 200


def test_no_small_pair_at_the_threshold_is_discarded():
    """Sets of few shingles differ in more bits, by ties: the widest distance seen stays far inside the radius."""
    rng = np.random.default_rng(9)
    widest = 0
    for size in (4, 8, 9, 20, 60):
        for _ in range(400):
            whole = rng.integers(0, 2**64, size + size // 4, dtype=np.uint64)
            a, b = resemblance.wide_print(whole[:size]), resemblance.wide_print(whole)
            widest = max(widest, int(np.bitwise_count(a ^ b).sum()))
    assert 30 < widest < resemblance.radius(0.8) - 10
