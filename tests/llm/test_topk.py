import numpy as np
import pytest
from oracle_check import compare, connect

from featuremart.llm import topk
from featuremart.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, terms string, place long"


def test_matches_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        duck = connect(f"/root/testdata/{sf}")
        assert compare(QUERIES["op10_block_max_topk"](spark, f"/root/testdata/{sf}"), duck, topk.ORACLE) == []


def brute(rows, k=10):
    good = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("chunk, queries", [(4096, 4096), (7, 2)])
def test_edge_rows(spark, chunk, queries):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist(), 0, "t", 1) for i in range(300)]
    rows += [(400 + i, rows[5][1], 0, "t", 1) for i in range(15)]  # ties
    rows += [
        (100, rows[100][1], 0, "t", 1), (201, rows[201][1], 0, "t", 1), (None, rows[0][1], 0, "t", 1),
        (500, None, 0, "t", 1), (600, [1.0, None], 0, "t", 1), (700, [float("nan")] * 6, 0, "t", 1),
        (800, [float("inf")] * 6, 0, "t", 1), (900, [0.5, -0.5], 0, "t", 1), (1000, [], 0, "t", 1),
        (1100, [0.0] * 6, 0, "t", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, chunk=chunk, queries=queries).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))
    assert topk.top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:4], SCHEMA)
    assert {tuple(r) for r in topk.top_k(few).collect()} == brute(rows[:4])


def test_blocks_are_pruned_and_ties_kept():
    """Clustered documents: far blocks are not scored, and the result is exact."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (16, 32))
    docs = np.repeat(centres, 64, axis=0) + rng.integers(-9, 10, (1024, 32))
    ids, queries = np.arange(1024), centres[:5]
    seen = []
    who, found, scores = topk.best_in_chunk(np.arange(5) + 5000, queries, ids, docs, 10, 64, seen)
    assert sum(seen) < 5 * 16 / 2
    exact = docs @ queries.T
    for q in range(5):
        want = sorted(zip(-exact[:, q], ids, strict=True))[:10]
        assert [(-s, i) for s, i in zip(scores[who == q], found[who == q], strict=True)] == want


def test_large_components_are_exact_or_an_error(spark):
    """Products beyond double precision are exact; those beyond 64 bits are an error."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 1e5).tolist(), 0, "t", 1) for i in range(250)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, chunk=100, queries=2).collect()
    assert {tuple(r) for r in got} == brute(rows) and max(r.score for r in got) > 2**53
    for huge in (3e15, 1e30):
        with pytest.raises(Exception, match="fit 64 bits"):
            topk.top_k(spark.createDataFrame([*rows, (300, [huge] * 4, 0, "t", 1)], SCHEMA)).collect()
    sums = np.array([[2**40, -(2**40), 0]]), np.array([[2**40, 2**40, 1], [2**22, 0, 0]])
    with pytest.raises(OverflowError):
        topk.inner(*sums)
    bound = topk.upper_bounds(sums[0], sums[1], sums[1] - 1)
    assert bound[0, 1] >= 2**62 + 2**40 and bound[0, 0] >= 2**40


def test_no_side_is_broadcast_or_copied(spark):
    """Spark would take the queries for small and broadcast the copies made of them for each lane."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), 0, "t", 1) for i in range(300)]
    rows += [(200, rng.normal(size=6).tolist(), 0, "t", 1) for _ in range(30)]  # one id, many queries
    df = topk.top_k(spark.createDataFrame(rows, SCHEMA), chunk=7, queries=2)
    assert {tuple(r) for r in df.collect()} == brute(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan


@pytest.mark.parametrize("most", [9, 900, 2**13, 2**26, 2**29])
def test_best_go_from_chunk_to_chunk(most):
    """Chunks of all sizes of numbers, one after the other, equal one sort of all; ties go to the smaller id."""
    rng = np.random.default_rng(6)
    docs = rng.integers(-most, most + 1, (700, 5))
    docs[::3] //= 64
    queries, query_ids, ids = docs[:40], np.arange(40), np.arange(700)
    best, seen = topk.Best(query_ids, queries, 10), []
    for part in np.array_split(rng.permutation(700), 6):
        best.meet(ids[part], docs[part], 16, seen)
    who, found, scores = best.found()
    for q in range(40):
        exact = [sum(int(a) * int(b) for a, b in zip(queries[q], d, strict=True)) for d in docs]
        want = sorted((-s, i) for i, s in enumerate(exact) if i != q)[:10]
        assert [(-s, i) for s, i in zip(scores[who == q], found[who == q], strict=True)] == want
    assert sum(seen) <= 40 * sum(-(-len(p) // 16) for p in np.array_split(ids, 6))


def test_products_take_the_narrowest_exact_type():
    one = np.array([[2**12, 0]])
    assert topk.exact_type(one - [[1, 0]], one) is np.float32 and topk.exact_type(one, one) is np.float64
    assert topk.exact_type(one * 2**15, one * 2**14) is None
    odd = np.array([[2**12 + 1, 2**12 - 1, 1]])
    assert topk.inner(odd, odd)[0, 0] == 2**25 + 3
    assert topk.inner(odd * 2**15 + 1, odd * 2**15 + 1)[0, 0] == sum((int(x) * 2**15 + 1) ** 2 for x in odd[0])


@pytest.mark.parametrize("most", [0, 2**15 - 1, 2**15, 2**31 - 1, 2**31, 2**63 - 1])
def test_packed_rows_are_read_as_written(most):
    rows = [[most, -most - 1], [], [-1]]
    row = topk.packed_rows(np.array([5, -(2**63), 7]), rows).iloc[0]
    ids, matrix = topk.unpacked(row["ids"], row["width"], row["matrix"])
    assert ids.tolist() == [5, -(2**63), 7] and matrix.dtype == np.int64
    assert matrix.tolist() == [[most, -most - 1], [0, 0], [-1, 0]]
    assert len(row["matrix"]) == 6 * (2 if most < 2**15 else 4 if most < 2**31 else 8)
    empty = topk.packed_rows(np.array([1, 2]), [[], []]).iloc[0]
    assert topk.unpacked(empty["ids"], empty["width"], empty["matrix"])[1].shape == (2, 0)
