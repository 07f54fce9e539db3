import os
import random
from collections import Counter
from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featuremart.operators import sinks, snapshots
from featuremart.operators.aggregates import (
    CELLS,
    FAMILIES,
    count_distinct_if,
    measure_matrix,
    median_by,
    null_safe_total,
    sum_or_null,
    sum_or_zero,
)
from featuremart.operators.joins import skew_join
from featuremart.operators.scoring import (
    Node,
    TreeModel,
    apply_labels,
    encode_labels,
    fit_labels,
    impute_median,
    label_table,
    score,
    score_expression,
    score_in_batches,
    treat_flag,
    tree_predictor,
)
from featuremart.operators.scratch import scratch_dir, scratch_scope, stage
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.windows import (
    batch_name,
    batch_of,
    keep_first,
    number_rows,
    row_id,
    sequence_of,
)

MODIFIED = datetime(2023, 3, 6, 8, 0, 0)


def rows(df):
    return Counter(map(tuple, df.collect()))


# ---- joins


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows of each side; one key and NULL exist on one side only."""
    draw = random.Random(7)
    left = [("hot" if i % 3 == 0 else f"k{draw.randrange(60)}", i) for i in range(900)]
    left += [(None, -1), ("left only", -2)]
    right = [("hot" if i % 3 == 0 else f"k{draw.randrange(60)}", 10_000 + i) for i in range(90)]
    right += [("right only", -3)]
    return (
        spark.createDataFrame(left, "key string, l long"),
        spark.createDataFrame(right, "key string, r long"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(skewed, how):
    for left, right in (skewed, (skewed[1].withColumnRenamed("r", "l"), skewed[0].withColumnRenamed("l", "r"))):
        joined = skew_join(left, right, "key", how)
        assert rows(joined.select("key", "l", "r")) == rows(
            left.join(right, "key", how).select("key", "l", "r")
        )


@settings(max_examples=12, deadline=None)
@given(
    left=st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=12),
    right=st.lists(st.sampled_from(["a", "b", "c", "e", None]), max_size=12),
    how=st.sampled_from(["inner", "left"]),
)
def test_skew_join_on_any_rows(spark, left, right, how):
    """Alike rows, keys missing on either side, empty sides."""
    one = spark.createDataFrame([(k, 1) for k in left], "key string, l int")
    two = spark.createDataFrame([(k, 2) for k in right], "key string, r int")
    assert rows(skew_join(one, two, "key", how)) == rows(one.join(two, "key", how))
    known = one.dropna()
    assert rows(skew_join(known, two, "key", how, two.select("key"), null_keys=False)) == rows(
        known.join(two, "key", how)
    )


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("side", ["left", "right"])
def test_adaptive_execution_splits_a_hot_key(spark, how, side):
    """A third of one side has one key, whichever side it is."""
    hot = spark.range(60_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.md5(F.col("id").cast("string")).alias("x")
    )
    other = spark.range(0, 60_000, 2, numPartitions=4).select(F.col("id").alias("key"), F.lit(1).alias("y"))
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        joined = skew_join(hot, other, "key", how) if side == "left" else skew_join(other, hot, "key", how)
        # The split is kept though the next step needs the keys together.
        counted = joined.groupBy("key").agg(F.max("x"), F.count("y"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- aggregates


def naive_matrix(data):
    family_of = {short: (name, flag) for name, short, flag, _ in FAMILIES}
    out = {}
    for user, account, flag, family, status, currency, credit, deposit in data:
        cells = out.setdefault(user, {c.name: (set(), []) for c in CELLS})
        for c in CELLS:
            if (
                (family, flag) == family_of[c.short] and status is not None
                and (status == 1) == c.active and currency is not None
                and (currency == "IDR") == c.local
            ):
                if account is not None:
                    cells[c.name][0].add(account)
                cells[c.name][1].append(deposit if c.short == "dep" else credit)
    return {
        user: {n: (len(a), sum(s) if s else None) for n, (a, s) in cells.items()}
        for user, cells in out.items()
    }


def test_measure_matrix_against_brute_force(spark, plan_of):
    draw = random.Random(3)
    data = [
        (
            "hot" if draw.random() < 0.3 else f"u{draw.randrange(20)}",
            draw.choice([None, *[f"a{i}" for i in range(15)]]),
            draw.choice(["DEPO", "NON_DEPO"]),
            draw.choice(["TABUNGAN", "GIRO", "DEPOSITO", "OTHER", None]),
            draw.choice([1, 2, 3, None]),
            draw.choice(["IDR", "USD", None]),
            draw.randrange(100),
            draw.randrange(1000, 1100),
        )
        for _ in range(3000)
    ] + [("nothing", "a1", "DEPO", "GIRO", 1, "IDR", 5, 5)]
    df = spark.createDataFrame(
        data,
        "user_id string, acct_num string, flag string, keterangan string, status int, "
        "curr_type string, credit_balance long, deposit_balance long",
    )
    result = measure_matrix(df, "user_id", "acct_num")
    got = {
        r.user_id: {c.name: (r[f"{c.name}_count"], r[f"{c.name}_sum"]) for c in CELLS}
        for r in result.collect()
    }
    assert got == naive_matrix(data)
    assert "Expand" not in plan_of(result)


def test_conditional_counts_and_sums(spark, plan_of):
    df = spark.createDataFrame(
        [("u", "a", 1), ("u", "a", 2), ("u", "b", 1), ("u", None, 1), ("v", "c", 3)],
        "k string, a string, x int",
    )
    counted = count_distinct_if(df, "k", "a", {"one": F.col("x") == 1, "two": F.col("x") == 2})
    assert rows(counted) == Counter([("u", 2, 1), ("v", 0, 0)])
    assert "Expand" not in plan_of(counted)
    sums = df.groupBy("k").agg(
        sum_or_null(F.col("x") == 1, F.col("x")), sum_or_zero(F.col("x") == 1, F.col("x"))
    )
    assert rows(sums) == Counter([("u", 3, 3), ("v", None, 0)])
    total = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert [r[0] for r in total.select(null_safe_total(["a", "b"])).collect()] == [1, 0]


def test_median(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (1, 2.0), (1, float("nan")), (1, None), (2, None)], "b int, x double"
    )
    assert rows(median_by(df, "b", ["x"])) == Counter([(1, 1.5), (2, None)])


# ---- row choice and numbering


def test_keep_first_breaks_ties_and_limits_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame(
        [("u", 2, "b"), ("u", 2, "a"), ("u", 3, "c"), ("v", None, "d"), ("v", 1, "e")],
        "k string, t int, a string",
    )
    first = keep_first(df, "k", [F.asc_nulls_first("t"), F.asc_nulls_first("a")])
    assert rows(first) == Counter([("u", 2, "a"), ("v", None, "d")])
    assert plan_of(first).count("WindowGroupLimit") == 2


def test_row_numbers_have_no_gaps_and_repeat(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(None).alias("n"))
    first = number_rows(df, ["k", "n"])
    assert sorted(r.row_number for r in first.collect()) == list(range(1, 5001))
    again = number_rows(df.repartition(13), ["k", "n"])
    assert rows(first) == rows(again)
    ids = first.select(row_id("20230306", F.col("row_number")).alias("id"))
    assert ids.agg(F.min("id"), F.max("id")).first()[:] == (
        "2023030602000000001", "2023030602000005000",
    )
    assert ids.select(sequence_of(F.col("id")).alias("s")).agg(F.sum("s")).first()[0] == 12502500


def test_row_numbers_never_pass_whole_through_one_task(spark, plan_of):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.rand(1).alias("payload"))
    plan = plan_of(number_rows(df, ["k"]))
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1  # the bucket sizes
    below = plan[plan.index(single[0]):].splitlines()[1]
    assert "HashAggregate" in below and "payload" not in below


def test_row_id_refuses_a_tenth_digit(spark):
    df = spark.createDataFrame([(10**9,)], "n long")
    with pytest.raises(Exception, match="9 digits"):
        df.select(row_id("20230306", F.col("n"))).collect()


def test_batches(spark):
    df = spark.range(1, 1051).select(batch_of(F.col("id"), 500).alias("b"))
    assert rows(df.groupBy("b").count()) == Counter([(1, 500), (2, 500), (3, 50)])
    names = df.select(batch_name(F.col("b"), 5001, 500).alias("n")).distinct()
    assert rows(names) == Counter([("01",), ("02",), ("03",)])


# ---- imputation, labels, scores


def test_impute_over_all_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, float("nan"))], "i int, x double")
    assert rows(impute_median(df, ["x"], None)) == Counter([(1, 5.0), (2, 6.0), (3, 7.0), (4, 6.0)])


def test_impute_per_batch(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, None), (3, 1, 7.0), (4, 2, None), (5, 3, 2.0), (6, 3, float("nan"))],
        "i int, b int, x double",
    )
    for batches in (None, 3, 10**9):
        assert rows(impute_median(df, ["x"], "b", batches)) == Counter(
            [(1, 1, 5.0), (2, 1, 6.0), (3, 1, 7.0), (4, 2, None), (5, 3, 2.0), (6, 3, 2.0)]
        )


def test_labels(spark):
    df = spark.createDataFrame([("b",), ("C",), ("a",), (None,), ("a",)], "x string")
    fitted = fit_labels(df, "x")
    assert rows(fitted) == Counter([("x", "C", 0), ("x", "a", 1), ("x", "b", 2)])
    assert rows(label_table(spark, {"x": ["C", "a", "b"]})) == rows(fitted)
    new = spark.createDataFrame([("a", "b"), ("z", "a"), (None, "C")], "x string, y string")
    for unseen, codes in (("null", [1, None, None]), ("keep", [1, 3, 3])):
        assert rows(apply_labels(new.select("x"), fitted, "x", unseen)) == Counter([(c,) for c in codes])
        both = fitted.union(fitted.withColumn("feature", F.lit("y")))
        want = Counter(zip(codes, [2, 1, 0], strict=True))
        assert rows(encode_labels(new, both, ["x", "y"], unseen)) == want
    for encode in (encode_labels(new.dropna(), fitted, ["x"]), apply_labels(new.dropna(), fitted, "x")):
        with pytest.raises(Exception, match="label not seen when fitted: z"):
            encode.collect()


def random_model(trees=40, depth=5, features=("f0", "f1", "f2"), seed=11):
    draw = random.Random(seed)
    nodes = []

    def grow(tree, at, left):
        if left == 0 or draw.random() < 0.1:
            nodes.append(Node(tree, at, None, None, None, None, None, draw.uniform(-1, 1)))
            return
        yes, no = 2 * at + 1, 2 * at + 2
        nodes.append(
            Node(tree, at, draw.choice(features), draw.uniform(0, 1), yes, no,
                 draw.choice([yes, no]), None)
        )
        grow(tree, yes, left - 1)
        grow(tree, no, left - 1)

    for tree in range(trees):
        grow(tree, 0, depth)
    return TreeModel(tuple(nodes), base_score=0.3)


@pytest.mark.parametrize("single", [False, True])
def test_expression_and_batches_agree(spark, single):
    """Missing numbers of both kinds, infinities, values at a threshold and near it."""
    features = ("f0", "f1", "f2")
    model = replace(random_model(trees=6), single=single)
    cuts = sorted({n.threshold for n in model.nodes if n.feature})
    odd = [None, float("nan"), float("inf"), float("-inf"), *cuts, *[c * (1 + 1e-9) for c in cuts]]
    draw = random.Random(3)
    data = [(2**53 + 1 if i else None, *[draw.choice(odd) for _ in features]) for i in range(500)]
    df = spark.createDataFrame(data, "id long, f0 double, f1 double, f2 double")
    scored = score_in_batches(
        df.withColumn("native", score_expression(model)),
        tree_predictor(model, features), features, "batched",
    ).collect()
    assert len(scored) == 500
    np.testing.assert_allclose([r.native for r in scored], [r.batched for r in scored], rtol=1e-12)
    # A 64-bit id beside a NULL keeps its last bit.
    assert Counter(r.id for r in scored) == Counter({2**53 + 1: 499, None: 1})


def test_large_models_are_scored_in_batches(spark, plan_of):
    features = ("f0", "f1", "f2")
    df = spark.range(10).select(*[F.rand(i).alias(f) for i, f in enumerate(features)])
    small, large = random_model(trees=2), random_model(trees=150)
    assert "ArrowEvalPython" not in plan_of(score(df, small, features, "p"))
    assert "ArrowEvalPython" in plan_of(score(df, large, features, "p"))
    kinds = {"feature": "string", "threshold": "double", "leaf": "double"}
    schema = ", ".join(f"{c} {kinds.get(c, 'int')}" for c in Node.__dataclass_fields__)
    table = spark.createDataFrame([tuple(vars(n).values()) for n in large.nodes], schema)
    assert sorted(TreeModel.from_table(table, 0.3).nodes, key=repr) == sorted(large.nodes, key=repr)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.0187,), (0.01870001,), (0.0,)], "p double")
    assert [r[0] for r in df.select(treat_flag(F.col("p"), 0.0187)).collect()] == [0, 1, 0]


# ---- partitions


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    name = f"mart.t{random.randrange(10**12)}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partition_lookup_sorts_as_text(spark, table):
    df = spark.createDataFrame(
        [(1, "20230306", "2"), (2, "20230306", "10"), (3, "20230305", "9"), (4, None, "1")],
        "x int, ds string, batch string",
    )
    df.write.partitionBy("ds", "batch").saveAsTable(table)
    found = snapshots.list_partitions(spark, table)
    assert found[0] == {"ds": "20230306", "batch": "2"}
    assert snapshots.latest_partition(spark, table) == found[0]
    assert len(found) == 3


def test_tables_without_partitions(spark, table):
    spark.range(3).write.saveAsTable(table)
    assert snapshots.list_partitions(spark, table) is None
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.latest_partition(spark, table)


def test_nearest_snapshot(spark):
    df = spark.createDataFrame([("20230301",), ("20230225",)], "ds string")
    assert snapshots.nearest_snapshot(df, "20230304") == "20230301"
    assert snapshots.nearest_snapshot(df, "20230228") == "20230225"
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.nearest_snapshot(df, "20230224")
    assert snapshots.nearest_snapshot(df, "20250601") == "20230301"
    assert rows(snapshots.newest_rows(df)) == Counter([("20230301",)])
    assert rows(snapshots.newest_rows(df, "20230228")) == Counter([("20230225",)])
    assert rows(snapshots.newest_rows(df, "20230101")) == Counter()


def test_nearest_partition_skips_empty_ones(spark, table):
    df = spark.createDataFrame([(1, "20230301"), (2, "20230225")], "x int, ds string")
    df.write.partitionBy("ds").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (ds='20230303')")
    assert snapshots.nearest_partition(spark, table, "20230304") == "20230301"
    assert snapshots.nearest_partition(spark, table, "20230228") == "20230225"
    assert snapshots.nearest_partition(spark, table, "20250601") == "20230301"
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.nearest_partition(spark, table, "20230224")


def test_nearest_partition_past_many_empty_ones(spark, table):
    df = spark.createDataFrame([(1, "a000"), (2, "a001")], "x int, ds string")
    df.write.partitionBy("ds").saveAsTable(table)
    empty = " ".join(f"PARTITION (ds='b{i:03d}')" for i in range(400))
    spark.sql(f"ALTER TABLE {table} ADD {empty}")
    for upto in ("b399", "b150", "b001", "b000", "a001", "a0015"):
        assert snapshots.nearest_partition(spark, table, upto) == "a001"
    assert snapshots.nearest_partition(spark, table, "a0005") == "a000"
    group, tracker = f"nearest-{table}", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "nearest")
    try:
        assert snapshots.nearest_partition(spark, table, "b399") == "a001"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) <= 40


def test_partition_filters_reach_the_scan(spark, table, plan_of):
    spark.createDataFrame(
        [(1, "2023", "01", "31"), (2, "2023", "02", "01"), (3, "2022", "12", "31")],
        "x int, year string, month string, day string",
    ).write.partitionBy("year", "month", "day").saveAsTable(table)
    ranged = snapshots.ledger_range(spark.table(table), "20221231", "20230131")
    assert sorted(r.x for r in ranged.collect()) == [1, 3]
    line = next(x for x in plan_of(ranged).splitlines() if "PartitionFilters" in x)
    assert "concat(year" in line and "PartitionFilters: []" not in line


# ---- writing


def test_writing_twice_replaces_the_snapshot(spark, table):
    def write(values, ds, **options):
        df = spark.createDataFrame([(v,) for v in values], "x int")
        return sinks.write_snapshot(df, table, ds, MODIFIED, **options)

    def content():
        return rows(spark.table(table).select("x", "ds"))

    assert write([1, 2], "20230306") and write([3], "20230320")
    assert write([4], "20230306")
    assert content() == Counter([(4, "20230306"), (3, "20230320")])
    # Nothing to write: the guard keeps the old rows, without it the snapshot becomes empty.
    assert not write([], "20230306", skip_if_empty=True)
    assert content() == Counter([(4, "20230306"), (3, "20230320")])
    assert write([], "20230306")
    assert content() == Counter([(3, "20230320")])
    assert spark.table(table).columns == ["x", "modified_date", "ds"]
    sinks.drop_partition(spark, table, ds="20230320")
    assert content() == Counter()


def test_batches_of_a_snapshot(spark, table):
    df = spark.createDataFrame([(i, f"{i % 3:02d}") for i in range(9)], "x int, batch string")
    sinks.write_snapshot(df, table, "20230306", MODIFIED)
    one = spark.createDataFrame([(100,)], "x int")
    sinks.write_snapshot(one, table, "20230306", MODIFIED, batch="01")
    assert rows(spark.table(table).groupBy("ds", "batch").count()) == Counter(
        [("20230306", "00", 3), ("20230306", "01", 1), ("20230306", "02", 3)]
    )
    # Writing the whole snapshot again also removes batches that are no longer there.
    sinks.write_snapshot(df.filter("batch = '00'"), table, "20230306", MODIFIED)
    assert rows(spark.table(table).select("batch").distinct()) == Counter([("00",)])


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20000)
    sample = sinks.sample_rows(df, 0.1, ["id"])
    assert 1700 < sample.count() < 2300
    assert rows(sample) == rows(sinks.sample_rows(df.repartition(5), 0.1, ["id"]))
    assert sinks.sample_rows(df, 1.0, ["id"]).count() == 20000


def test_file_count(spark):
    df = spark.createDataFrame([(0,), (128 * 2**20,), (1000 * 2**20,)], "b long")
    assert [r[0] for r in df.select(sinks.file_count(F.col("b"))).collect()] == [1, 1, 7]


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert rows(staged) == rows(spark.range(5))
    folder = scratch_dir(spark).removeprefix("file:")
    assert all(folder in name for name in staged.inputFiles())


def test_sorted_output(spark):
    df = sinks.sorted_output(spark.range(1000).select(F.expr("999 - id").alias("id")), "id")
    assert [r.id for r in df.collect()] == list(range(1000))


# ---- writing


def test_columns_that_differ_are_an_error(spark, table):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    write_snapshot(df, table, "20230306", datetime(2023, 3, 6))
    for other in (df.drop("y"), df.withColumn("z", F.lit(1))):
        with pytest.raises(ValueError, match="differ in the columns"):
            write_snapshot(other, table, "20230306", datetime(2023, 3, 6))
    assert spark.table(table).count() == 1


@pytest.mark.parametrize("rebalance", [True, False])
def test_a_failed_write_keeps_the_old_snapshot(spark, table, rebalance):
    old = spark.createDataFrame([(1,), (2,), (3,)], "x long")
    write_snapshot(old, table, "20230306", datetime(2023, 3, 6))
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("x")
    )
    with pytest.raises(Exception, match="broken"):
        write_snapshot(broken, table, "20230306", datetime(2023, 3, 6), rebalance=rebalance)
    assert sorted(r.x for r in spark.table(table).collect()) == [1, 2, 3]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_stale_batches_go_in_either_mode(spark, table, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for names in (["01", "02"], ["02", "03"]):
            df = spark.createDataFrame([(1, n) for n in names], "x int, batch string")
            write_snapshot(df, table, "20230306", datetime(2023, 3, 6))
        write_snapshot(df, table, "20230320", datetime(2023, 3, 20))
        found = rows(spark.table(table).select("ds", "batch"))
        assert found == Counter((ds, b) for ds in ("20230306", "20230320") for b in ("02", "03"))
        write_snapshot(df.drop("batch").limit(1), table, "20230306", datetime(2023, 3, 6), batch="02")
        assert rows(spark.table(table).select("ds", "batch")) == found
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_an_empty_result_empties_the_snapshot(spark, table):
    df = spark.createDataFrame([(1,)], "x int")
    for ds in ("20230306", "o'clock"):
        write_snapshot(df, table, ds, datetime(2023, 3, 6))
    write_snapshot(df.limit(0), table, "o'clock", datetime(2023, 3, 6))
    assert [r.ds for r in spark.table(table).collect()] == ["20230306"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_scope_deletes_what_was_staged_in_it(spark):
    outside = stage(spark.range(3), "outside")
    with scratch_scope(spark):
        inside = stage(spark.range(3), "inside")
        folder = inside.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder) and inside.count() == 3
    assert not os.path.exists(folder) and outside.count() == 3
