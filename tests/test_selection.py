"""Medians of whole columns equal Spark's own, whatever the values, and no task holds them all."""

import math
import random

import pytest
from pyspark.sql import functions as F

from featuremart.operators import selection
from featuremart.operators.selection import exact_medians, magnitude_interval

INF, NAN = math.inf, math.nan
RNG = random.Random(11)
COLUMNS = {
    "odd": [3.0, 1.0, 2.0],
    "even": [4.0, 1.0, 3.0, 2.0],
    "ties": [5.0] * 400 + [7.0] * 3,
    "two_values": [1.0, 2.0] * 50,
    "nulls": [None, NAN, None, 8.0, NAN, 10.0],
    "nothing": [None, NAN, None],
    "infinite": [INF, -INF, INF, 1.0],
    "signs": [-0.0, 0.0, -1e-300, 1e-300, 5e-324, -5e-324],
    "least": [i * 5e-324 for i in range(100, 140)],
    "wide": [s * 10.0**e for e in range(-300, 309, 7) for s in (1, -1)],
    "greatest": [1.7976931348623157e308, -1.7976931348623157e308, 1.7e308, -1.6e308],
    "close": [1.0 + i * 2.0**-52 for i in range(101)],
    "normal": [RNG.gauss(0, 1) for _ in range(1001)],
    "skewed": [RNG.lognormvariate(0, 9) for _ in range(1000)],
}


def table(spark, columns):
    rows = [(n, v) for n, values in columns.items() for v in values]
    RNG.shuffle(rows)
    frame = spark.createDataFrame([(i, n, v) for i, (n, v) in enumerate(rows)], "i long, name string, v double")
    return frame.repartition(7).select(*[F.when(F.col("name") == n, F.col("v")).alias(n) for n in columns])


def test_equal_to_spark(spark):
    df = table(spark, COLUMNS)
    numbers = [F.median(F.when(~F.isnan(c), F.col(c))).alias(c) for c in COLUMNS]
    want = df.agg(*numbers).first().asDict()
    got = exact_medians(df, list(COLUMNS))
    assert list(got) == list(COLUMNS)
    for name, value in want.items():
        assert got[name] == value or (math.isnan(value) and math.isnan(got[name])), name
    assert got["nothing"] is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": None}


def test_other_types_and_odd_names(spark):
    df = spark.sql("SELECT id AS `a.b`, CAST(id AS DECIMAL(9, 2)) / 4 AS c FROM range(9)")
    assert exact_medians(df, ["a.b", "c"]) == {"a.b": 4.0, "c": 1.0}


def test_intervals_keep_the_order(spark):
    values = sorted({v for c in COLUMNS.values() for v in c if v is not None and not math.isnan(v)})
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", magnitude_interval(F.col("v")).alias("at"))
    places = [r["at"] for r in sorted(df.collect(), key=lambda r: r.v)]
    assert places == sorted(places)


@pytest.mark.parametrize("cuts", [2, 64])
def test_no_task_holds_all_values(spark, monkeypatch, cuts, plan_of):
    """Each pass sends one row per interval and task, and the window sees intervals only."""
    monkeypatch.setattr(selection, "CUTS", cuts)
    plans, largest = [], []
    intervals = selection._intervals

    def watched(values):
        out = intervals(values)
        plans.append(plan_of(out))
        largest.append(out.groupBy("name").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(selection, "_intervals", watched)
    df = spark.range(200_000).select((F.col("id") * 37 % 200_003).cast("double").alias("v"))
    assert exact_medians(df, ["v"])["v"] == df.agg(F.median("v")).first()[0]
    assert all(p.count("HashAggregate") == 2 and "ObjectHash" not in p for p in plans)
    assert max(largest) <= max(18 * selection.PER_OCTAVE + 2, cuts + 1)
