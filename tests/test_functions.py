from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featuremart.functions import classes
from featuremart.functions.cleansing import (
    as_account_key,
    as_int,
    as_money,
    cleanse_table,
    cleansed,
    digits_of_id,
)
from featuremart.functions.dates import age_years, before, birth_day, local_time
from featuremart.params import RunParams, run_params_columns


def column_of(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    out = df.select("i", expression(F.col("x")).alias("y")).orderBy("i")
    return [row.y for row in out.collect()]


def test_cleansed_text(spark):
    values = [None, "", "  ", "nan", " NaN ", "\t", " a b ", "banana"]
    assert column_of(spark, values, cleansed) == [
        None, None, None, None, None, "\t", "a b", "banana",
    ]


def test_cleanse_table_keeps_partitions_and_types(spark):
    data = [(" x ", 1, " 20010615"), ("nan", 2, "")]
    df = spark.createDataFrame(data, "a string, b int, ds string")
    out = cleanse_table(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.orderBy("b").collect()] == [("x", 1, " 20010615"), (None, 2, "")]


def test_account_suffix_rules(spark):
    values = [None, "7", "12", "0001401", "0000531", "000AB1"]
    assert column_of(spark, values, classes.account_flag) == [
        "DEPO", "DEPO", "NON_DEPO", "DEPO", "NON_DEPO", "DEPO",
    ]
    # A NULL account is a deposit above, yet never passes this test.
    assert column_of(spark, values, classes.suffix_allowed) == [
        None, True, True, False, False, True,
    ]


def test_class_defaults(spark):
    assert column_of(spark, [1, 4, 9, 99, None], classes.occupation_class, "int") == [
        "PEKERJA NON-ASN/BUMN/WIRASWASTA", "ASN", "PENSIUNAN", "UNDEFINED", "UNDEFINED",
    ]
    assert column_of(spark, ["1", " 6", "x", None], classes.education_class) == [
        "SD/SMP", "PENDIDIKAN LANJUT", "UNDEFINED", "UNDEFINED",
    ]
    assert column_of(
        spark, ["50 - 100 JUTA", "5 - 10 JUTA", "other", None], classes.income_class
    ) == ["DIATAS 50 JUTA", "5 - 10 JUTA", "S/D 5 JUTA", "S/D 5 JUTA"]
    assert column_of(spark, ["Medan", "K C K", "medan", None], classes.region_class) == [
        "DKI", "KCK", None, None,
    ]


def test_code_lists():
    assert len(classes.SAVING_PRODUCTS) == len(set(classes.SAVING_PRODUCTS)) == 74
    assert len(classes.LOAN_TYPES) == len(set(classes.LOAN_TYPES)) == 53
    codes = [code for members in classes.OCCUPATION_CLASSES.values() for code in members]
    assert len(codes) == len(set(codes)) == 28


def test_income_entries(spark):
    rows = [
        ("SALARY PT X", "100", True),
        (" gaji bulan ", "100", True),
        ("payroll", None, True),
        ("TRANSFER", "428", True),
        ("TRANSFER", " 541 ", True),
        ("TRANSFER", "100", False),
        ("TRANSFER", None, None),
        ("SHOPEE CREDIT", "100", False),
        ("bukalapak credit", "428", False),
        ("SA Credit GL Debit", "100", False),
        ("SA CREDIT GL DEBIT", "100", True),  # the exact wordings are case-sensitive
        ("Salary crediting KUPON x", "100", False),
        ("SALARY KUPON", "100", True),
        ("  Salary crediting CashBack Brimo ", "100", False),
        (None, "428", None),  # without remark there is no income, whatever the code
        (" nan ", "428", False),
        ("  ", "555", False),
    ]
    data = [(i, *r[:2]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, r string, c string")
    out = df.select("i", classes.income_entry(F.col("r"), F.col("c")).alias("y")).orderBy("i")
    kept = [bool(row.y) for row in out.collect()]
    assert kept == [bool(r[2]) for r in rows]


def test_safe_casts(spark):
    values = ["123456789012345", "12X", None, " 0042 ", "nan", ""]
    assert column_of(spark, values, as_account_key) == [123456789012345, None, None, 42, None, None]
    assert column_of(spark, values, as_int) == [None, None, None, 42, None, None]


def test_money_sums_exactly(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "x double")
    assert str(df.agg(F.sum(as_money(df, "x"))).first()[0]) == "1.00"
    same = df.select(F.col("x").cast("decimal(20,4)").alias("x"))
    assert same.select(as_money(same, "x").alias("x")).dtypes == same.dtypes


def test_digits_of_id(spark):
    values = ["3201-0112 3456.7890", "abc", None, "12345678901234567", "123456789012345"]
    assert column_of(spark, values, digits_of_id) == [
        "3201011234567890", None, None, "12345678901234567", None,
    ]


def python_age(birth: date, day: date) -> int:
    return day.year - birth.year - ((day.month, day.day) < (birth.month, birth.day))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.dates(date(1900, 1, 1), date(2030, 12, 31)), min_size=1, max_size=40),
    st.dates(date(1990, 1, 1), date(2030, 12, 31)),
)
def test_age_follows_the_calendar(spark, births, day):
    text = day.strftime("%Y%m%d")
    got = column_of(spark, births, lambda c: age_years(c, text), "date")
    assert got == [python_age(birth, day) for birth in births]


def test_age_of_leap_day_and_bad_text(spark):
    values = ["2000-02-29", None, "bad", "2001-13-01"]
    for day, age in (("20010228", 0), ("20010301", 1), ("20000229", 0)):
        got = column_of(spark, values, lambda c, d=day: age_years(birth_day(c), d))
        assert got == [age, None, None, None]


def test_local_time_and_cutoff(spark):
    df = spark.sql("SELECT timestamp_ntz '2001-06-14 18:00:00' AS t")
    shifted = df.select(local_time(F.col("t")).alias("t"))
    assert shifted.first().t.isoformat() == "2001-06-15T01:00:00"
    assert df.filter(before(F.col("t"), "2001-06-15")).count() == 1
    assert shifted.filter(before(F.col("t"), "2001-06-15")).count() == 0


def test_run_params():
    p = RunParams(date(2023, 3, 6))
    assert (p.ds, p.data_ds, p.cutoff, p.month) == ("20230306", "20230301", "2023-03-01", "202303")
    assert (p.card_ds, p.card_cutoff) == ("20230304", "2023-03-06")
    assert [p.days_before(n) for n in (30, 90, 180)] == ["20230130", "20221201", "20220902"]
    assert p.is_run_day and not RunParams(date(2023, 3, 7)).is_run_day


def test_run_params_as_columns_agree(spark):
    days = [date(2024, 2, 29), date(2023, 3, 6), date(2023, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for row in df.select("d", *run_params_columns(F.col("d"))).collect():
        p = RunParams(row.d)
        assert (row.ds, row.month, row.data_ds, row.cutoff) == (p.ds, p.month, p.data_ds, p.cutoff)
        assert (row.l30d, row.l90d, row.l180d) == tuple(map(p.days_before, (30, 90, 180)))
        assert bool(row.is_run_day) == p.is_run_day
