"""The jobs on hand-made rows, and all of them together on catalog tables."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from featuremart.operators.scoring import fitted_labels, label_table
from featuremart.operators.scratch import stage
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.snapshots import NoSnapshot
from featuremart.plans.card_master import card_master
from featuremart.plans.customer_pool import customer_pool
from featuremart.plans.dataset import assemble_features, inference_dataset
from featuremart.plans.demographic import demographic_features, first_accounts
from featuremart.plans.income import income_features
from featuremart.plans.portfolio import portfolio_features
from featuremart.plans.ratios import ratio_features
from featuremart.plans.scores import NUMERIC, model_inputs, model_scores
from featuremart.runner import JOBS, run_job
from featuremart.sources.bank_model import CARD_MODEL, CLASS_LABELS
from featuremart.sources.bank_views import RUN_DATE
from featuremart.sources.catalog import INPUT_TABLES, MART_TABLES

DAY = datetime


def rows(df):
    return Counter(map(tuple, df.collect()))


SAVING = (
    "user_id string, acct_num string, type string, status int, open_date timestamp_ntz, "
    "branch string, credit_balance double, deposit_balance double, curr_type string, "
    "keterangan string"
)


def saving_of(spark, *accounts):
    """Accounts from (user, account[, overrides])."""
    base = {
        "type": "XA", "status": 1, "open_date": DAY(2000, 1, 1), "branch": "1",
        "credit_balance": 10.0, "deposit_balance": 100.0, "curr_type": "idr",
        "keterangan": " Giro",
    }
    data = []
    for user, account, *rest in accounts:
        row = {"user_id": user, "acct_num": account, **base, **(rest[0] if rest else {})}
        data.append(tuple(row[c.split()[0]] for c in SAVING.split(", ")))
    return spark.createDataFrame(data, SAVING)


def pool_of(spark, *users, **overrides):
    base = {
        "usia": 30, "pendidikan": "SMA", "jenis_pekerjaan": "ASN",
        "penghasilan_per_bulan": "S/D 5 JUTA", "open_date_saving": DAY(2000, 1, 1),
        "is_credit_card": 0, "is_inactive": 0, **overrides,
    }
    schema = (
        "user_id string, usia int, pendidikan string, jenis_pekerjaan string, "
        "penghasilan_per_bulan string, open_date_saving timestamp_ntz, is_credit_card int, "
        "is_inactive int"
    )
    return spark.createDataFrame([(u, *base.values()) for u in users], schema)


LEDGER = (
    "tr_acc string, tr_type string, amt double, trremk string, trancd string, year string, "
    "month string, day string"
)


def test_card_listed_often_and_two_crm_rows(spark):
    cards = spark.createDataFrame(
        [
            (" C1", "4001", DAY(2000, 5, 1)), ("C1 ", "4001", DAY(2000, 3, 1)),
            ("C1", "4002", DAY(2001, 6, 19, 18)), ("C2", "4003", DAY(2000, 1, 1)),
            ("C9", "4009", DAY(2000, 1, 1)), (None, "4000", DAY(2000, 1, 1)),
            ("C3", "4004", DAY(2000, 1, 1)),
        ],
        "cust_number string, card_number string, open_date timestamp_ntz",
    )
    holders = spark.createDataFrame(
        [("C1", "id1 "), ("C1", "id1"), ("C2", "id2"), ("C3", "NaN"), (" C9", "id9")],
        "acc_number string, id_number string",
    )
    persons = spark.createDataFrame(
        [("00000011", "id1"), ("00000012", "id1"), ("0000002", "id2"), ("x", None)],
        "user_id string, plain string",
    ).select("user_id", F.md5("plain").alias("id_number"))
    crm = spark.createDataFrame(
        [("R1", "C1", "9"), ("R2", "C1 ", "8"), ("R3", "C2", "7"), (" ", "C9", "6")],
        "user_id string, cust_nmbr string, cc_nmbr string",
    )
    got = card_master(cards, holders, persons, crm, "2001-06-20")
    # 4001: first day, shifted by seven hours, once per CRM row, as the own id is not of the
    # usual length. 4002 opens on the cutoff day by local time. C2 keeps its own id.
    first = DAY(2000, 3, 1, 7)
    assert rows(got) == Counter(
        [("R1", "4001", first), ("R2", "4001", first), ("0000002", "4003", DAY(2000, 1, 1, 7))]
    )


def test_pool_attributes_and_labels(spark):
    saving = saving_of(
        spark,
        (" u1 ", "0001", {"open_date": DAY(2001, 1, 1), "status": 3}),
        ("u1", "0002", {"open_date": DAY(2000, 1, 1), "type": "ZZ", "status": 2}),
        ("u2", "0003"),
        ("u3", "0401"),  # excluded suffix
        ("u4", "0004", {"open_date": DAY(2001, 6, 15)}),  # too late
        ("u5", "0005", {"status": 2}),  # closed
        (None, "0006", {"status": 3}),
    )
    persons = spark.createDataFrame(
        [
            ("u1 ", "h1", date(2000, 2, 29), "L", 4, "x", 1, "y", "DIATAS 100 JUTA"),
            ("u2", "h2", None, "P", 99, "x", 9, "y", None),
        ],
        "user_id string, id_number string, tanggal_lahir date, jenis_kelamin string, "
        "kode_jenis_pekerjaan int, jenis_pekerjaan string, kode_pendidikan int, "
        "pendidikan string, penghasilan_per_bulan string",
    )
    backup = spark.createDataFrame(
        [("u1", "5 - 10 JUTA"), ("u2", "10 - 50 JUTA"), ("u2", "10 - 50 JUTA")],
        "user_id string, penghasilan_per_bulan string",
    )
    cards = spark.createDataFrame(
        [("u2", DAY(2000, 1, 1)), ("u2", DAY(2000, 2, 1)), ("u1", DAY(2001, 6, 15)), ("u1", None)],
        "user_id string, open_date_cc timestamp_ntz",
    )
    got = customer_pool(saving, persons, backup, cards, "2001-06-15", "20010615")
    assert rows(got) == Counter([
        ("u1", "2000-02-29", 1, "L", "SD/SMP", "ASN", "DIATAS 50 JUTA", DAY(2001, 1, 1),
         "2001-06-15", 0, 1),
        ("u2", None, None, "P", "UNDEFINED", "UNDEFINED", "10 - 50 JUTA", DAY(2000, 1, 1),
         "2001-06-15", 1, 0),
        (None, None, None, None, "UNDEFINED", "UNDEFINED", "S/D 5 JUTA", DAY(2000, 1, 1),
         "2001-06-15", 0, 0),
    ])


def test_first_account_ties(spark):
    saving = saving_of(
        spark,
        ("u1", "0002", {"branch": "B"}), (" u1", "0001", {"branch": "A"}),
        ("u2", "0003", {"open_date": None}), ("u2", "0004"),
        ("u3", "0005", {"branch": " "}), ("u3", "0006", {"branch": "C"}),
    )
    got = first_accounts(saving, "2001-06-15").select("user_id", "acct_num", "branch")
    # An account without a day comes first, and then fails the cutoff.
    assert rows(got) == Counter([("u1", "0001", "A"), ("u3", "0006", "C")])


def test_demographic_features(spark):
    branch = spark.createDataFrame(
        [("A", "Bandung "), ("A", "Bandung"), ("B", "KANINS"), ("C", None)],
        "branch string, rgdesc string",
    )
    loan = spark.createDataFrame(
        [("u1 ", 1, "K1"), ("u1", 1, "K2"), ("u2", 0, "K1"), ("u3", 1, "AA")],
        "user_id string, status int, type string",
    )
    saving = saving_of(
        spark, ("u1", "1", {"branch": "A"}), ("u2", "2", {"branch": "B"}),
        ("u3", "3", {"branch": "C"}), ("u4", "4", {"branch": "A", "open_date": DAY(2000, 1, 2)}),
    )
    pool = pool_of(spark, "u1", "u2", "u3", "u4")
    got = demographic_features(pool, saving, branch, loan, "2001-06-15").select(
        "user_id", "demog_id_rgdesc_na_na", "demog_is_pinjaman_aktif_na_na"
    )
    # u4 opened the account on another day than the pool says.
    assert rows(got) == Counter(
        [("u1", "JABAR", 1), ("u2", None, 0), ("u3", None, 0), ("u4", None, 0)]
    )
    named = demographic_features(
        pool, saving, branch.replace("KANINS", "Medan"), loan, "2001-06-15", ["Medan   "]
    )
    assert named.filter(F.col("demog_id_rgdesc_na_na") == "DKI").count() == 0


def test_portfolio_features(spark):
    saving = saving_of(
        spark, ("u1", "0001"), ("u1", "0001", {"curr_type": "usd"}), ("u1 ", "0002"),
        ("u1", None), ("u1", "0401", {"keterangan": "deposito"}), ("u2", "3", {"status": 3}),
        ("u3", "4", {"branch": None}),
    )
    got = portfolio_features(pool_of(spark, "u1", "u2", "u3"), saving)
    # An account in two currencies counts in both; one without number is flagged a deposit.
    assert rows(got) == Counter([("u1", 3, 30.0), ("u2", 0, 0.0), ("u3", None, None)])


def test_income_features(spark):
    ledger = spark.createDataFrame(
        [
            ("001", "C ", 1.1, "salary", "100", "2001", "06", "15"),
            ("1", "C", 2.2, "x", "428", "2000", "12", "17"),
            ("001", "C", 4.0, "salary", "100", "2000", "12", "16"),
            ("001", "D", 8.0, "salary", "100", "2001", "06", "15"),
            ("bad", "C", 16.0, "salary", "100", "2001", "06", "15"),
            (None, "C", 32.0, "salary", "100", "2001", "06", "15"),
            ("123456789012345", "C", 64.0, "salary", "1", "2001", "01", "01"),
        ],
        LEDGER,
    )
    saving = saving_of(
        spark, ("u1", "0001"), ("u1", "bad"), ("u2", "1"), ("u3", "123456789012345"), ("u4", None)
    )
    got = income_features(
        pool_of(spark, "u1", "u2", "u3", "u4"), saving, ledger, "20001217", "20010615"
    )
    assert rows(got) == Counter([("u1", 3.3), ("u2", 3.3), ("u3", 64.0), ("u4", 0.0)])


def test_ratio_features(spark):
    ledger = spark.createDataFrame(
        [
            ("0001", "C", 4.0, None, None, "2001", "06", "01"),
            ("0001", "D ", 11.0, None, None, "2001", "06", "01"),
            ("0001", "C", 99.0, None, None, "2001", "05", "15"),
            ("0002", "C", 5.0, None, None, "2001", "06", "01"),
        ],
        LEDGER,
    )
    saving = saving_of(
        spark, ("u1", "0001"), ("u1", "0401", {"keterangan": "DEPOSITO"}), ("u2", "0002"),
        ("u3", "0003"),
    )
    got = ratio_features(
        pool_of(spark, "u1", "u2", "u3", "u4"), saving, ledger, "20010516", "20010615"
    )
    assert rows(got) == Counter(
        [("u1", 2.5, 10.0), ("u2", 2.0, None), ("u3", None, None), ("u4", None, None)]
    )


@pytest.fixture(scope="module")
def marts(bank):
    return bank.marts


def test_dataset_is_whole_and_repeatable(bank, marts):
    pool = bank.staged_pool
    dataset = bank.staged_dataset
    expected = pool.filter("is_credit_card = 0 AND is_inactive = 0").select("user_id").distinct()
    assert rows(dataset.select("user_id")) == rows(expected)
    n = dataset.count()
    ids = sorted(int(r.id[-9:]) for r in dataset.select("id").collect())
    assert ids == list(range(1, n + 1))
    again = inference_dataset(*[mart.repartition(3) for mart in marts], "20010620")
    assert rows(again) == rows(dataset)
    amounts = [c for c in dataset.columns if c.startswith(("saving", "ddhist", "transaction"))]
    assert dataset.filter(" OR ".join(f"{c} IS NULL" for c in amounts)).count() == 0


def test_user_listed_twice_is_not_multiplied(bank, marts):
    doubled = [mart.union(mart) for mart in marts]
    assert rows(assemble_features(*doubled)) == rows(assemble_features(*marts))


def test_user_with_differing_rows_keeps_them(spark, bank, marts):
    """Two rows of a mart stay two rows; none is made up of their maxima."""
    pool, demographic, portfolio, income, ratios = marts
    user = bank.staged_dataset.select("user_id").first().user_id
    amounts = [(1, 900.0), (7, 10.0)]
    two = spark.createDataFrame(
        [(user, *a) for a in amounts],
        "user_id string, saving_casa_aktif_count_na bigint, saving_casa_aktif_sum_na double",
    ).select(*[F.col(n).cast(t) for n, t in portfolio.dtypes])
    changed = stage(portfolio.filter(F.col("user_id") != user).union(two), "two")
    got = assemble_features(pool, demographic, changed, income, ratios).filter(F.col("user_id") == user)
    names = [c for c in got.columns if c.startswith("saving")]
    assert {tuple(map(float, r)) for r in got.select(*names).collect()} == {(1.0, 900.0), (7.0, 10.0)}
    dataset = inference_dataset(pool, demographic, changed, income, ratios, "20010620")
    ids = sorted(int(r.id[-9:]) for r in dataset.select("id").collect())
    assert ids == list(range(1, bank.staged_dataset.count() + got.count()))


def test_dataset_files_are_sorted_ranges(bank, spark):
    spread = bank.dataset.select("id", F.spark_partition_id().alias("p")).collect()
    parts = {}
    for row in spread:
        parts.setdefault(row.p, []).append(row.id)
    assert all(ids == sorted(ids) for ids in parts.values())


def test_scores(spark, bank):
    dataset, labels = bank.staged_dataset, label_table(spark, CLASS_LABELS)
    inputs = model_inputs(dataset, labels, batch_size=10)
    assert inputs.filter(" OR ".join(f"{c} IS NULL" for c in NUMERIC)).count() == 0
    assert inputs.count() == dataset.dropna(subset=["demog_id_rgdesc_na_na"]).count()
    scores = model_scores(dataset, CARD_MODEL, labels, batch_size=10)
    assert scores.columns == ["id", "user_id", "pred_proba", "is_treat", "batch"]
    total = -(-dataset.count() // 10)
    names = {r.batch for r in scores.select("batch").distinct().collect()}
    assert names <= {f"{i:0{len(str(total))}d}" for i in range(1, total + 1)}
    low = label_table(spark, {**CLASS_LABELS, "demog_id_rgdesc_na_na": ["BALI"]})
    with pytest.raises(Exception, match="label not seen when fitted"):
        model_scores(dataset, CARD_MODEL, low, batch_size=10).collect()
    # Two versions in one table: the newer one, or the one that is named.
    both = low.withColumn("version", F.lit("2001-05")).union(labels.withColumn("version", F.lit("2001-06")))
    assert rows(fitted_labels(both)) == rows(labels) == rows(fitted_labels(labels))
    assert rows(fitted_labels(both, "2001-05")) == rows(low)
    assert rows(model_scores(dataset, CARD_MODEL, fitted_labels(both), batch_size=10)) == rows(scores)
    with pytest.raises(ValueError, match="no versions"):
        fitted_labels(labels, "2001-05")


def test_all_jobs_on_catalog_tables(spark, bank):
    for database in ("datalake", "datamart"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for role, table in INPUT_TABLES.items():
        view = bank.view(f"v_{role}")
        if role == "trx":
            recent = view.filter("concat(year, month) >= '200012'").repartition("year", "month")
            recent.write.partitionBy("year", "month", "day").saveAsTable(table)
        elif "ds" in view.columns:
            view.coalesce(1).write.partitionBy("ds").saveAsTable(table)
        else:
            view.write.saveAsTable(table)
    with pytest.raises(NoSnapshot):
        run_job(spark, "dataset", RUN_DATE)
    assert not run_job(spark, "pool", date(2001, 6, 21))
    for job in JOBS:
        assert run_job(spark, job, RUN_DATE)
    expected = {
        "card_master": bank.card_master, "dataset": bank.staged_dataset,
        **dict(
            zip(("pool", "demographic", "portfolio", "income", "ratios"), bank.marts, strict=True)
        ),
    }
    for job, df in expected.items():
        written = spark.table(MART_TABLES[job])
        assert rows(written.select(df.columns)) == rows(df), job
        assert written.columns[-2:] == ["modified_date", "ds"]
    for _ in range(2):
        run_job(spark, "scores", RUN_DATE, model=CARD_MODEL, labels=label_table(spark, CLASS_LABELS), batch_size=50)
    scores = model_scores(bank.staged_dataset, CARD_MODEL, label_table(spark, CLASS_LABELS), batch_size=50)
    assert rows(spark.table(MART_TABLES["scores"]).select(scores.columns)) == rows(scores)
    with pytest.raises(ValueError, match="labels"):
        run_job(spark, "scores", RUN_DATE, model=CARD_MODEL)
    # A later snapshot of a mart does not change what a repeated run reads.
    for role in ("pool", "card_master"):
        later = spark.table(MART_TABLES[role]).limit(1).drop("ds", "modified_date")
        write_snapshot(stage(later, role), MART_TABLES[role], "20010706", datetime(2001, 7, 6))
    for job in ("pool", "portfolio", "dataset"):
        assert run_job(spark, job, RUN_DATE)
        written = spark.table(MART_TABLES[job]).filter("ds = '20010620'")
        assert rows(written.select(expected[job].columns)) == rows(expected[job]), job
    partitions = spark.sql(f"SHOW PARTITIONS {MART_TABLES['scores']}").collect()
    assert partitions[0].partition == "ds=20010620/batch=1"
