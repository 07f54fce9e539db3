"""The jobs, each over the marts it reads."""

from pyspark.sql import functions as F

from featuremart.operators.buckets import Buckets
from featuremart.operators.scoring import label_table
from featuremart.operators.snapshots import snapshot
from featuremart.oracles.parts import tree_case
from featuremart.plans.dataset import inference_dataset
from featuremart.plans.scores import CATEGORICAL, NUMERIC, model_scores
from featuremart.queries.registry import query, rounded, stamped
from featuremart.queries.sinks import ScratchTable
from featuremart.sources.bank_model import CARD_MODEL, CLASS_LABELS, ENSEMBLE
from featuremart.sources.bank_views import PARAMS


@query("""
    SELECT user_id, acctno_cc, strftime(open_date_cc, '%Y-%m-%d %H:%M:%S') AS open_date_cc
    FROM card_master
""")
def job_card_master(bank):
    return bank.card_master.select("user_id", "acctno_cc", stamped("open_date_cc"))


@query("""
    SELECT user_id, tanggal_lahir, usia, jenis_kelamin, pendidikan, jenis_pekerjaan,
           penghasilan_per_bulan,
           strftime(open_date_saving, '%Y-%m-%d %H:%M:%S') AS open_date_saving, event_date,
           is_credit_card, is_inactive
    FROM pool
""")
def job_customer_pool(bank):
    return bank.pool.withColumn("open_date_saving", stamped("open_date_saving"))


@query("SELECT * FROM demographic")
def job_demographic(bank):
    return bank.demographic_of(bank.pool)


@query("SELECT * FROM portfolio")
def job_portfolio(bank):
    return bank.portfolio_of(bank.pool)


@query("SELECT * FROM income")
def job_income(bank):
    return bank.income_of(bank.pool)


@query("SELECT * FROM ratios")
def job_ratios(bank):
    return bank.ratios_of(bank.pool)


@query("SELECT * FROM dataset")
def job_dataset(bank):
    return bank.dataset


@query("SELECT * FROM dataset")
def job_dataset_bucketed(bank):
    """The dataset over marts that were written bucketed by the user: nothing moves before the numbering."""
    buckets = Buckets("user_id", int(bank.spark.conf.get("spark.sql.shuffle.partitions")))
    marts = []
    for i, mart in enumerate(bank.marts):
        table = ScratchTable(bank, f"mart_{i}")
        table.write(mart, PARAMS.ds, buckets=buckets)
        marts.append(snapshot(table.read(), PARAMS.ds))
    return inference_dataset(*marts, PARAMS.ds, clean_ids=True)


def _codes(column: str) -> str:
    arms = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(CLASS_LABELS[column]))
    return f"CASE b.{column} {arms} END AS {column}"


MEDIANS = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in NUMERIC)
FILLED = ", ".join(f"coalesce(CAST(b.{c} AS DOUBLE), m.{c}) AS {c}" for c in NUMERIC)


def scored(model) -> str:
    return f"""
    SELECT id, user_id, round(p, 9) AS pred_proba, CAST(p > 0.0187 AS INTEGER) AS is_treat,
           lpad(CAST(batch AS VARCHAR),
                CAST(length(CAST((SELECT ceil(count(*) / 250.0) FROM dataset) AS INTEGER)
                            ::VARCHAR) AS INTEGER), '0') AS batch
    FROM (SELECT *, {tree_case(model)} AS p
          FROM (SELECT b.id, b.user_id, b.batch, {FILLED},
                       {', '.join(map(_codes, CATEGORICAL))}
                FROM batches b
                LEFT JOIN (SELECT batch, {MEDIANS} FROM batches GROUP BY batch) m
                       ON b.batch = m.batch) f) s
"""


@query(scored(ENSEMBLE))
def job_scores_ensemble(bank):
    """The scores of an ensemble of 160 trees over all features, in Arrow batches."""
    return model_scores(bank.staged_dataset, ENSEMBLE, label_table(bank.spark, CLASS_LABELS), batch_size=250).select(
        "id", "user_id", rounded("pred_proba"), F.col("is_treat"), "batch"
    )


@query(scored(CARD_MODEL))
def job_scores(bank):
    return model_scores(bank.staged_dataset, CARD_MODEL, label_table(bank.spark, CLASS_LABELS), batch_size=250).select(
        "id", "user_id", rounded("pred_proba"), F.col("is_treat"), "batch"
    )
