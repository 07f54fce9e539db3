"""Imputation, encoding and scoring."""

from pyspark.sql import functions as F

from featuremart.operators import scoring
from featuremart.operators.windows import batch_of
from featuremart.oracles.parts import tree_case
from featuremart.plans.portfolio import portfolio_rollup
from featuremart.queries.registry import query, rounded
from featuremart.sources.bank_model import BALANCE_FEATURES, BALANCE_MODEL

ACCOUNTS = """
    SELECT acct_num, CAST(floor(CAST(acct_num AS BIGINT) / 1000) + 1 AS INTEGER) AS batch,
           CASE WHEN curr_type = 'usd' THEN CAST(NULL AS DOUBLE) ELSE credit_balance END AS balance,
           CASE WHEN branch IS NULL THEN NULL ELSE status END AS status, branch, type
    FROM v_saving
"""


def _accounts(bank):
    return bank.view("v_saving").select(
        "acct_num",
        batch_of(F.col("acct_num").cast("bigint") + 1, 1000).alias("batch"),
        F.when(F.col("curr_type") != "usd", F.col("credit_balance")).alias("balance"),
        F.when(F.col("branch").isNotNull(), F.col("status")).alias("status"),
        "branch",
        "type",
    )


@query(f"SELECT * FROM ({ACCOUNTS}) a WHERE branch IS NOT NULL")
def dropna_subset(bank):
    return _accounts(bank).dropna(subset=["branch"])


@query(f"""
    SELECT a.acct_num, a.batch, coalesce(a.balance, m.balance) AS balance,
           coalesce(CAST(a.status AS DOUBLE), m.status) AS status
    FROM ({ACCOUNTS}) a
    LEFT JOIN (SELECT batch, median(balance) AS balance,
                      median(CAST(status AS DOUBLE)) AS status
               FROM ({ACCOUNTS}) b GROUP BY batch) m ON a.batch = m.batch
""")
def impute_median(bank):
    rows = _accounts(bank).select("acct_num", "batch", "balance", "status")
    return scoring.impute_median(rows, ["balance", "status"], "batch")


@query(f"""
    SELECT a.acct_num, coalesce(a.balance, m.balance) AS balance,
           coalesce(CAST(a.status AS DOUBLE), m.status) AS status
    FROM ({ACCOUNTS}) a
    CROSS JOIN (SELECT median(balance) AS balance, median(CAST(status AS DOUBLE)) AS status
                FROM ({ACCOUNTS}) b) m
""")
def impute_global_median(bank):
    rows = _accounts(bank).select("acct_num", "balance", "status")
    return scoring.impute_median(rows, ["balance", "status"], None)


@query("""
    SELECT 'type' AS feature, type AS label,
           CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT type FROM v_saving) t
    UNION ALL
    SELECT 'priority', o_orderpriority,
           CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER)
    FROM (SELECT DISTINCT o_orderpriority FROM orders) o
""")
def label_encode_fit(bank):
    priority = bank.table("orders").select(F.col("o_orderpriority").alias("priority"))
    return scoring.fit_labels(bank.view("v_saving"), "type").union(
        scoring.fit_labels(priority, "priority")
    )


@query("""
    SELECT s.acct_num, CAST(t.code AS INTEGER) AS type
    FROM v_saving s
    JOIN (SELECT type, dense_rank() OVER (ORDER BY type) - 1 AS code
          FROM (SELECT DISTINCT type FROM v_saving) d) t ON s.type = t.type
""")
def label_encode_apply(bank):
    rows = bank.view("v_saving").select("acct_num", "type")
    return scoring.apply_labels(rows, scoring.fit_labels(rows, "type"), "type")


SCORED = f"""
    SELECT user_id, round({tree_case(BALANCE_MODEL)}, 9) AS pred_proba
    FROM (SELECT user_id, CAST(saving_casa_aktif_count_na AS DOUBLE) AS saving_casa_aktif_count_na,
                 CAST(saving_casa_aktif_sum_na AS DOUBLE) AS saving_casa_aktif_sum_na
          FROM totals) t
"""


def _features(bank):
    return portfolio_rollup(bank.saving).select(
        "user_id", *[F.col(name).cast("double").alias(name) for name in BALANCE_FEATURES]
    )


@query(SCORED)
def score_trees(bank):
    proba = scoring.score_expression(BALANCE_MODEL).alias("pred_proba")
    return _features(bank).select("user_id", proba).select("user_id", rounded("pred_proba"))


@query(SCORED)
def score_map_in_pandas(bank):
    predict = scoring.tree_predictor(BALANCE_MODEL, BALANCE_FEATURES)
    scored = scoring.score_in_batches(_features(bank), predict, BALANCE_FEATURES, "pred_proba")
    return scored.select("user_id", rounded("pred_proba"))


@query(f"""
    SELECT user_id, CAST(pred_proba > 0.0187 AS INTEGER) AS is_treat FROM ({SCORED}) s
""")
def treat_flag(bank):
    proba = F.round(scoring.score_expression(BALANCE_MODEL), 9)
    return _features(bank).select(
        "user_id", scoring.treat_flag(proba, 0.0187).alias("is_treat")
    )
