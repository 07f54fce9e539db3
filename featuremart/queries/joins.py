"""Joins."""

from pyspark.sql import functions as F

from featuremart.functions.cleansing import cleanse_table
from featuremart.operators.joins import skew_join
from featuremart.plans.balances import balance_accounts
from featuremart.plans.card_master import card_owners
from featuremart.plans.customer_pool import first_open_date
from featuremart.plans.dataset import assemble_features as assemble
from featuremart.plans.demographic import active_loan_users, branch_regions, first_accounts
from featuremart.plans.income import income_by_account, user_accounts
from featuremart.plans.ratios import flows_by_account
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


def _cards(bank):
    return cleanse_table(bank.latest("v_credit_info")).select(
        "cust_number", "card_number", "open_date"
    )


@query("""
    SELECT c.cust_number, c.card_number, h.id_number FROM cards c
    JOIN holders h ON c.cust_number = h.acc_number
""")
def join_trim_key(bank):
    holders = (
        cleanse_table(bank.latest("v_demography_info"))
        .filter(F.col("id_number").isNotNull())
        .select(F.col("acc_number").alias("cust_number"), "id_number")
        .distinct()
    )
    cards = _cards(bank).select("cust_number", "card_number")
    return skew_join(cards, holders, "cust_number", "inner")


@query("""
    SELECT DISTINCT h.acc_number AS cust_number, p.user_id
    FROM holders h JOIN person_latest p ON md5(h.id_number) = p.id_number
""")
def join_hashed_id(bank):
    return card_owners(
        cleanse_table(bank.latest("v_demography_info")), cleanse_table(bank.view("v_cust_info"))
    )


@query("""
    SELECT c.cust_number, c.card_number, m.crm_id FROM cards c
    LEFT JOIN crm_rows m ON c.cust_number = m.cust_nmbr
""")
def join_left_fanout(bank):
    crm = (
        cleanse_table(bank.view("v_crm"))
        .filter(F.col("cust_nmbr").isNotNull())
        .select(F.col("cust_nmbr").alias("cust_number"), F.col("user_id").alias("crm_id"))
    )
    cards = _cards(bank).select("cust_number", "card_number")
    return skew_join(cards, crm, "cust_number", "left")


@query("""
    SELECT s.user_id, strftime(s.open_date_saving, '%Y-%m-%d %H:%M:%S') AS open_date_saving,
           f.acct_num, f.branch
    FROM pool_saving s
    JOIN first_account f ON s.user_id = f.user_id AND s.open_date_saving = f.open_date
""")
def join_composite(bank):
    users = first_open_date(bank.saving, PARAMS.cutoff)
    accounts = first_accounts(bank.saving, PARAMS.cutoff).withColumnRenamed(
        "open_date", "open_date_saving"
    )
    return users.join(accounts, ["user_id", "open_date_saving"]).select(
        "user_id", stamped("open_date_saving"), "acct_num", "branch"
    )


@query("""
    SELECT s.acct_num, s.branch, b.region FROM saving_clean s
    JOIN branch_class b ON s.branch = b.branch
""")
def join_dimension(bank):
    regions = branch_regions(bank.view("v_branch"))
    accounts = cleanse_table(bank.saving).select("acct_num", "branch")
    return skew_join(accounts, regions, "branch", "inner").select("acct_num", "branch", "region")


@query("""
    SELECT s.user_id, CAST(1 AS INTEGER) AS has_loan FROM pool_saving s
    JOIN loan_users l ON s.user_id = l.user_id
""")
def join_active_loan(bank):
    users = first_open_date(bank.saving, PARAMS.cutoff).select("user_id")
    return users.join(active_loan_users(bank.latest("v_loan")), "user_id")


@query("""
    SELECT a.user_id, a.account, CAST(i.income AS DOUBLE) AS income
    FROM (SELECT user_id, try_cast(acct_num AS BIGINT) AS account FROM saving_clean) a
    JOIN (SELECT account, sum(amt) AS income FROM income_entries GROUP BY account) i
      ON a.account = i.account
""")
def join_cast_key(bank):
    income = income_by_account(bank.trx, *bank.income_range)
    return (
        skew_join(user_accounts(bank.saving), income, "account", "inner")
        .select("user_id", "account", F.col("income").cast("double").alias("income"))
    )


@query("""
    SELECT b.user_id, b.acct_num,
           count(CASE WHEN t.tr_type = 'C' THEN 1 END) AS credit_count,
           count(CASE WHEN t.tr_type = 'D' THEN 1 END) AS debit_count
    FROM balances b JOIN trx_clean t ON b.acct_num = t.tr_acc
    WHERE t.trx_day BETWEEN '20001217' AND '20010615' AND t.tr_type IN ('C', 'D')
    GROUP BY b.user_id, b.acct_num
""")
def join_ledger(bank):
    accounts = balance_accounts(bank.saving).select("user_id", "acct_num")
    flows = flows_by_account(bank.trx, *bank.income_range)
    return skew_join(accounts, flows, "acct_num", "inner").select(
        "user_id", "acct_num", "credit_count", "debit_count"
    )


@query("SELECT * FROM assembled")
def assemble_features(bank):
    return assemble(*bank.marts)


@query("SELECT user_id, is_credit_card, is_inactive FROM pool")
def presence_flags(bank):
    return bank.pool.select("user_id", "is_credit_card", "is_inactive")
