"""Row filters."""

from pyspark.sql import functions as F

from featuremart.functions import classes
from featuremart.functions.cleansing import cleanse_table
from featuremart.functions.dates import before
from featuremart.oracles.parts import clean, income_remark, other_remark, text_list
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


@query("SELECT acct_num, branch FROM v_saving WHERE branch IS NOT NULL")
def filter_not_null(bank):
    return bank.view("v_saving").filter(F.col("branch").isNotNull()).select("acct_num", "branch")


@query("SELECT acct_num, status FROM v_saving WHERE status <> 2 AND curr_type = 'usd'")
def filter_compare(bank):
    return (
        bank.view("v_saving")
        .filter((F.col("status") != 2) & (F.col("curr_type") == "usd"))
        .select("acct_num", "status")
    )


@query(f"""
    SELECT acct_num, type FROM v_saving WHERE type IN ({text_list(classes.SAVING_PRODUCTS)})
    UNION ALL
    SELECT user_id, type FROM v_loan WHERE type IN ({text_list(classes.LOAN_TYPES)})
""")
def filter_product_in(bank):
    saving = bank.view("v_saving").filter(F.col("type").isin(*classes.SAVING_PRODUCTS))
    loan = bank.view("v_loan").filter(F.col("type").isin(*classes.LOAN_TYPES))
    return saving.select("acct_num", "type").union(loan.select("user_id", "type"))


@query(f"""
    SELECT user_id, id_number FROM v_cust_info
    WHERE id_number NOT IN ({text_list(classes.EXCLUDED_IDS)})
""")
def filter_id_not_in(bank):
    return (
        bank.view("v_cust_info")
        .filter(~F.col("id_number").isin(*classes.EXCLUDED_IDS))
        .select("user_id", "id_number")
    )


@query("SELECT acct_num FROM v_saving WHERE substring(acct_num, -3, 2) NOT IN ('40', '53')")
def filter_suffix(bank):
    return (
        bank.view("v_saving").filter(classes.suffix_allowed(F.col("acct_num"))).select("acct_num")
    )


@query("""
    SELECT acct_num, strftime(open_date, '%Y-%m-%d %H:%M:%S') AS open_date FROM v_saving
    WHERE open_date < TIMESTAMP '2001-06-15 00:00:00'
""")
def filter_before(bank):
    return (
        bank.view("v_saving")
        .filter(before(F.col("open_date"), PARAMS.cutoff))
        .select("acct_num", stamped("open_date"))
    )


@query(f"""
    SELECT tr_acc, amt, {clean('trremk')} AS trremk, trancd FROM v_trx
    WHERE {income_remark('trremk', 'trancd')}
""")
def remark_include(bank):
    rows = bank.trx.filter(classes.income_remark(F.col("trremk"), F.col("trancd")))
    return cleanse_table(rows).select("tr_acc", "amt", "trremk", "trancd")


@query(f"""
    SELECT tr_acc, CAST(amt AS DOUBLE) AS amt, trremk FROM trx_clean
    WHERE {other_remark('trremk')}
""")
def remark_exclude(bank):
    rows = cleanse_table(bank.trx)
    return rows.filter(~classes.not_income_remark(F.col("trremk"))).select(
        "tr_acc", "amt", "trremk"
    )


@query("SELECT acct_num, credit_balance FROM v_saving WHERE credit_balance BETWEEN 1e5 AND 2e5")
def filter_between(bank):
    return (
        bank.view("v_saving")
        .filter(F.col("credit_balance").between(1e5, 2e5))
        .select("acct_num", "credit_balance")
    )
