"""Row choice and numbering."""

from pyspark.sql import functions as F

from featuremart.functions.cleansing import cleanse_table
from featuremart.operators.windows import batch_of, number_rows, row_id, sequence_of
from featuremart.plans.card_master import person_ids
from featuremart.plans.demographic import first_accounts
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


@query("SELECT id_number AS id_hash, user_id FROM person_latest")
def latest_per_key(bank):
    return person_ids(cleanse_table(bank.view("v_cust_info")))


@query("""
    SELECT user_id, strftime(open_date, '%Y-%m-%d %H:%M:%S') AS open_date, acct_num, branch
    FROM first_account
""")
def first_per_key(bank):
    return first_accounts(bank.saving, PARAMS.cutoff).select(
        "user_id", stamped("open_date"), "acct_num", "branch"
    )


NUMBERED = """
    SELECT concat('20010620', '02',
                  lpad(CAST(row_number() OVER (ORDER BY md5(acct_num), acct_num) AS VARCHAR),
                       9, '0')) AS id, acct_num, user_id
    FROM v_saving
"""


def _numbered(bank):
    numbered = number_rows(bank.view("v_saving").select("acct_num", "user_id"), ["acct_num"])
    ids = row_id(PARAMS.ds, F.col("row_number")).alias("id")
    return numbered.select(ids, "acct_num", "user_id")


@query(NUMBERED)
def global_row_id(bank):
    return _numbered(bank)


@query(f"""
    SELECT id, CAST(floor((CAST(substring(id, -9, 9) AS INTEGER) - 1) / 500) + 1 AS INTEGER)
                 AS batch
    FROM ({NUMBERED}) n
""")
def batch_slice(bank):
    return _numbered(bank).select("id", batch_of(sequence_of(F.col("id")), 500).alias("batch"))
