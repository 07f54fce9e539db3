"""Cleansing, code classes and scalar functions."""

from pyspark.sql import functions as F

from featuremart.functions import classes
from featuremart.functions.cleansing import as_account_key, as_int, cleansed, digits_of_id
from featuremart.functions.cleansing import cleanse_table as cleanse
from featuremart.functions.dates import age_years as years
from featuremart.functions.dates import birth_day, local_time
from featuremart.oracles.parts import (
    age,
    clean,
    education,
    flag,
    income,
    occupation,
    region,
)
from featuremart.operators.joins import skew_join
from featuremart.plans.card_master import card_owners, override_user_id
from featuremart.plans.customer_pool import person_attributes
from featuremart.queries.registry import query, stamped
from featuremart.sources.bank_views import PARAMS


@query(f"SELECT {clean('trremk')} AS trremk, count(*) AS row_count FROM v_trx GROUP BY 1")
def cleanse_column(bank):
    return bank.trx.groupBy(cleansed(F.col("trremk")).alias("trremk")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(f"""
    SELECT {clean('user_id')} AS user_id, {clean('cust_nmbr')} AS cust_nmbr,
           {clean('cc_nmbr')} AS cc_nmbr
    FROM v_crm
    UNION ALL
    SELECT {clean('user_id')}, {clean('acct_num')}, {clean('keterangan')} FROM v_saving
""")
def cleanse_table(bank):
    crm = cleanse(bank.view("v_crm")).select("user_id", "cust_nmbr", "cc_nmbr")
    saving = cleanse(bank.view("v_saving")).select("user_id", "acct_num", "keterangan")
    return crm.union(saving)


@query(f"""
    SELECT user_id, {income('penghasilan')} AS penghasilan_per_bulan FROM person_income
""")
def income_two_sources(bank):
    people, backup = bank.view("v_cust_info"), bank.latest("v_cust_info_backup")
    return person_attributes(people, backup).select("user_id", "penghasilan_per_bulan")


@query("""
    SELECT DISTINCT h.acc_number AS cust_number,
           CASE WHEN length(p.user_id) <> 7 AND m.crm_id IS NOT NULL
                THEN m.crm_id ELSE p.user_id END AS user_id
    FROM holders h JOIN person_latest p ON md5(h.id_number) = p.id_number
    LEFT JOIN crm_rows m ON h.acc_number = m.cust_nmbr
""")
def card_id_override(bank):
    owners = card_owners(
        cleanse(bank.latest("v_demography_info")), cleanse(bank.view("v_cust_info"))
    )
    crm = cleanse(bank.view("v_crm")).select(
        F.col("cust_nmbr").alias("cust_number"), F.col("user_id").alias("crm_id")
    )
    user_id = override_user_id(F.col("user_id"), F.col("crm_id"))
    return (
        skew_join(owners, crm, "cust_number", "left")
        .select("cust_number", user_id.alias("user_id"))
        .distinct()
    )


@query(f"""
    SELECT user_id, kode_jenis_pekerjaan, {occupation('kode_jenis_pekerjaan')} AS jenis_pekerjaan
    FROM v_cust_info
""")
def occupation_class(bank):
    code = F.col("kode_jenis_pekerjaan")
    return bank.view("v_cust_info").select(
        "user_id", code, classes.occupation_class(code).alias("jenis_pekerjaan")
    )


@query(f"""
    SELECT user_id, kode_pendidikan, {education('kode_pendidikan')} AS pendidikan FROM v_cust_info
""")
def education_class(bank):
    code = F.col("kode_pendidikan")
    return bank.view("v_cust_info").select(
        "user_id", code, classes.education_class(code).alias("pendidikan")
    )


@query(f"""
    SELECT user_id, {income('penghasilan_per_bulan')} AS income_class FROM v_cust_info
    UNION ALL
    SELECT user_id, {income('penghasilan_per_bulan')} FROM v_cust_info_backup
""")
def income_class(bank):
    of_bucket = classes.income_class(F.col("penghasilan_per_bulan")).alias("income_class")
    return (
        bank.view("v_cust_info")
        .select("user_id", of_bucket)
        .union(bank.view("v_cust_info_backup").select("user_id", of_bucket))
    )


@query(f"""
    SELECT s.acct_num, {region(clean('b.rgdesc'))} AS region
    FROM v_saving s JOIN v_branch b ON s.branch = b.branch
""")
def region_class(bank):
    branches = bank.view("v_branch").select(
        "branch", classes.region_class(cleansed(F.col("rgdesc"))).alias("region")
    )
    return skew_join(bank.view("v_saving"), branches, "branch", "inner").select("acct_num", "region")


@query(f"SELECT acct_num, {flag('acct_num')} AS flag FROM v_saving")
def account_flag(bank):
    return bank.view("v_saving").select(
        "acct_num", classes.account_flag(F.col("acct_num")).alias("flag")
    )


@query("""
    SELECT trim(user_id) AS user_id, upper(trim(curr_type)) AS curr_type,
           CAST(length(user_id) AS INTEGER) AS id_length,
           substring(acct_num, -3, 2) AS suffix, concat(year, month) AS month_text,
           lpad(CAST(status AS VARCHAR), 3, '0') AS status_text, md5(acct_num) AS hash
    FROM (SELECT *, strftime(open_date, '%Y') AS year, strftime(open_date, '%m') AS month
          FROM v_saving) s
""")
def scalar_string(bank):
    return bank.view("v_saving").select(
        F.trim("user_id").alias("user_id"),
        F.upper(F.trim("curr_type")).alias("curr_type"),
        F.length("user_id").alias("id_length"),
        classes.account_suffix(F.col("acct_num")).alias("suffix"),
        F.concat(F.date_format("open_date", "yyyy"), F.date_format("open_date", "MM")).alias(
            "month_text"
        ),
        F.lpad(F.col("status").cast("string"), 3, "0").alias("status_text"),
        F.md5("acct_num").alias("hash"),
    )


@query("""
    SELECT acct_num, strftime(open_date, '%Y-%m-%d') AS open_day,
           strftime(open_date + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS open_date
    FROM v_saving
""")
def scalar_date(bank):
    return bank.view("v_saving").select(
        "acct_num",
        F.date_format("open_date", "yyyy-MM-dd").alias("open_day"),
        local_time(F.col("open_date")).alias("open_date"),
    ).withColumn("open_date", stamped("open_date"))


@query("""
    SELECT acct_num, try_cast(acct_num AS BIGINT) AS account,
           try_cast(trim(branch) AS INTEGER) AS branch_number,
           CAST(status AS VARCHAR) AS status_text,
           CAST(CAST(credit_balance AS DECIMAL(18,2)) AS DOUBLE) AS credit_balance
    FROM v_saving
""")
def scalar_cast(bank):
    return bank.view("v_saving").select(
        "acct_num",
        as_account_key(F.col("acct_num")).alias("account"),
        as_int(F.col("branch")).alias("branch_number"),
        F.col("status").cast("string").alias("status_text"),
        F.col("credit_balance").cast("decimal(18,2)").cast("double").alias("credit_balance"),
    )


@query("""
    SELECT acct_num, coalesce(branch, 'none') AS branch,
           CASE WHEN status = 1 THEN 'active' ELSE 'other' END AS state,
           CAST(type IN ('TA', 'B1') AND keterangan LIKE 'tab%' AS INTEGER) AS is_tab,
           CAST(open_date BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31' AS INTEGER)
             AS is_1999,
           credit_balance / nullif(status - 1, 0) + 1 AS per_status
    FROM v_saving
""")
def scalar_cond(bank):
    return bank.view("v_saving").selectExpr(
        "acct_num",
        "coalesce(branch, 'none') AS branch",
        "CASE WHEN status = 1 THEN 'active' ELSE 'other' END AS state",
        "CAST(type IN ('TA', 'B1') AND keterangan LIKE 'tab%' AS INT) AS is_tab",
        "CAST(open_date BETWEEN TIMESTAMP_NTZ '1999-01-01 00:00:00' "
        "AND TIMESTAMP_NTZ '1999-12-31 00:00:00' AS INT) AS is_1999",
        "try_divide(credit_balance, status - 1) + 1 AS per_status",
    )


@query(f"""
    SELECT user_id, {age('tanggal_lahir', "DATE '2001-06-15'")} AS usia FROM v_cust_info
""")
def age_years(bank):
    return bank.view("v_cust_info").select(
        "user_id", years(F.col("tanggal_lahir"), PARAMS.data_ds).alias("usia")
    )


@query(r"""
    SELECT card_number, CASE WHEN length(digits) >= 16 THEN digits END AS national_id
    FROM (SELECT card_number,
                 regexp_replace(concat('ID. ', substring(card_number, 1, 8), '-',
                                       substring(card_number, 9, 8), cust_number),
                                '[^\p{Nd}]', '', 'g') AS digits
          FROM v_credit_info)
    UNION ALL
    SELECT acct_num, CASE WHEN length(acct_num) >= 16 THEN acct_num END FROM v_saving
""")
def national_id_cleanse(bank):
    cards = bank.view("v_credit_info")
    text = F.concat(
        F.lit("ID. "), F.substring("card_number", 1, 8), F.lit("-"),
        F.substring("card_number", 9, 8), "cust_number",
    )
    accounts = bank.view("v_saving").select(
        "acct_num", digits_of_id(F.col("acct_num")).alias("national_id")
    )
    return cards.select("card_number", digits_of_id(text).alias("national_id")).union(accounts)


@query("""
    SELECT user_id, try_cast(trim(user_id) AS INTEGER) AS number,
           CAST(try_strptime(text, '%Y-%m-%d') IS NOT NULL AS INTEGER) AS has_date,
           100.0 / nullif(try_cast(trim(user_id) AS INTEGER) % 10, 0) AS quotient
    FROM (SELECT user_id, CASE WHEN user_id LIKE '%X' THEN 'bad'
                               ELSE strftime(tanggal_lahir, '%Y-%m-%d') END AS text
          FROM v_cust_info)
""")
def safe_parse(bank):
    number = as_int(F.col("user_id"))
    text = F.when(F.col("user_id").like("%X"), F.lit("bad")).otherwise(
        F.date_format("tanggal_lahir", "yyyy-MM-dd")
    )
    return bank.view("v_cust_info").select(
        "user_id",
        number.alias("number"),
        birth_day(text).isNotNull().cast("int").alias("has_date"),
        F.try_divide(F.lit(100.0), number % 10).alias("quotient"),
    )
