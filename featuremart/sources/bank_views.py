"""The bank tables as views over the test tables.

Each text is valid in Spark SQL and in DuckDB, so that a query and its oracle start from the same rows.
Values carry padding, mixed case, blanks and NULLs on purpose. The clock stands at
``RUN_DATE``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from featuremart.params import RunParams

RUN_DATE = date(2001, 6, 20)
PARAMS = RunParams(RUN_DATE)

VIEWS = {
    # account master (from orders + customer)
    "v_saving": """
        SELECT concat(' ', lpad(cast(o_custkey AS string), 7, '0'), ' ') AS user_id,
               lpad(cast(o_orderkey AS string), 12, '0') AS acct_num,
               CASE o_orderpriority WHEN '5-LOW' THEN 'ZZ' WHEN '1-URGENT' THEN 'B1'
                    WHEN '2-HIGH' THEN 'TA' ELSE 'XA' END AS type,
               CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 2 END AS status,
               o_orderdate AS open_date,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE lpad(cast(c_nationkey AS string), 4, '0') END AS branch,
               o_totalprice AS credit_balance,
               o_totalprice AS deposit_balance,
               CASE WHEN o_orderkey % 4 = 0 THEN 'usd' ELSE ' IDR' END AS curr_type,
               CASE WHEN substring(lpad(cast(o_orderkey AS string), 12, '0'), -3, 2) = '40' THEN 'DEPOSITO'
                    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'tabungan '
                    ELSE 'Giro' END AS keterangan,
               CASE WHEN o_orderkey % 20 = 0 THEN '20010614' ELSE '20010615' END AS ds
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    # ledger (from lineitem; the key is NOT unique in lineitem)
    "v_trx": """
        SELECT lpad(cast(l_orderkey AS string), 12, '0') AS tr_acc,
               CASE l_returnflag WHEN 'A' THEN 'C ' WHEN 'R' THEN 'D' ELSE 'X' END AS tr_type,
               l_extendedprice AS amt,
               CASE l_linenumber WHEN 1 THEN 'SALARY PT X' WHEN 2 THEN ' gaji bulan ' WHEN 3 THEN 'SHOPEE CREDIT'
                    WHEN 4 THEN 'SA Credit GL Debit' WHEN 5 THEN 'TRANSFER' WHEN 6 THEN 'Payroll' ELSE 'nan' END AS trremk,
               CASE WHEN l_linenumber = 5 AND l_linestatus = 'O' THEN '428' ELSE '100' END AS trancd,
               cast(year(l_shipdate) AS string) AS year,
               lpad(cast(month(l_shipdate) AS string), 2, '0') AS month,
               lpad(cast(day(l_shipdate) AS string), 2, '0') AS day
        FROM lineitem
    """,
    # branch dimension (from nation + region)
    "v_branch": """
        SELECT concat(r_name, '   ') AS region,
               CASE n_nationkey % 12 WHEN 0 THEN 'Bandung' WHEN 1 THEN 'KANWIL MALANG' WHEN 2 THEN 'Surabaya'
                    WHEN 3 THEN 'Semarang' WHEN 4 THEN 'DKI2' WHEN 5 THEN 'Medan ' WHEN 6 THEN 'Manado'
                    WHEN 7 THEN 'Banjarmasin' WHEN 8 THEN 'Denpasar' WHEN 9 THEN 'K C K'
                    WHEN 10 THEN 'KANINS                                  ' ELSE 'Elsewhere' END AS rgdesc,
               n_name AS mainbr, n_name AS mbdesc,
               lpad(cast(n_nationkey AS string), 4, '0') AS branch, n_name AS brdesc
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    # loan master (from orders)
    "v_loan": """
        SELECT concat(lpad(cast(o_custkey AS string), 7, '0'), ' ') AS user_id,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'K1' ELSE 'AA' END AS type,
               CASE WHEN o_orderkey % 2 = 0 THEN '20010614' ELSE '20010615' END AS ds
        FROM orders
    """,
    # person master, id hashed (from customer)
    "v_cust_info": """
        SELECT concat(lpad(cast(c_custkey AS string), 7, '0'), CASE WHEN c_custkey % 10 = 0 THEN 'X' ELSE ' ' END) AS user_id,
               CASE WHEN c_custkey % 53 = 0 THEN '0' ELSE md5(c_name) END AS id_number,
               CASE WHEN c_custkey % 31 = 0 THEN NULL
                    ELSE date '1950-01-01' + cast(c_custkey * 11 % 18000 AS int) END AS tanggal_lahir,
               CASE WHEN c_custkey % 2 = 0 THEN 'L' ELSE 'P' END AS jenis_kelamin,
               c_nationkey + 4 AS kode_jenis_pekerjaan,
               'occupation' AS jenis_pekerjaan,
               cast(c_custkey % 8 AS int) AS kode_pendidikan,
               'education' AS pendidikan,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'S/D 5 JUTA' WHEN 'FURNITURE' THEN '5 - 10 JUTA'
                    WHEN 'MACHINERY' THEN '50 - 100 JUTA' WHEN 'HOUSEHOLD' THEN '10 - 50 JUTA' ELSE NULL END AS penghasilan_per_bulan
        FROM customer
    """,
    # second income source (from customer)
    "v_cust_info_backup": """
        SELECT lpad(cast(c_custkey AS string), 7, '0') AS user_id,
               CASE WHEN c_acctbal > 5000 THEN 'DIATAS 100 JUTA' ELSE '5 - 10 JUTA' END AS penghasilan_per_bulan,
               CASE WHEN c_custkey % 2 = 0 THEN '20010601' ELSE '20010615' END AS ds
        FROM customer
    """,
    # cards (from orders, every third customer)
    "v_credit_info": """
        SELECT concat('C', lpad(cast(o_custkey AS string), 7, '0'), ' ') AS cust_number,
               concat('4', lpad(cast(o_orderkey % 5000 AS string), 15, '0')) AS card_number,
               o_orderdate AS open_date,
               '20010618' AS ds
        FROM orders WHERE o_custkey % 3 = 0
    """,
    # card account -> plain national id (from customer)
    "v_demography_info": """
        SELECT concat(' C', lpad(cast(c_custkey AS string), 7, '0')) AS acc_number,
               CASE WHEN c_custkey % 41 = 0 THEN 'NaN' ELSE c_name END AS id_number,
               '20010618' AS ds
        FROM customer
    """,
    # CRM card master (from customer)
    "v_crm": """
        SELECT CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE concat('R', lpad(cast(c_custkey AS string), 6, '0')) END AS user_id,
               concat('C', lpad(cast(c_custkey AS string), 7, '0')) AS cust_nmbr,
               concat('4', lpad(cast(c_custkey AS string), 15, '0')) AS cc_nmbr,
               CASE WHEN c_custkey % 2 = 0 THEN timestamp '2000-01-01 00:00:00' ELSE timestamp '2000-06-01 00:00:00' END AS cc_date_open
        FROM customer WHERE c_custkey % 6 = 0
    """,
}

TABLES_OF = {
    "v_saving": ("customer", "orders",),
    "v_trx": ("lineitem",),
    "v_branch": ("region", "nation",),
    "v_loan": ("orders",),
    "v_cust_info": ("customer",),
    "v_cust_info_backup": ("customer",),
    "v_credit_info": ("orders",),
    "v_demography_info": ("customer",),
    "v_crm": ("customer",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, name: str, table_of: Callable[[str], DataFrame]) -> DataFrame:
    """One of the bank tables, over the test tables that ``table_of`` gives."""
    text = VIEWS[name]
    for base in TABLES_OF[name]:
        for keyword in ("FROM", "JOIN"):
            text = text.replace(f"{keyword} {base}", f"{keyword} {{{base}}}")
    return spark.sql(text, **{base: table_of(base) for base in TABLES_OF[name]})
