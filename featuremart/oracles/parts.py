"""Named parts of the oracle texts. A text may name any part or bank view; ``with_parts``
puts those it needs in front of it."""

from __future__ import annotations

import re

from featuremart.functions.classes import (
    EDUCATION_CLASSES,
    INCOME_CLASSES,
    INCOME_CODES,
    INCOME_WORDS,
    LOAN_TYPES,
    LOWEST_INCOME,
    NOT_INCOME_REMARKS,
    OCCUPATION_CLASSES,
    REGION_CLASSES,
    SAVING_PRODUCTS,
    SHOP_WORDS,
    UNDEFINED,
)
from featuremart.operators.scoring import TreeModel
from featuremart.sources.bank_views import VIEWS


def clean(x: str) -> str:
    return f"CASE WHEN trim({x}) <> '' AND trim(upper({x})) <> 'NAN' THEN trim({x}) END"


def text_list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def class_case(x: str, classes: dict, default: str | None) -> str:
    arms = []
    for label, members in classes.items():
        names = ", ".join(str(m) if isinstance(m, int) else f"'{m}'" for m in members)
        arms.append(f"WHEN {x} IN ({names}) THEN '{label}'")
    other = "NULL" if default is None else f"'{default}'"
    return f"CASE {' '.join(arms)} ELSE {other} END"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def occupation(x: str) -> str:
    return class_case(x, OCCUPATION_CLASSES, UNDEFINED)


def education(x: str) -> str:
    return class_case(x, EDUCATION_CLASSES, UNDEFINED)


def income(x: str) -> str:
    return class_case(x, INCOME_CLASSES, LOWEST_INCOME)


def region(x: str) -> str:
    return class_case(x, REGION_CLASSES, None)


def flag(x: str) -> str:
    return (
        f"CASE WHEN try_cast(substring({x}, -3, 2) AS INTEGER) <> 40 "
        "THEN 'NON_DEPO' ELSE 'DEPO' END"
    )


def income_remark(remark: str, code: str) -> str:
    words = " OR ".join(f"trim(upper({remark})) LIKE '%{w}%'" for w in INCOME_WORDS)
    return f"({words} OR {code} IN ({text_list(INCOME_CODES)}))"


def other_remark(remark: str) -> str:
    words = " AND ".join(f"trim(upper({remark})) NOT LIKE '%{w}%'" for w in SHOP_WORDS)
    exact = " AND ".join(f"{remark} NOT LIKE '%{w}%'" for w in NOT_INCOME_REMARKS)
    return f"({words} AND {exact})"


def age(birth: str, as_of: str) -> str:
    return (
        f"CAST(year({as_of}) - year({birth}) - CASE WHEN month({as_of}) * 100 + day({as_of}) < "
        f"month({birth}) * 100 + day({birth}) THEN 1 ELSE 0 END AS INTEGER)"
    )


ELIGIBLE = (
    f"type IN ({text_list(SAVING_PRODUCTS)}) AND status <> 2 "
    "AND substring(acct_num, -3, 2) NOT IN ('40', '53')"
)


def measure(family: str, short: str, depo: str, state: str, currency: str, column: str) -> str:
    """Count and sum of one cell of the measure matrix."""
    where = (
        f"flag = '{depo}' AND keterangan = '{family}' AND status "
        f"{'=' if state == 'aktif' else '<>'} 1 AND curr_type "
        f"{'=' if currency == 'idr' else '<>'} 'IDR'"
    )
    name = f"saving_{short}_{state}_{currency}"
    return (
        f"count(DISTINCT CASE WHEN {where} THEN acct_num END) AS {name}_count,\n"
        f"sum(CASE WHEN {where} THEN {column} END) AS {name}_sum"
    )


MATRIX = ",\n".join(
    measure(family, short, depo, state, currency, column)
    for family, short, depo, column in (
        ("TABUNGAN", "tab", "NON_DEPO", "credit_balance"),
        ("GIRO", "giro", "NON_DEPO", "credit_balance"),
        ("DEPOSITO", "dep", "DEPO", "deposit_balance"),
    )
    for state in ("aktif", "nonaktif")
    for currency in ("idr", "nonidr")
)

MATRIX_AS_DOUBLES = ", ".join(
    f"saving_{short}_{state}_{currency}_count, "
    f"CAST(saving_{short}_{state}_{currency}_sum AS DOUBLE) "
    f"AS saving_{short}_{state}_{currency}_sum"
    for short in ("tab", "giro", "dep")
    for state in ("aktif", "nonaktif")
    for currency in ("idr", "nonidr")
)


def tree_case(model: TreeModel) -> str:
    """Probability of class 1 of a node table."""

    def walk(nodes, at):
        n = nodes[at]
        if n.feature is None:
            return repr(n.leaf)
        return (
            f"CASE WHEN {n.feature} IS NULL THEN {walk(nodes, n.missing)} "
            f"WHEN {n.feature} < {n.threshold!r} THEN {walk(nodes, n.yes)} "
            f"ELSE {walk(nodes, n.no)} END"
        )

    trees = " + ".join(f"CAST({walk(nodes, 0)} AS DOUBLE)" for nodes in model.trees().values())
    return f"1.0 / (1.0 + exp(-({model.margin!r} + {trees})))"


# Parts in an order in which each uses only earlier ones.
PARTS = {
    "saving_now": """
        SELECT * FROM v_saving
        WHERE ds = (SELECT max(ds) FROM v_saving WHERE ds <= '20010615')""",
    "saving_clean": f"""
        SELECT {clean('user_id')} AS user_id, {clean('acct_num')} AS acct_num,
               {clean('type')} AS type, status, open_date, {clean('branch')} AS branch,
               CAST(credit_balance AS DECIMAL(18,2)) AS credit_balance,
               CAST(deposit_balance AS DECIMAL(18,2)) AS deposit_balance,
               {clean('curr_type')} AS curr_type, {clean('keterangan')} AS keterangan
        FROM saving_now""",
    "trx_clean": f"""
        SELECT {clean('tr_acc')} AS tr_acc, {clean('tr_type')} AS tr_type,
               CAST(amt AS DECIMAL(18,2)) AS amt, {clean('trremk')} AS trremk,
               {clean('trancd')} AS trancd, concat(year, month, day) AS trx_day
        FROM v_trx""",
    "cards": f"""
        SELECT {clean('cust_number')} AS cust_number, {clean('card_number')} AS card_number,
               open_date
        FROM v_credit_info WHERE ds = (SELECT max(ds) FROM v_credit_info)""",
    "holders": f"""
        SELECT DISTINCT {clean('acc_number')} AS acc_number, {clean('id_number')} AS id_number
        FROM v_demography_info
        WHERE ds = (SELECT max(ds) FROM v_demography_info)
          AND {clean('id_number')} IS NOT NULL""",
    "card_open": """
        SELECT c.cust_number, c.card_number, h.id_number,
               min(c.open_date) + INTERVAL 7 HOUR AS open_date
        FROM cards c JOIN holders h ON c.cust_number = h.acc_number
        GROUP BY c.cust_number, c.card_number, h.id_number""",
    "person_rows": f"""
        SELECT DISTINCT {clean('user_id')} AS user_id, {clean('id_number')} AS id_number
        FROM v_cust_info
        WHERE {clean('id_number')} NOT IN ('', ' ', '0', '123456789')""",
    "person_latest": """
        SELECT id_number, user_id FROM (
            SELECT *, row_number() OVER (PARTITION BY id_number
                                         ORDER BY user_id DESC NULLS LAST) AS rn
            FROM person_rows)
        WHERE rn = 1""",
    "card_users": """
        SELECT DISTINCT p.user_id, c.cust_number, c.card_number, c.open_date
        FROM card_open c JOIN person_latest p ON md5(c.id_number) = p.id_number""",
    "crm_rows": f"""
        SELECT {clean('user_id')} AS crm_id, {clean('cust_nmbr')} AS cust_nmbr FROM v_crm""",
    "card_master": """
        SELECT CASE WHEN length(u.user_id) <> 7 AND m.crm_id IS NOT NULL
                    THEN m.crm_id ELSE u.user_id END AS user_id,
               u.card_number AS acctno_cc, u.open_date AS open_date_cc
        FROM card_users u LEFT JOIN crm_rows m ON u.cust_number = m.cust_nmbr
        WHERE u.open_date < TIMESTAMP '2001-06-20 00:00:00'""",
    "pool_saving": f"""
        SELECT trim(user_id) AS user_id, min(open_date) AS open_date_saving
        FROM saving_now WHERE {ELIGIBLE}
        GROUP BY trim(user_id)
        HAVING min(open_date) < TIMESTAMP '2001-06-15 00:00:00'""",
    "person_income": """
        SELECT trim(d.user_id) AS user_id, strftime(d.tanggal_lahir, '%Y-%m-%d') AS tanggal_lahir,
               d.tanggal_lahir AS birth,
               d.jenis_kelamin, d.kode_jenis_pekerjaan, d.jenis_pekerjaan AS jenis_pekerjaan_nf,
               d.kode_pendidikan, d.pendidikan AS pendidikan_nf,
               CASE WHEN d.penghasilan_per_bulan IS NOT NULL THEN d.penghasilan_per_bulan
                    ELSE b.penghasilan_per_bulan END AS penghasilan
        FROM v_cust_info d
        LEFT JOIN (SELECT * FROM v_cust_info_backup
                   WHERE ds = (SELECT max(ds) FROM v_cust_info_backup)) b
               ON trim(d.user_id) = b.user_id""",
    "pool_users": f"""
        SELECT DISTINCT s.user_id, s.open_date_saving, p.tanggal_lahir, p.birth, p.jenis_kelamin,
               p.kode_jenis_pekerjaan, p.jenis_pekerjaan_nf, p.kode_pendidikan, p.pendidikan_nf,
               {income('p.penghasilan')} AS penghasilan_per_bulan
        FROM pool_saving s LEFT JOIN person_income p ON s.user_id = p.user_id""",
    "inactive_users": """
        SELECT trim(user_id) AS user_id FROM saving_now GROUP BY trim(user_id)
        HAVING max(CASE WHEN status = 1 THEN 1 ELSE 0 END) = 0""",
    "pool": f"""
        SELECT u.user_id, u.tanggal_lahir, {age('u.birth', "DATE '2001-06-15'")} AS usia,
               u.jenis_kelamin, {education('u.kode_pendidikan')} AS pendidikan,
               {occupation('u.kode_jenis_pekerjaan')} AS jenis_pekerjaan,
               u.penghasilan_per_bulan, u.open_date_saving, '2001-06-15' AS event_date,
               CAST(c.user_id IS NOT NULL AS INTEGER) AS is_credit_card,
               CAST(i.user_id IS NOT NULL AS INTEGER) AS is_inactive
        FROM pool_users u
        LEFT JOIN (SELECT DISTINCT user_id FROM card_master
                   WHERE open_date_cc < TIMESTAMP '2001-06-15 00:00:00') c
               ON u.user_id = c.user_id
        LEFT JOIN inactive_users i ON u.user_id = i.user_id""",
    "branch_class": f"""
        SELECT DISTINCT {clean('branch')} AS branch, {region(clean('rgdesc'))} AS region
        FROM v_branch WHERE {clean('rgdesc')} IS NOT NULL""",
    "first_account": f"""
        SELECT user_id, open_date, acct_num, branch FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id
                ORDER BY open_date NULLS FIRST, acct_num NULLS FIRST, branch NULLS FIRST) AS rn
            FROM saving_clean WHERE {ELIGIBLE} AND branch IS NOT NULL)
        WHERE rn = 1 AND open_date < TIMESTAMP '2001-06-15 00:00:00'""",
    "loan_users": f"""
        SELECT DISTINCT {clean('user_id')} AS user_id
        FROM v_loan
        WHERE ds = (SELECT max(ds) FROM v_loan) AND status = 1
          AND {clean('type')} IN ({text_list(LOAN_TYPES)})""",
    "demographic": """
        SELECT p.user_id, p.usia AS demog_personal_usia_na_na,
               p.pendidikan AS demog_personal_pendidikan_na_na,
               p.jenis_pekerjaan AS demog_personal_jenis_pekerjaan_na_na,
               p.penghasilan_per_bulan AS demog_personal_penghasilan_perbulan_na_na,
               r.region AS demog_id_rgdesc_na_na,
               CAST(l.user_id IS NOT NULL AS INTEGER) AS demog_is_pinjaman_aktif_na_na
        FROM pool p
        LEFT JOIN (SELECT DISTINCT f.user_id, f.open_date, b.region
                   FROM first_account f JOIN branch_class b ON f.branch = b.branch) r
               ON p.user_id = r.user_id AND p.open_date_saving = r.open_date
        LEFT JOIN loan_users l ON p.user_id = l.user_id""",
    "balances": f"""
        SELECT user_id, acct_num, status, credit_balance, deposit_balance,
               trim(upper(curr_type)) AS curr_type, trim(upper(keterangan)) AS keterangan,
               {flag('acct_num')} AS flag
        FROM saving_clean WHERE branch IS NOT NULL AND user_id IS NOT NULL""",
    "matrix": f"""
        SELECT user_id, {MATRIX}
        FROM balances GROUP BY user_id""",
    "totals": """
        SELECT *,
               saving_tab_aktif_idr_count + saving_giro_aktif_idr_count
                 + saving_tab_aktif_nonidr_count + saving_giro_aktif_nonidr_count
                 AS saving_casa_aktif_count_na,
               coalesce(saving_tab_aktif_idr_sum, 0) + coalesce(saving_giro_aktif_idr_sum, 0)
                 + coalesce(saving_tab_aktif_nonidr_sum, 0)
                 + coalesce(saving_giro_aktif_nonidr_sum, 0) AS saving_casa_aktif_sum_na,
               coalesce(saving_dep_aktif_idr_sum, 0) + coalesce(saving_dep_aktif_nonidr_sum, 0)
                 AS dep_sum
        FROM matrix""",
    "portfolio": """
        SELECT p.user_id, t.saving_casa_aktif_count_na,
               CAST(t.saving_casa_aktif_sum_na AS DOUBLE) AS saving_casa_aktif_sum_na
        FROM pool p LEFT JOIN totals t ON p.user_id = t.user_id""",
    "income_entries": f"""
        SELECT try_cast(tr_acc AS BIGINT) AS account, amt FROM trx_clean
        WHERE trx_day BETWEEN '20001217' AND '20010615' AND tr_acc IS NOT NULL
          AND {income_remark('trremk', 'trancd')} AND {other_remark('trremk')}
          AND tr_type = 'C'""",
    "income_users": """
        SELECT s.user_id, sum(e.amt) AS income
        FROM income_entries e
        JOIN (SELECT user_id, try_cast(acct_num AS BIGINT) AS account FROM saving_clean) s
          ON e.account = s.account
        GROUP BY s.user_id""",
    "income": """
        SELECT p.user_id, coalesce(CAST(i.income AS DOUBLE), 0.0) AS ddhist_na_income_sum_180d
        FROM pool p LEFT JOIN income_users i ON p.user_id = i.user_id""",
    "flows": """
        SELECT b.user_id,
               count(CASE WHEN t.tr_type = 'C' THEN 1 END) AS credit_count,
               sum(CASE WHEN t.tr_type = 'C' THEN t.amt ELSE 0 END) AS credit_sum,
               count(CASE WHEN t.tr_type = 'D' THEN 1 END) AS debit_count,
               sum(CASE WHEN t.tr_type = 'D' THEN t.amt ELSE 0 END) AS debit_sum
        FROM trx_clean t JOIN balances b ON t.tr_acc = b.acct_num
        WHERE t.trx_day BETWEEN '20010516' AND '20010615'
        GROUP BY b.user_id""",
    "ratios": """
        SELECT p.user_id,
               CAST(coalesce(t.saving_casa_aktif_sum_na, 0) AS DOUBLE)
                 / nullif(CAST(coalesce(f.credit_sum, 0) AS DOUBLE), 0)
                 AS transaction_ratio_sumcasa_sumtrxcred_na_l30d,
               CAST(coalesce(t.saving_casa_aktif_sum_na + t.dep_sum, 0) AS DOUBLE)
                 / nullif(CAST(coalesce(f.debit_sum, 0) AS DOUBLE), 0)
                 AS transaction_ratio_sumcasatd_sumtrxdeb_na_l30d
        FROM pool p LEFT JOIN totals t ON p.user_id = t.user_id
        LEFT JOIN flows f ON p.user_id = f.user_id""",
    "assembled": """
        SELECT DISTINCT p.user_id, d.* EXCLUDE (user_id),
               coalesce(b.saving_casa_aktif_count_na, 0) AS saving_casa_aktif_count_na,
               coalesce(b.saving_casa_aktif_sum_na, 0) AS saving_casa_aktif_sum_na,
               coalesce(i.ddhist_na_income_sum_180d, 0) AS ddhist_na_income_sum_180d,
               coalesce(r.transaction_ratio_sumcasa_sumtrxcred_na_l30d, 0)
                 AS transaction_ratio_sumcasa_sumtrxcred_na_l30d,
               coalesce(r.transaction_ratio_sumcasatd_sumtrxdeb_na_l30d, 0)
                 AS transaction_ratio_sumcasatd_sumtrxdeb_na_l30d
        FROM pool p
        LEFT JOIN demographic d ON p.user_id = d.user_id
        LEFT JOIN portfolio b ON p.user_id = b.user_id
        LEFT JOIN income i ON p.user_id = i.user_id
        LEFT JOIN ratios r ON p.user_id = r.user_id
        WHERE p.is_credit_card = 0 AND p.is_inactive = 0""",
    "dataset": """
        SELECT concat('20010620', '02', lpad(CAST(row_number() OVER (ORDER BY
                   md5(concat_ws('|', user_id, demog_personal_usia_na_na,
                       demog_personal_pendidikan_na_na, demog_personal_jenis_pekerjaan_na_na,
                       demog_personal_penghasilan_perbulan_na_na, demog_id_rgdesc_na_na,
                       demog_is_pinjaman_aktif_na_na))) AS VARCHAR), 9, '0')) AS id, *
        FROM assembled""",
    "batches": """
        SELECT *, CAST(floor((CAST(substring(id, -9, 9) AS INTEGER) - 1) / 250) + 1 AS INTEGER)
                    AS batch
        FROM dataset WHERE demog_id_rgdesc_na_na IS NOT NULL""",
}


def with_parts(text: str) -> str:
    """``text`` preceded by the views and parts it names, directly or through another part."""
    known = {**{name: body for name, body in VIEWS.items()}, **PARTS}
    needed: set[str] = set()
    queue = [text]
    while queue:
        for name in set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", queue.pop())) & set(known):
            if name not in needed:
                needed.add(name)
                queue.append(known[name])
    if not needed:
        return text
    clauses = ",\n".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    return f"WITH {clauses}\n{text}"
