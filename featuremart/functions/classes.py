"""Code lists and their classes, and the expressions that apply them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.cleansing import as_int, cleansed, int_column

# ---- Fixed values: they decide results and feed the trained encoders, so they are kept
# ---- letter for letter.

OCCUPATION_CLASSES = {
    "TIDAK BERPENGHASILAN": (18, 23, 7),
    "PEKERJA NON-ASN/BUMN/WIRASWASTA": (
        11, 10, 2, 22, 5, 6, 26, 15, 25, 12, 14, 19, 13, 1, 27, 3, 24,
    ),
    "WIRASWASTA": (16, 28),
    "ASN": (4, 17),
    "PENSIUNAN": (9,),
    "BUMN": (21,),
    "TNI/POLRI": (8, 20),
}

EDUCATION_CLASSES = {
    "SD/SMP": (1,),
    "SMA": (2,),
    "PENDIDIKAN LANJUT": (3, 4, 5, 6),
}

UNDEFINED = "UNDEFINED"

LOWEST_INCOME = "S/D 5 JUTA"

INCOME_CLASSES = {
    LOWEST_INCOME: (LOWEST_INCOME,),
    "5 - 10 JUTA": ("5 - 10 JUTA",),
    "10 - 50 JUTA": ("10 - 50 JUTA",),
    "DIATAS 50 JUTA": ("50 - 100 JUTA", "DIATAS 100 JUTA", "DIATAS 50 JUTA"),
}

REGION_CLASSES = {
    "JABAR": ("Bandung",),
    "JATIM": ("KANWIL MALANG", "Surabaya"),
    "JATENG-DIY": ("Yogyakarta", "Semarang"),
    "DKI": (
        "KANWIL JAKARTA 3", "DKI2", "DKI",
        "KANWIL PEKANBARU", "Padang", "KANWIL BANDAR LAMPUNG", "Medan", "Palembang",
    ),
    "SULAWESI-PAPUA": ("Makassar", "KANWIL JAYAPURA", "Manado"),
    "KALIMANTAN": ("Banjarmasin",),
    "BALI": ("Denpasar",),
    "KCK": ("K C K",),
}

SAVING_PRODUCTS = (
    "B1", "B2", "B3", "B4", "B5", "BA", "BB", "BC", "BD", "BE", "BF", "BG", "BH", "BI", "BJ",
    "BK", "BL", "BM", "BN", "BO", "BP", "BQ", "BU", "BW", "BX", "BZ", "EB", "EK", "EL", "FG",
    "FW", "LN", "MN", "PX", "TA", "TB", "TH", "TM", "TN", "TP", "TS", "TT", "TU", "TV", "TZ",
    "UA", "UB", "UC", "UN", "VA", "VB", "VC", "VD", "VE", "VF", "VG", "VH", "VI", "VJ", "VK",
    "VL", "VM", "VN", "VO", "VP", "VR", "VU", "VW", "VX", "VY", "VZ", "XA", "LM", "TR",
)

LOAN_TYPES = (
    "10", "1E", "1F", "3E", "5F", "CR", "F8", "F9", "FH", "FI", "HQ", "HT", "K1", "K2", "K3",
    "K4", "K5", "KJ", "L1", "L2", "L3", "MJ", "MS", "PH", "QP", "W0", "W1", "W2", "W3", "W4",
    "W5", "W6", "W7", "W8", "WL", "WM", "WN", "WO", "WP", "WR", "WT", "Z8", "ZN", "ZO", "ZP",
    "ZQ", "ZR", "ZS", "ZT", "ZU", "ZV", "ZW", "ZX",
)

EXCLUDED_IDS = ("", " ", "0", "123456789")

EXCLUDED_SUFFIXES = ("40", "53")

DEPOSIT_SUFFIX = 40

# Account status: 1 is active, 2 is closed.
ACTIVE = 1
CLOSED = 2

INCOME_WORDS = ("SALARY", "CREDIT", "GAJI", "PAYROLL")
INCOME_CODES = ("428", "541", "555")
SHOP_WORDS = ("SHOPE", "BUKALAPA")
NOT_INCOME_REMARKS = (
    "SA Credit GL Debit",
    "Salary crediting CashBack Brimo",
    "Salary crediting KUPON",
)

# ---- End of fixed values.


def classify(value: Column, classes: Mapping[str, Sequence], default: str | None = None) -> Column:
    """Class whose members hold ``value``; ``default`` for all others and for NULL."""
    chain = F
    for label, members in classes.items():
        chain = chain.when(value.isin(*members), F.lit(label))
    return chain.otherwise(F.lit(default))


def occupation_class(code: Column) -> Column:
    return classify(as_int(code), OCCUPATION_CLASSES, UNDEFINED)


def education_class(code: Column) -> Column:
    return classify(as_int(code), EDUCATION_CLASSES, UNDEFINED)


def income_class(bucket: Column) -> Column:
    return classify(bucket, INCOME_CLASSES, LOWEST_INCOME)


def region_class(region: Column) -> Column:
    return classify(region, REGION_CLASSES)


def account_suffix(account: Column) -> Column:
    """The two characters before the last one."""
    return F.substring(account.cast("string"), -3, 2)


def suffix_allowed(account: Column) -> Column:
    """False for excluded suffixes, NULL (so: dropped by a filter) for a NULL account."""
    return ~account_suffix(account).isin(*EXCLUDED_SUFFIXES)


def account_flag(account: Column) -> Column:
    """NON_DEPO when the suffix is a number other than the deposit one, else DEPO."""
    other = account_suffix(account).try_cast("int") != DEPOSIT_SUFFIX
    return F.when(other, F.lit("NON_DEPO")).otherwise(F.lit("DEPO"))


def eligible_saving(saving: DataFrame) -> Column:
    """Accounts that count as savings: listed product, not closed, allowed suffix."""
    return (
        F.col("type").isin(*SAVING_PRODUCTS)
        & (int_column(saving, "status") != CLOSED)
        & suffix_allowed(F.col("acct_num"))
    )


def any_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def income_remark(remark: Column, code: Column) -> Column:
    """Remark names an income, or the code does."""
    folded = F.upper(remark)
    return any_of([folded.contains(word) for word in INCOME_WORDS]) | F.trim(code).isin(
        *INCOME_CODES
    )


def not_income_remark(remark: Column) -> Column:
    """Shop cash-backs (any case) and three exact wordings that only look like an income."""
    folded = F.upper(remark)
    return any_of(
        [folded.contains(word) for word in SHOP_WORDS]
        + [remark.contains(wording) for wording in NOT_INCOME_REMARKS]
    )


def income_entry(remark: Column, code: Column) -> Column:
    """Ledger entry that counts as income. Without a remark there is none, whatever the code."""
    return (
        income_remark(remark, code) & ~not_income_remark(remark) & cleansed(remark).isNotNull()
    )
