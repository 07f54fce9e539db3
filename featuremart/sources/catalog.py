"""Catalog tables by their role."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Role -> default catalog name. Pass other names to ``read`` where a catalog differs.
INPUT_TABLES = {
    "credit_info": "datalake.customer_credit_info_daily",
    "demography_info": "datalake.customer_demography_info_daily",
    "crm": "datalake.master_credit_card",
    "cust_info": "datamart.customer_info_all",
    "cust_info_backup": "datamart.customer_info_all_backup",
    "saving": "datalake.master_saving",
    "branch": "datalake.master_branch",
    "loan": "datalake.master_loan",
    "trx": "datalake.trx_history",
}

MART_TABLES = {
    "card_master": "datamart.master_cc_customer_data",
    "pool": "datamart.prodrec_fact_customer_data",
    "demographic": "datamart.prodrec_cc_fitur_demog",
    "portfolio": "datamart.prodrec_cc_fitur_portfolio",
    "income": "datamart.prodrec_cc_fitur_transaction2",
    "ratios": "datamart.prodrec_cc_fitur_transaction3",
    "dataset": "datamart.prodrec_cc_fact_dataset_inference",
    "scores": "datamart.prodrec_cc_fact_model_result",
}


def table_name(role: str, names: Mapping[str, str] | None = None) -> str:
    return {**INPUT_TABLES, **MART_TABLES, **(names or {})}[role]


def read(spark: SparkSession, role: str, names: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.table(table_name(role, names))
