"""Snapshots of the bank tables and the marts built from them, over the test tables."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from featuremart.operators.scratch import stage
from featuremart.operators.snapshots import ledger_range, newest_rows
from featuremart.plans.card_master import card_master
from featuremart.plans.customer_pool import customer_pool
from featuremart.plans.dataset import inference_dataset
from featuremart.plans.demographic import demographic_features
from featuremart.plans.income import WINDOW_DAYS as INCOME_DAYS
from featuremart.plans.income import income_features
from featuremart.plans.portfolio import portfolio_features
from featuremart.plans.ratios import WINDOW_DAYS as RATIO_DAYS
from featuremart.plans.ratios import ratio_features
from featuremart.sources import bank_views
from featuremart.sources.bank_views import PARAMS


class Bank:
    """Everything one run reads and derives. A mart that several jobs read is written once."""

    # Time stamped on rows the queries write, fixed so that they can be compared.
    modified = datetime(2001, 6, 20, 8, 0, 0, tzinfo=UTC)

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = bank_views.table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = bank_views.view(self.spark, name, self.table)
        return self._views[name]

    def latest(self, name: str) -> DataFrame:
        return newest_rows(self.view(name))

    @cached_property
    def saving(self) -> DataFrame:
        return newest_rows(self.view("v_saving"), PARAMS.data_ds)

    @cached_property
    def trx(self) -> DataFrame:
        return self.view("v_trx")

    @cached_property
    def income_range(self) -> tuple[str, str]:
        return PARAMS.days_before(INCOME_DAYS), PARAMS.data_ds

    @cached_property
    def ratio_range(self) -> tuple[str, str]:
        return PARAMS.days_before(RATIO_DAYS), PARAMS.data_ds

    @cached_property
    def income_ledger(self) -> DataFrame:
        return ledger_range(self.trx, *self.income_range)

    @cached_property
    def card_master(self) -> DataFrame:
        return card_master(
            self.latest("v_credit_info"),
            self.latest("v_demography_info"),
            self.view("v_cust_info"),
            self.view("v_crm"),
            PARAMS.card_cutoff,
        )

    @cached_property
    def pool(self) -> DataFrame:
        return customer_pool(
            self.saving,
            self.view("v_cust_info"),
            self.latest("v_cust_info_backup"),
            self.card_master,
            PARAMS.cutoff,
            PARAMS.data_ds,
        )

    @cached_property
    def staged_pool(self) -> DataFrame:
        return stage(self.pool, "pool")

    def demographic_of(self, pool: DataFrame) -> DataFrame:
        return demographic_features(
            pool, self.saving, self.view("v_branch"), self.latest("v_loan"), PARAMS.cutoff
        )

    def portfolio_of(self, pool: DataFrame) -> DataFrame:
        return portfolio_features(pool, self.saving)

    def income_of(self, pool: DataFrame) -> DataFrame:
        return income_features(pool, self.saving, self.trx, *self.income_range)

    def ratios_of(self, pool: DataFrame) -> DataFrame:
        return ratio_features(pool, self.saving, self.trx, *self.ratio_range)

    @cached_property
    def marts(self) -> tuple[DataFrame, ...]:
        """The inputs of the dataset. What several of them read is written once: the account
        snapshot, the pool, and the demographic features, which are needed for the numbering
        as well."""
        once = Bank(self.spark, self.sf_dir)
        once.saving = stage(self.saving, "saving")
        pool = once.staged_pool
        return (
            pool,
            stage(once.demographic_of(pool), "demographic"),
            once.portfolio_of(pool),
            once.income_of(pool),
            once.ratios_of(pool),
        )

    @cached_property
    def dataset(self) -> DataFrame:
        return inference_dataset(*self.marts, PARAMS.ds)

    @cached_property
    def staged_dataset(self) -> DataFrame:
        return stage(self.dataset, "dataset")
