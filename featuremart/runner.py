"""Run one job on catalog tables: choose snapshots, build the result, replace its partition.

    python -m featuremart.runner portfolio --date 2023-03-06
    python -m featuremart.runner scores --date 2023-03-06 --model models.trees

Job names are the roles of the marts: card_master, pool, demographic, portfolio, income,
ratios, dataset, scores.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from featuremart.operators.buckets import Buckets, buckets_of
from featuremart.operators.model_dump import read_dump
from featuremart.operators.scoring import TreeModel, fitted_labels
from featuremart.operators.scratch import scratch_scope
from featuremart.operators.sinks import write_snapshot
from featuremart.operators.snapshots import (
    NoSnapshot,
    list_partitions,
    nearest_partition,
    snapshot,
)
from featuremart.params import RunParams
from featuremart.plans import income, ratios
from featuremart.plans.card_master import card_master
from featuremart.plans.customer_pool import customer_pool
from featuremart.plans.dataset import inference_dataset
from featuremart.plans.demographic import demographic_features
from featuremart.plans.portfolio import portfolio_features
from featuremart.plans.scores import model_scores
from featuremart.session import build_session
from featuremart.sources.catalog import MART_TABLES, read, table_name

# Clock of the bank; the day of a run and the stamp on written rows follow it.
BANK_TIME = ZoneInfo("Asia/Jakarta")

# Marts that have to hold the snapshot of the run before the dataset is assembled.
FEATURE_MARTS = ("demographic", "portfolio", "income", "ratios")
# What the dataset joins by user; made with buckets, so that it lies ready for that.
JOINED_MARTS = ("pool", *FEATURE_MARTS)
JOIN_KEY = "user_id"


class Run:
    """The inputs of one run date, each reduced to the snapshot the jobs use."""

    def __init__(
        self, spark: SparkSession, run_date: date, names: Mapping[str, str] | None = None
    ):
        self.spark = spark
        self.params = RunParams(run_date)
        self.names = dict(names or {})

    def whole(self, role: str) -> DataFrame:
        return read(self.spark, role, self.names)

    def latest(self, role: str, upto: str | None = None) -> DataFrame:
        """The newest snapshot at or before the run's, so a repeated run reads what it read."""
        name = table_name(role, self.names)
        return snapshot(
            self.whole(role), nearest_partition(self.spark, name, upto or self.params.ds)
        )

    def own(self, role: str) -> DataFrame:
        """The snapshot of this run."""
        self.require((role,))
        return snapshot(self.whole(role), self.params.ds)

    def saving(self) -> DataFrame:
        name = table_name("saving", self.names)
        return snapshot(
            self.whole("saving"), nearest_partition(self.spark, name, self.params.data_ds)
        )

    def has(self, role: str, ds: str) -> bool:
        """Whether a mart holds snapshot ``ds``; only the catalog is asked."""
        name = table_name(role, self.names)
        if not self.spark.catalog.tableExists(name):
            return False
        return any(found["ds"] == ds for found in list_partitions(self.spark, name) or ())

    def bucketed(self, roles: tuple[str, ...]) -> bool:
        """Whether all these marts are bucketed by the user, and so hold clean ids."""
        found = [buckets_of(self.spark, table_name(role, self.names)) for role in roles]
        return all(buckets is not None and buckets.column == JOIN_KEY for buckets in found)

    def require(self, roles: tuple[str, ...]) -> None:
        missing = [role for role in roles if not self.has(role, self.params.ds)]
        if missing:
            raise NoSnapshot(f"no snapshot {self.params.ds} yet in: {', '.join(missing)}")


def _card_master(run: Run) -> DataFrame:
    return card_master(
        run.latest("credit_info"), run.latest("demography_info"), run.whole("cust_info"),
        run.whole("crm"), run.params.card_cutoff,
    )


def _pool(run: Run) -> DataFrame:
    return customer_pool(
        run.saving(), run.whole("cust_info"), run.latest("cust_info_backup"),
        run.latest("card_master"), run.params.cutoff, run.params.data_ds,
    )


def _demographic(run: Run, **options) -> DataFrame:
    return demographic_features(
        run.latest("pool"), run.saving(), run.whole("branch"), run.latest("loan"),
        run.params.cutoff, **options,
    )


def _portfolio(run: Run) -> DataFrame:
    return portfolio_features(run.latest("pool"), run.saving())


def _income(run: Run) -> DataFrame:
    start = run.params.days_before(income.WINDOW_DAYS)
    return income.income_features(
        run.latest("pool"), run.saving(), run.whole("trx"), start, run.params.data_ds
    )


def _ratios(run: Run) -> DataFrame:
    start = run.params.days_before(ratios.WINDOW_DAYS)
    return ratios.ratio_features(
        run.latest("pool"), run.saving(), run.whole("trx"), start, run.params.data_ds
    )


def _dataset(run: Run) -> DataFrame:
    run.require(JOINED_MARTS)
    return inference_dataset(
        *[run.own(role) for role in JOINED_MARTS],
        run.params.ds,
        clean_ids=run.bucketed(JOINED_MARTS),
    )


JOBS: dict[str, Callable[..., DataFrame]] = {
    "card_master": _card_master,
    "pool": _pool,
    "demographic": _demographic,
    "portfolio": _portfolio,
    "income": _income,
    "ratios": _ratios,
    "dataset": _dataset,
}


def run_job(
    spark: SparkSession,
    job: str,
    run_date: date,
    names: Mapping[str, str] | None = None,
    model: TreeModel | None = None,
    labels: DataFrame | None = None,
    force: bool = False,
    modified: datetime | None = None,
    buckets: int | None = None,
    **options,
) -> bool:
    """Build one mart and replace its snapshot. Tell whether anything was written.

    All jobs but the card holder master do nothing except on run days, unless forced.
    What is staged on the way is deleted at the end. A mart that the dataset joins is made with
    ``buckets`` buckets (by default as many as a shuffle has partitions); one that is there stays as it is.
    ``options`` go to the scores (``unseen``, ``medians``, ``batch_size``, ``threshold``) or to the
    demographic features (``exclude_regions``).
    """
    with scratch_scope(spark):
        return _run_job(spark, job, run_date, names, model, labels, force, modified, buckets, options)


def _run_job(spark, job, run_date, names, model, labels, force, modified, buckets, options) -> bool:
    run = Run(spark, run_date, names)
    if job != "card_master" and not (run.params.is_run_day or force):
        return False
    table = table_name(job, names)
    modified = modified or datetime.now(BANK_TIME)
    if job == "scores":
        if model is None or labels is None:
            raise ValueError("scores need a model and the labels its encoders were fitted on")
        result = model_scores(run.own("dataset"), model, labels, **options)
        return write_snapshot(result, table, run.params.ds, modified)
    ds = run.params.card_ds if job == "card_master" else run.params.ds
    made = Buckets(JOIN_KEY, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return write_snapshot(
        JOBS[job](run, **options),
        table,
        ds,
        modified,
        skip_if_empty=job == "card_master",
        # The dataset comes out sorted by id.
        rebalance=job != "dataset",
        buckets=made if job in JOINED_MARTS else None,
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=list(MART_TABLES))
    parser.add_argument(
        "--date", type=date.fromisoformat, default=datetime.now(BANK_TIME).date()
    )
    model = parser.add_mutually_exclusive_group()
    model.add_argument("--model", help="node table of the model")
    model.add_argument("--model-dump", help="JSON dump of the model's trees")
    parser.add_argument("--base-score", type=float, default=0.5, help="of the model, which no dump holds")
    parser.add_argument("--labels", help="label table of the encoders")
    parser.add_argument("--labels-version", help="version of the label table, the greatest if not given")
    parser.add_argument("--unseen", choices=["error", "null", "keep"], default="error")
    parser.add_argument("--medians", choices=["batch", "global"], default="batch")
    parser.add_argument("--exclude-region", action="append", default=[])
    parser.add_argument("--buckets", type=int, help="buckets of a mart that is not there yet")
    parser.add_argument("--force", action="store_true", help="run on any day")
    args = parser.parse_args()
    spark = build_session(app=f"featuremart {args.job}")
    options = {}
    if args.job == "scores":
        options = {"unseen": args.unseen, "medians": args.medians}
        if args.model_dump:
            trees = read_dump(spark, args.model_dump)
            options["model"] = TreeModel.from_table(trees, args.base_score, single=True)
        elif args.model:
            options["model"] = TreeModel.from_table(spark.read.table(args.model), args.base_score)
    elif args.job == "demographic" and args.exclude_region:
        options = {"exclude_regions": args.exclude_region}
    written = run_job(
        spark,
        args.job,
        args.date,
        labels=fitted_labels(spark.read.table(args.labels), args.labels_version) if args.labels else None,
        force=args.force,
        buckets=args.buckets,
        **options,
    )
    print(f"{args.job} {args.date}: {'written' if written else 'nothing to write'}")


if __name__ == "__main__":
    main()
