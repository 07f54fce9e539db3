"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Every query is run to its end into Spark's no-op sink. One small query runs first, untimed, so that
starting the session is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from featuremart.queries import QUERIES  # noqa: E402
from featuremart.session import build_session  # noqa: E402

HEADLINE = (
    "first_open_date",
    "cleanse_table",
    "ledger_range",
    "measure_matrix",
    "first_per_key",
    "global_row_id",
    "median_by_batch",
    "score_trees",
    "score_map_in_pandas",
    "write_partition_idempotent",
    "job_card_master",
    "job_customer_pool",
    "job_demographic",
    "job_portfolio",
    "job_income",
    "job_ratios",
    "job_dataset",
    "job_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
