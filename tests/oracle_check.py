"""Compare registered queries with their oracles in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=0) or a == b
    return a == b


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and an oracle; an empty list when there is none."""
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} against {sorted(relation.columns)}"]
    problems = []
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for name, kind in df.dtypes:
        if SQL_TYPES.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    ours = [tuple(row[name] for name in names) for row in df.collect()]
    order = [relation.columns.index(name) for name in names]
    theirs = [tuple(row[i] for i in order) for row in relation.fetchall()]
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if Counter(ours) != Counter(theirs):
        left, right = Counter(ours) - Counter(theirs), Counter(theirs) - Counter(ours)
        a = sorted(left.elements(), key=repr)
        b = sorted(right.elements(), key=repr)
        if len(a) == len(b) and all(
            all(map(_same, x, y)) for x, y in zip(a, b, strict=True)
        ):
            problems.append(f"{len(a)} rows differ in the last digits: {a[0]} {b[0]}")
        else:
            problems.append(f"{len(a)} and {len(b)} rows differ: {a[:2]} {b[:2]}")
    if not ours:
        problems.append("no rows")
    return problems


def main() -> int:
    from featuremart.queries import ORACLES, QUERIES
    from featuremart.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                       "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems,
              sep="  ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
