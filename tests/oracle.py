"""Run registered queries against their SQL on one scale factor.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

from tablemint.workload import ORACLES, QUERIES
from tablemint.workload.registry import TABLES


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, Decimal):
        return repr(round(float(value), 9))
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return None
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        missing = sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows instead of {len(want)}; only here {extra}; only in SQL {missing}"
    if not got:
        return "both sides are empty"
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = session(), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    sys.exit(1 if failed else 0)
