"""Run registered queries next to their check SQL: python tests/compare.py sf_dir [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if hasattr(v, "tolist"):
        return v.tolist()
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        [tuple(plain(r[i]) for i in order) for r in rows], key=lambda r: [(x is None, str(x)) for x in r]
    )


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(con, df, sql: str) -> list[str]:
    """Differences between a DataFrame and the check SQL; empty when they agree."""
    got = normal(df.columns, df.collect())
    rel = con.sql(sql)
    want = normal(rel.columns, rel.fetchall())
    problems = []
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            problems.append(f"type {name}: {kind} vs {kinds[name]}")
    if len(got[1]) != len(want[1]):
        problems.append(f"rows {len(got[1])} != {len(want[1])}")
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0][0]} != {bad[0][1]}")
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    directory = sys.argv[1]
    con = connect(directory)
    checks = entry.oracle_sql()
    for key, run in entry.queries().items():
        if len(sys.argv) > 2 and key not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = run(session, directory)
            if key in checks:
                problems = compare(con, df, checks[key])
                verdict = "OK" if not problems else "DIFF " + " | ".join(problems)
            else:
                verdict = f"rows {len(df.collect())}"
        except Exception as exc:  # noqa: BLE001
            verdict = f"ERROR {type(exc).__name__}: {str(exc)[:1500]}"
        print(f"{key:28s} {time.time() - started:6.2f}s {verdict}", flush=True)
