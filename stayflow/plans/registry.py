"""Registry of queries: each runs over whole tables and may carry its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return add


def rounded(df: DataFrame, digits: int = 6, **special: int | None) -> DataFrame:
    """Round every double column for comparison; ``special`` overrides (None keeps it)."""
    out = []
    for name, kind in df.dtypes:
        d = special.get(name, digits)
        out.append(F.round(name, d).alias(name) if kind == "double" and d is not None else F.col(name))
    return df.select(*out)
