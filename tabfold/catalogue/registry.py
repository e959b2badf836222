"""Registry of queries and the SQL fragments that several oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# lineitem has no single key column.
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
LINE_KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"


def registered(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def bucket_sql(key: str, buckets: int, draw: int = 0) -> str:
    """DuckDB text of ``hash_bucket``."""
    return f"(('0x' || substr(md5({key}), {draw * 8 + 1}, 8))::bigint % {buckets})"


LINE_TRAIN_SQL = f"{bucket_sql(LINE_KEY_SQL, 10)} < 7"
LINE_TEST_SQL = f"{bucket_sql(LINE_KEY_SQL, 10)} >= 7"
LINE_FOLD_SQL = bucket_sql(LINE_KEY_SQL, 2, draw=1)
