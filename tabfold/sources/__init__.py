from tabfold.sources.bucketed import bucketed_join, bucketed_table, buckets_for
from tabfold.sources.delimited import read_csv, require_not_null
from tabfold.sources.named import load_table, register, sql
from tabfold.sources.schemas import CUSTOMER_FEATURES, CUSTOMERS, FLIGHTS

__all__ = [
    "CUSTOMERS",
    "CUSTOMER_FEATURES",
    "FLIGHTS",
    "bucketed_join",
    "bucketed_table",
    "buckets_for",
    "load_table",
    "read_csv",
    "register",
    "require_not_null",
    "sql",
]
