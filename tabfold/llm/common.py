"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabfold.session import shared_dir

# Fixed value: a word of the whole-text contracts, as a regular expression over bytes
# (Python) and over characters (Spark SQL, DuckDB); the same words either way.
WORD_BYTES = rb"[^\x20\x09-\x0D]+"
WORD_TEXT = r"[^\x20\x09-\x0D]+"

# Bytes of a batch of rows on its way to a Python worker, and the session setting that says so.
BATCH_BYTES, BATCH_SETTING = 1 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character."""
    return F.translate(text, UPPER, LOWER)


def settle(df: DataFrame, stem: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written rows.

    Later reads take the columns they need, and a lost executor costs a re-read
    and not a new run of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let rows go to Python workers by the megabyte, unless the session names another size.

    With batches of Spark's default, tens of megabytes, an executor's JVM keeps much of
    what it has freed beside its heap, more from stage to stage, and each worker holds
    a batch whole. The setting stays with the session, as a query runs after it is made.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_part(remainder_of: int, value: Column) -> Column:
    """``crc32`` of a value's text, modulo: the folds of the labelled queries."""
    return F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(remainder_of))


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under names that clash with no other: c0, c1, ..."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()


@lru_cache(maxsize=1)
def _trim():
    """The C library's ``malloc_trim``; other libraries than glibc have none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def release_unused() -> None:
    """Give back to the system what Arrow, NumPy and native code have freed."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def batches_by_bytes(
    batches: Iterable[pa.RecordBatch], column: int, limit: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes in one column, or a single longer row.

    Python workers live on from task to task, so what has been freed goes back to
    the system after every batch.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        release_unused()
