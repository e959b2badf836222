"""Keeping rows at hand for work that passes over them many times."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

# Rows that a task of an iterative fit passes over in well under a second.
ROWS_PER_PART = 50_000


@contextmanager
def held(df: DataFrame, *columns: str, rows_per_part: int | None = None) -> Iterator[DataFrame]:
    """The named columns, persisted for the time of the block.

    Nothing runs before the rows are first used, unless ``rows_per_part`` is given: then
    the rows are read and counted, and if the input has too few partitions for that many
    rows each (as unsplittable files give), they are dealt out to as many as it takes.
    There are never fewer than the input has. Blocks lost with an executor are recomputed
    from the source.
    """
    rows = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [rows]
    try:
        if rows_per_part is not None:
            wanted = -(-rows.count() // rows_per_part)
            if wanted > rows.rdd.getNumPartitions():
                dealt = rows.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(dealt)
                dealt.count()
                rows.unpersist()
                rows = dealt
        yield rows
    finally:
        for k in kept:
            k.unpersist()
