"""Comparing all rows of a group in tiles of bounded size.

Rows are dealt into tiles of about ``TILE`` rows by a hash. Each task gets two
tiles that have to be compared, or one with itself, so its memory is bounded
whatever the size of a group, and a group that holds most rows is spread over as
many tasks as it has pairs of tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TILE = 4096


def tile_of(key: Column, n_tiles: Column) -> Column:
    return F.pmod(F.xxhash64(key), n_tiles).cast("int")


def pairs_of_tiles(rows: DataFrame, own: Column, first: Column, last: Column) -> DataFrame:
    """Copy each row to the tasks of its tile.

    ``own`` is the number of the row's tile, ``first`` to ``last`` those that it
    has to be compared with, itself included. The columns ``low`` and ``high`` name
    the task; ``is_left`` tells whether the row belongs to the lower tile.
    """
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(first, last)))
        .withColumn("low", F.least("_own", "_other"))
        .withColumn("high", F.greatest("_own", "_other"))
        .withColumn("is_left", F.col("_own") <= F.col("_other"))
        .drop("_own", "_other")
    )
