"""Running a stream over what is there, into a table that a restart does not change.

A run reads the files that have come since the last one and stops. Results that are
final are appended to a folder by Spark's file sink, whose log names the files of each
batch, so a batch that is run again adds nothing. Results that are not final are read
from the state that the checkpoint keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Rows of a key are joined to sessions in each task before they are sent to the one that keeps it.
SETTINGS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """``SETTINGS`` for a query that starts within the block, as it copies the session's."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def file_stream(spark: SparkSession, path: str, schema: StructType, *, files_at_once: int | None = None) -> DataFrame:
    """Rows of Parquet files as they come, in the order of their modification times.

    ``path`` is a folder, a pattern, or one file. ``schema`` is declared, as a stream
    must not change its columns with a file.
    """
    reader = spark.readStream.schema(schema)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    # As a pattern, one file is as good as a folder.
    return reader.parquet(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")


@dataclass(frozen=True)
class Run:
    """``rows`` read and ``late`` rows dropped in ``batches``; ``output`` and ``checkpoint`` are folders."""

    output: str
    checkpoint: str
    batches: int
    rows: int
    late: int

    def state(self, spark: SparkSession) -> DataFrame:
        """Key and value of what is not final yet."""
        return spark.read.format("statestore").load(self.checkpoint)


def run_available(stream: DataFrame, folder: str) -> Run:
    """Run ``stream`` over the rows that are there; ``folder`` holds its output and checkpoint and names the stream."""
    output, checkpoint = f"{folder}/output", f"{folder}/checkpoint"
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with settings(stream.sparkSession):
        query = writer.start()
    # Progress is kept for the last batches only, so it is read while they run.
    seen: dict[int, dict] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        seen |= {p["batchId"]: p for p in query.recentProgress}
    dropped = sum(o["numRowsDroppedByWatermark"] for p in seen.values() for o in p["stateOperators"])
    return Run(output, checkpoint, len(seen), sum(p["numInputRows"] for p in seen.values()), dropped)
