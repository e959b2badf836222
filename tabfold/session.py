"""Session helpers: the shared scratch folder and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A private temporary folder is used only by a local master that names none.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="tabfold-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def written(df: DataFrame, stem: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written rows."""
    path = fresh_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written rows.

    Rows chosen by position or by a random draw must not be drawn again when an
    executor is lost; a reliable checkpoint keeps them, a cache would not.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cpus: int | str = 8, name: str = "tabfold") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
