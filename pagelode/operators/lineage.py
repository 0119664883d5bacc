"""Lineage cut through the cluster's shared checkpoint folder, so that lost executors cost a re-read and not a re-run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> None:
    """Uses the folder that spark.checkpoint.dir names, or that was set before, or the one given here.

    A session of one machine without any gets a folder beside its tables (spark.sql.warehouse.dir), removed when it ends; on a
    cluster that is an error, as no folder can be guessed that all executors share."""
    sc = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints-{uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    sc.setCheckpointDir(folder)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting key is value within the block, and what it was after it."""
    kept = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, kept)


def cut(df: DataFrame) -> DataFrame:
    """df as written to the checkpoint folder: its rows and its partitions stay the same however often it is read.

    The shuffle files that its rows came through are removed at once, as nothing reads them again; else they stay on every disk until the
    driver happens to collect its garbage."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    with setting(spark, CLEANUP, "true"):
        return df.select("*").checkpoint(eager=True)  # the select makes a plan of its own: that of df may run again elsewhere and keeps its files


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables from cut that nothing will read again: what was made of them must have been cut itself."""
    for df in tables:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
