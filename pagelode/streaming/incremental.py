"""Enrichment that can stop and go on: pages arrive in files, each is worked once, and the master follows the whole state.

A richer late row can displace an earlier winner, so the master is always made from all rows of the stage, not patched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pagelode.operators.keyed import not_done
from pagelode.sources.stages import append_stage, read_stage


def enrich_new(pages: DataFrame, done: DataFrame, key: str, enrich: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(enriched rows, keys attempted) of the pages whose key is not done; failures count as attempted."""
    todo = not_done(pages, done, key)
    return enrich(todo), todo.select(key).distinct()


def refresh(spark: SparkSession, pages: DataFrame, state: str, key: str, enrich: Callable[[DataFrame], DataFrame], row_schema: str, key_schema: str) -> DataFrame:
    """One incremental run over the stage tables under state; gives all enriched rows so far.

    Keys that have rows count as done too, so a run that died between its two writes doubles nothing when it is repeated."""
    done = read_stage(spark, f"{state}/attempted", key_schema).select(key).unionByName(read_stage(spark, f"{state}/rows", row_schema).select(key))
    rows, tried = enrich_new(pages, done, key, enrich)
    append_stage(rows, f"{state}/rows")
    append_stage(tried, f"{state}/attempted")
    return read_stage(spark, f"{state}/rows", row_schema)


def stream_rows(spark: SparkSession, source: str, schema: StructType | str, state: str, enrich: Callable[[DataFrame], DataFrame], key: str):
    """Starts a stream from a folder of Parquet files: every file's new keys are enriched and appended to state/rows.

    All rows of a key that arrive in one batch are worked together. A replayed batch adds nothing twice: keys written before are left
    out, and the stream's own checkpoint keeps the files apart.
    Call processAllAvailable() or awaitTermination() on the query that is returned."""

    def each(batch: DataFrame, epoch: int) -> None:
        rows = enrich(batch)
        seen = read_stage(batch.sparkSession, f"{state}/rows", rows.schema)
        append_stage(not_done(rows, seen, key), f"{state}/rows")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
