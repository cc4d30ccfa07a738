"""Micro-batches written to several tables at once, each batch once.

A batch goes to a folder of its own in each table, and a small file then names it as the last one. A batch that is tried
again overwrites its own folders, and readers look at batches up to that file's only, so that a replayed batch writes
nothing twice and half-written ones are never seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.sources import versions

_LAST = "_last_batch"
Split = Callable[[DataFrame], dict[str, DataFrame]]


def write_batch(parts: dict[str, DataFrame], path: str, batch: int) -> None:
    """Write each part of batch number ``batch`` below its name, then commit them together."""
    spark = next(iter(parts.values())).sparkSession
    for name, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
    versions.swap(spark, path, str(max(batch, _last(spark, path))), _LAST)


def _last(spark: SparkSession, path: str) -> int:
    return int(versions.pointed(spark, path, _LAST) or -1)


def read_routed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All committed rows of one table, with the number of their ``batch``."""
    rows = spark.read.parquet(f"{path}/{name}")
    return rows.where(F.col("batch") <= _last(spark, path))


def start_routing(stream: DataFrame, split: Split, path: str, checkpoint: str, mode: str = "append", **trigger) -> StreamingQuery:
    """Run ``split`` on every micro-batch and write the tables it returns; by default everything available, then stop.

    The batch is kept while it is written, so that the stream is read once; lost parts of it are read again.
    """
    def route(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            write_batch(split(kept), path, number)
        finally:
            kept.unpersist()

    return (
        stream.writeStream.foreachBatch(route).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
