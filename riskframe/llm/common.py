"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import materialise

#: Text bytes that one step of a Python worker handles at once (a longer text is a step of its own).
STEP_BYTES = 1_000_000
#: Rows that Spark sends to a Python worker at once, unless the session says otherwise: texts may be long.
BATCH_ROWS = 1_000
#: Rows up to which a narrow table is broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 200_000
#: Code points up to which a text is drawn as a training example; scoring takes texts of any length.
EXAMPLE_CHARS = 100_000

#: ASCII letters and all bytes of other scripts stay, everything else becomes a space.
LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def letter_words(text: str) -> list[bytes]:
    """Lower-case words of letters, in UTF-8; digits and ASCII signs separate them."""
    return text.lower().encode("utf-8", "replace").translate(LETTERS).split()


def runs(items: list, size: int) -> Iterator[list]:
    """Consecutive parts of a list."""
    return (items[i:i + size] for i in range(0, len(items), size))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(key.cast("string")) % n


def steps(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most STEP_BYTES of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and size + n > STEP_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def small_batches(spark: SparkSession) -> None:
    """Lowers the rows of an Arrow batch to BATCH_ROWS where the session has left them at Spark's default."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(BATCH_ROWS))


def map_steps(df: DataFrame, column: str, make: Callable, schema: str) -> DataFrame:
    """``make()`` runs once per task and returns a function of one slice (see steps) that gives the new columns.

    The columns other than ``column`` pass through; ``schema`` names the new ones, as DDL, which replace any of their name.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    kept = [f for f in df.schema.fields if f.name != column and f.name not in out.names]

    def run(batches):
        each = make()
        for part in steps(batches, column):
            arrays = each(part.column(column).to_pylist())
            names = [f.name for f in kept] + [f.name for f in out.fields]
            yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + list(arrays), names=names)
        del each
        gc.collect()  # a worker that waits for its next task keeps no caches of this one

    small_batches(df.sparkSession)
    full = type(df.schema)(kept + out.fields)
    return df.mapInArrow(run, full)


def bounded_sample(df: DataFrame, rows: int, per: str | None = None, seed: int = 17) -> DataFrame:
    """About ``rows`` rows (of every value of ``per``), chosen by a hash of all columns; never above twice that.

    The thresholds come from counts; a stable hash makes a repeated task choose the same rows.
    """
    key = F.xxhash64(F.lit(seed), *df.columns)
    place = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    if per is None:
        total = df.count()
        return df.filter(place < rows / max(total, 1)).orderBy(key).limit(2 * rows)
    value, share, rank = unused(df, "__value"), unused(df, "__share"), unused(df, "__rank")
    counts = df.groupBy(F.col(per).alias(value)).agg((F.lit(float(rows)) / F.count("*")).alias(share))
    counts = small(materialise(counts, "strata"))
    drawn = df.withColumn(rank, place).join(counts, F.col(per).eqNullSafe(F.col(value))).filter(F.col(rank) < F.col(share))
    first = F.row_number().over(Window.partitionBy(per).orderBy(key))
    return drawn.withColumn(rank, first).filter(F.col(rank) <= 2 * rows).select(*df.columns)


def examples(docs: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """The texts of the ``chosen`` documents (doc_id, ...), at most ``rows`` of them, in an order that does not change.

    Repeated rows can't make it longer, nor can texts above EXAMPLE_CHARS, which are left out.
    """
    texts = docs.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= EXAMPLE_CHARS)
    joined = texts.join(F.broadcast(chosen), "doc_id").drop("doc_id")
    return joined.orderBy(F.xxhash64(*joined.columns)).limit(rows)


def small(df: DataFrame) -> DataFrame:
    """Marks a written narrow table for broadcast if its count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _names(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))


def drop_listed(docs: DataFrame, listed: DataFrame, once: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those in ``listed`` (doc_id, text_hash); of rows in ``once`` a single copy stays.

    A row is named by its id and a hash of its text. Both tables must be written ones.
    """
    names = docs.columns
    doc_id, text_hash = unused(docs, "__id"), unused(docs, "__hash")
    keyed = docs.withColumn(doc_id, F.col("doc_id")).withColumn(text_hash, F.xxhash64("text"))

    def same(other):
        return F.col(doc_id).eqNullSafe(other["_id"]) & (F.col(text_hash) == other["_hash"])

    gone = small(_names(listed))
    left = keyed.join(gone, same(gone), "left_anti")
    if once.isEmpty():
        return left.select(*names)
    again = small(_names(once))
    single = left.join(again, same(again), "left_anti")
    repeated = left.join(again, same(again), "left_semi").dropDuplicates([doc_id, text_hash])
    return single.unionByName(repeated).select(*names)
