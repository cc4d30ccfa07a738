"""Packing of tokenised documents into as few sequences as the length histogram allows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import map_steps, small
from riskframe.llm.packing_plan import plan
from riskframe.llm.word_tokens import word_ids
from riskframe.session import materialise

CAPACITY, END_ID = 4096, 1


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of ``docs``, and its place: the task that made it and its
    rank among that task's pieces of the same length. Written; ids are not kept, they follow from text and start."""

    def make():
        ids_of, part, seen = word_ids(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = end_id.to_bytes(4, "little")

        def step(texts):
            out = []
            for ids in ids_of(texts):
                ids += end
                rows = []
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    rows.append({"piece": piece, "start": at // 4, "length": len(cut) // 4, "ids_crc32": zlib.crc32(cut),
                                 "part": part, "rank": int(seen[len(cut) // 4])})
                    seen[len(cut) // 4] += 1
                out.append(rows)
            return [pa.array(out, pa.list_(pa.struct([
                ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                ("part", pa.int32()), ("rank", pa.int64())])))]

        return step

    rows = map_steps(docs.select("doc_id", "text"), "text", make,
                     "p array<struct<piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint>>")
    return materialise(rows.select("doc_id", F.inline("p")), "pieces")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut, so a null or empty text is one
    piece of length 1. Only the histogram reaches the driver. Pieces of a length are numbered by task and by rank in
    the task, and the plan says which numbers a sequence holds; no piece is moved for it but by (task, length).
    Repeated rows are packed as often as they come; an empty table gives no rows.
    """
    cut = pieces(docs, path, capacity, end_id)
    by_task = materialise(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    packed = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    base = small(materialise(base, "bases"))  # it grows with tasks and lengths, so it is counted first
    ranked = cut.join(base, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("base"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"

    def place(batches):
        for batch in batches:
            sequence, offset = packed.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            arrays = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:5], "sequence_id", "offset"])

    schema = schema.replace("doc_id bigint", f"doc_id {dict(cut.dtypes)['doc_id']}")
    return ranked.mapInArrow(place, schema)
