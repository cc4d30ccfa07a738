"""Token-id output: best-fit-decreasing packing inside each task, the rows left open there packed once more across
tasks, written as id matrices with segment borders."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, steps
from riskframe.llm.word_tokens import word_ids
from riskframe.session import materialise

CAPACITY, END_ID, PAD_ID = 4096, 1, 0
#: Tokens that a task gathers before it packs them; a longer document is a group of its own.
GROUP_TOKENS = 4_000_000
#: A row of the first pass with more than this share of its capacity unused is packed again with those of other groups.
OPEN_SHARE = 1 / 256


class OpenRows:
    """Open sequences by the room they have left; a segment tree over the rooms finds the smallest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.held = [0] * (2 * self.leaves)  # open sequences below each node
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._count(room, 1)

    def _count(self, room: int, n: int) -> None:
        node = self.leaves + room
        while node:
            self.held[node] += n
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Room and number of an open sequence with the least room of at least ``length``."""
        node, held = self.leaves + length, self.held
        while not held[node]:
            while node & 1:  # a right child: what lies further right is above
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if held[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The pieces of each sequence, by their place in ``lengths``."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rows, open_ = [], OpenRows(capacity)
    for i in order:
        found = open_.take(lengths[i])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        if room > lengths[i]:
            open_.add(room - lengths[i], row)
    return rows


def packed_rows(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, pad_id: int = PAD_ID) -> DataFrame:
    """One row of ids for each sequence, packed from ``docs`` (doc_id, text).

    sequence_id: any numbers, one for each row. input_ids, position_ids: ``capacity`` little-endian int32 each; behind the
    last segment ids are ``pad_id``, positions 0. Positions count from 0 in each segment. cu_seqlens: the borders of the
    segments, from 0. doc_ids, starts: document and first token of each segment. A document is its ids and ``end_id``;
    one longer than ``capacity`` is cut into pieces that follow each other without loss. Null and empty texts are one
    token; null ids stay null; repeated rows are written as often as they come; an empty table gives no rows.

    A task packs what it gathers (GROUP_TOKENS), so that memory is bounded and a lost task is simply run again. Rows that
    stay open there (OPEN_SHARE) are dealt to as many tasks as their tokens need and packed with those of other groups, so
    that the number of rows hardly depends on partitions. Texts are tokenised once; the first pass is written.
    """
    kind = dict(docs.dtypes)["doc_id"]
    small_batches(docs.sparkSession)
    closed = f"sequence_id bigint, input_ids binary, cu_seqlens array<int>, doc_ids array<{kind}>, starts array<bigint>"

    def pack_documents(batches):
        ids_of, rows = word_ids(path), _Numbered(0, capacity, pad_id)
        held, tokens = [], 0
        for step in steps(batches, "text"):
            rows.kind = step.schema.field("doc_id").type
            for doc_id, ids in zip(step.column("doc_id").to_pylist(), ids_of(step.column("text").to_pylist())):
                ids = np.append(np.frombuffer(ids, "<i4"), np.int32(end_id))
                held += [(doc_id, at, ids[at:at + capacity]) for at in range(0, len(ids), capacity)]
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    yield from rows.of(held, keep_open=True)
                    held, tokens = [], 0
        yield from rows.of(held, keep_open=True)

    def pack_open(batches):
        rows, held, tokens = _Numbered(1 << 62, capacity, pad_id), [], 0
        for batch in batches:
            rows.kind = batch.schema.field("doc_ids").type.value_type
            for ids, borders, doc_ids, starts in zip(*(column.to_pylist() for column in batch.columns)):
                ids = np.frombuffer(ids, "<i4")
                held += [(d, at, ids[a:b]) for d, at, a, b in zip(doc_ids, starts, borders, borders[1:])]
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    yield from rows.of(held)
                    held, tokens = [], 0
        yield from rows.of(held)

    first = materialise(docs.select("doc_id", "text").mapInArrow(pack_documents, closed + ", open_ids binary"), "first-rows")
    left = first.where(F.col("open_ids").isNotNull())  # input_ids are not read for these, nor open_ids for the others
    tokens = left.agg(F.sum(F.element_at("cu_seqlens", -1).cast("long"))).first()[0] or 0
    dealt = left.repartition(-(-tokens // GROUP_TOKENS) or 1, "sequence_id").select("open_ids", "cu_seqlens", "doc_ids", "starts")
    done = first.where(F.col("input_ids").isNotNull()).drop("open_ids").unionByName(dealt.mapInArrow(pack_open, closed))

    @F.arrow_udf("binary")
    def positions(borders: pa.Array) -> pa.Array:
        return pa.array([_positions(row, capacity) for row in borders.to_pylist()], pa.binary())

    return done.select("sequence_id", "input_ids", positions("cu_seqlens").alias("position_ids"), "cu_seqlens", "doc_ids", "starts")


def _positions(borders: list[int], capacity: int) -> bytes:
    """Positions that start anew at each border, then zeros."""
    row = np.zeros(capacity, "<i4")
    filled = borders[-1]
    row[:filled] = np.arange(filled) - np.repeat(borders[:-1], np.diff(borders))
    return row.tobytes()


class _Numbered:
    """Packs groups of pieces (doc_id, start, ids) of a task into batches of rows with numbers of their own."""

    def __init__(self, first: int, capacity: int, pad_id: int):
        self.next = first | TaskContext.get().partitionId() << 36
        self.capacity, self.pad_id, self.kind = capacity, pad_id, None

    def of(self, held: list[tuple], keep_open: bool = False):
        """The rows of one group, 256 at a time; with ``keep_open`` those with much room give ``open_ids`` instead."""
        packed = best_fit_decreasing([len(ids) for _, _, ids in held], self.capacity)
        for at in range(0, len(packed), 256):
            full, open_, borders = [], [], []
            for row in packed[at:at + 256]:
                ids = np.concatenate([held[i][2] for i in row])
                borders.append(np.cumsum([0] + [len(held[i][2]) for i in row]).tolist())
                is_open = keep_open and self.capacity - len(ids) > self.capacity * OPEN_SHARE
                open_.append(ids.tobytes() if is_open else None)
                padded = np.full(self.capacity, self.pad_id, "<i4")
                padded[:len(ids)] = ids
                full.append(None if is_open else padded.tobytes())
            some = packed[at:at + 256]
            columns = {
                "sequence_id": pa.array(range(self.next, self.next + len(some)), pa.int64()),
                "input_ids": pa.array(full, pa.binary()),
                "cu_seqlens": pa.array(borders, pa.list_(pa.int32())),
                "doc_ids": pa.array([[held[i][0] for i in row] for row in some], pa.list_(self.kind)),
                "starts": pa.array([[held[i][1] for i in row] for row in some], pa.list_(pa.int64())),
            }
            if keep_open:
                columns["open_ids"] = pa.array(open_, pa.binary())
            self.next += len(some)
            yield pa.RecordBatch.from_pydict(columns)


def write_rows(docs: DataFrame, path: str, out: str, **options) -> None:
    """Writes the packed rows as Parquet; a task's files appear only when it ends, so a lost task leaves nothing."""
    packed_rows(docs, path, **options).write.parquet(out)
