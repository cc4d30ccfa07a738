"""SimHash near-dedup: Golay keys of fingerprint segments, a join on them, verification and connected components.

A fingerprint has segments of 22, 21 and 21 bits. Fingerprints that differ in at most two bits have a segment in which
they agree; its value, together with the Golay codewords near the next segment, gives at most 18 keys each, one of them
common. Keys of few fingerprints are joined and verified. A key of many would emit their square: there each
fingerprint lists the 65 words within one bit instead, and those that list a common word (never more than 65) are linked
to the smallest. Both ways find every component.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import map_steps
from riskframe.llm.components import components
from riskframe.llm.exact_dedup import one_of_each
from riskframe.llm.golay import near_codewords
from riskframe.session import materialise

SHINGLE, SEED, BITS_APART = 3, 42, 2
#: Keys of more fingerprints than this are linked by neighbouring words.
JOINED_MOST = 32
_SEGMENTS = ((42, 22), (21, 21), (0, 21))


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))), len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, text_hash and fp (signed 64 bits) of every row; written."""

    def make():
        return lambda texts: [pa.array([fingerprint(t) for t in texts], pa.int64())]

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = map_steps(rows, "text", make, "fp bigint").withColumn("row_id", F.monotonically_increasing_id())
    return materialise(rows, "fingerprints")


def _keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (place of the fingerprint, key)."""
    value = prints.view(np.uint64)
    cut = [(value >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in _SEGMENTS]
    where, keys = [], []
    for i in range(3):
        near, many = near_codewords(cut[(i + 1) % 3])
        use = np.arange(near.shape[1]) < many[:, None]
        head = (np.int64(i) << 34) | (cut[i] << 12)
        where.append(np.nonzero(use)[0])
        keys.append((head[:, None] | near)[use])
    return np.concatenate(where), np.concatenate(keys)


def _golay_keys(batches):
    for batch in batches:
        fp = batch.column("fp")
        at, keys = _keys(fp.to_numpy())
        for i in range(0, len(at), 1 << 17):
            part = slice(i, i + (1 << 17))
            yield pa.RecordBatch.from_arrays([fp.take(pa.array(at[part])), pa.array(keys[part])], names=["fp", "key"])


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, at most two bits apart, that join all such into components."""
    keys = prints.mapInArrow(_golay_keys, "fp bigint, key bigint")
    sizes = materialise(keys.groupBy("key").count().filter("count > 1"), "key-sizes")
    shared = materialise(keys.join(sizes, "key").select("key", "fp", (F.col("count") > JOINED_MOST).alias("crowded")), "keys")
    few = shared.filter("not crowded").select("key", F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS_APART
    pairs = few.join(few.withColumnRenamed("a", "b"), "key").filter((F.col("a") < F.col("b")) & near).select("a", "b")
    crowded = shared.filter("crowded").select("fp").distinct()
    flip = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    around = crowded.select("fp", F.explode(F.concat(F.array("fp"), flip)).alias("word"))
    met = around.groupBy("word").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).filter("size(all) > 1")
    stars = met.select("a", F.explode("all").alias("b")).filter("a <> b")
    return pairs.union(stars).distinct()


def near_dedup(docs: DataFrame) -> DataFrame:
    """For every row of ``docs``: doc_id, fingerprint, component_id, kept, text_hash.

    component_id is the smallest doc_id of all rows whose fingerprints are reachable by steps of at most two bits; ids
    that are null count for nothing, a component of such alone has null. Of each component the row with the smallest
    doc_id is kept (null ids last; the first of repeated rows). Null texts count as empty; texts without words have
    fingerprint 0 and link like any other. An empty table gives no rows; other columns are ignored.
    """
    rows = fingerprints(docs)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row_id").alias("row"))
    prints = materialise(rows.groupBy("fp").agg(F.min(first).alias("first")), "prints")
    roots = materialise(components(links(prints.select("fp"))), "roots")
    held = prints.join(roots, prints["fp"] == roots["node"], "left")
    held = held.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = materialise(held.groupBy("root").agg(F.min("first").alias("least")), "least-rows")
    of = materialise(held.join(least, "root").select("fp", "least"), "component-rows")
    out = rows.join(of, "fp")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.id").alias("component_id"),
        (F.col("row_id") == F.col("least.row")).alias("kept"), "text_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component."""
    return one_of_each(docs, materialise(near_dedup(docs).select("doc_id", "text_hash", "kept"), "near-dedup"))
