"""Line dedup: a suffix array over line ids by distributed prefix doubling; repeated runs lose their later copies.

A suffix is a line of a document and all that follow. Level k ranks suffixes by their first 2**k lines; suffixes that no
other one equals so far drop out, since they can't be part of a repeated run. A run counts when it spans at least
MIN_CHARS characters or MIN_WORDS words. The suffixes that share their shortest such run lie together in the suffix order, as an interval whose
common prefix is that long; they are told by two overlapping ranks. All but the interval's first occurrence are deleted,
and overlapping intervals join up to the maximal repeated runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import BROADCAST_ROWS
from riskframe.session import materialise

#: Passages of over 50 words count, however short their words; so do 200 characters, for texts with few spaces.
MIN_CHARS, MIN_WORDS = 200, 51
_LAST, _WORD = (1 << 63) - 1, r"[^\x20\x09-\x0D]+"


def _key(docs: DataFrame) -> DataFrame:
    """d (the id, null ids last) and th (a hash of the text) name a document; repeated rows are one document."""
    return docs.withColumn("d", F.coalesce("doc_id", F.lit(_LAST))).withColumn("th", F.xxhash64("text"))


def suffixes(docs: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """d, th, line, a 128-bit line id (h1, h2), and n: the lines of the shortest run from here with min_chars characters,
    line breaks included, or min_words words; null where the document ends before both."""
    lines = _key(docs.select("doc_id", "text")).select(
        "d", "th", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line", "own"))
    lines = lines.select("d", "th", "line", F.xxhash64("own").alias("h1"), F.xxhash64(F.lit(7), "own").alias("h2"),
                         (F.length("own") + 1).alias("size"), F.regexp_count("own", F.lit(_WORD)).alias("words"))
    lines = lines.repartition("d", "th").groupBy("d", "th", "line").agg(*[F.first(c).alias(c) for c in ("h1", "h2", "size", "words")])
    of_doc = Window.partitionBy("d", "th").orderBy("line")
    lines = lines.withColumn("start", F.sum("size").over(of_doc) - F.col("size"))
    total = F.sum("size").over(Window.partitionBy("d", "th"))
    ahead = Window.partitionBy("d", "th").orderBy("start").rangeBetween(0, min_chars - 1)
    reach = F.when(total - F.col("start") >= min_chars, F.count("*").over(ahead)).cast("int")
    lines = lines.withColumn("n", reach).withColumn("told", F.sum("words").over(of_doc) - F.col("words"))
    by_words = Window.partitionBy("d", "th").orderBy("told")
    spoken = F.count("*").over(by_words.rangeBetween(0, min_words - 1))
    peers = F.col("line") - (F.rank().over(by_words) - 1)  # lines before this one with no word between
    all_words = F.sum("words").over(Window.partitionBy("d", "th"))
    reach_words = F.when(all_words - F.col("told") >= min_words, spoken - peers).cast("int")
    return lines.select("d", "th", "line", "h1", "h2", F.least("n", reach_words).alias("n"))


def _ranked(pairs: DataFrame, name: str) -> DataFrame:
    """(a, b, rank) for the pairs (a, b, many): rank is the number of suffixes with a smaller pair; written."""
    schema = "a bigint, b bigint, many bigint, part int, before bigint"

    def running(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            many = batch.column("many").to_numpy()
            before = seen + np.cumsum(many) - many
            seen += int(many.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(many), part, np.int32)), pa.array(before)],
                names=["a", "b", "many", "part", "before"])

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartitionByRange(parts, "a", "b").sortWithinPartitions("a", "b")
    held = materialise(dealt.mapInArrow(running, schema), name)
    # one row for each task: bounded by the number of shuffle partitions
    offsets = held.groupBy("part").agg(F.sum("many").alias("n"))
    offsets = offsets.withColumn("offset", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "offset")
    return held.join(F.broadcast(offsets), "part").select("a", "b", (F.col("before") + F.col("offset")).alias("rank"))


def _level(rows: DataFrame, k: int) -> DataFrame:
    """Suffixes (d, th, line, n, a, b) with a rank by (a, b), without those whose pair is their own; written."""
    many = rows.groupBy("a", "b").agg(F.count("*").alias("many")).filter("many > 1")
    ranks = materialise(_ranked(many, f"sums-{k}"), f"ranks-{k}")
    return materialise(rows.join(ranks, ["a", "b"]).select("d", "th", "line", "n", "rank"), f"level-{k}")


def _shifted(level: DataFrame) -> DataFrame:
    return level.select("d", "th", F.col("line").alias("other"), F.col("rank").alias("b"))


def later_copies(docs: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, line, n): starts and lengths of runs that occur before, in the order of doc_id and line."""
    rows = materialise(suffixes(docs, min_chars, min_words), "suffixes")
    level = _level(rows.select("d", "th", "line", "n", F.col("h1").alias("a"), F.col("h2").alias("b")), 0)
    copies, k = None, 0
    while True:
        width = 1 << k
        here = level.filter((F.col("n") >= width) & (F.col("n") < 2 * width)).select(
            "d", "th", "line", "n", F.col("rank").alias("a"), (F.col("line") + F.col("n") - width).alias("other"))
        runs = here.join(_shifted(level), ["d", "th", "other"]).select("d", "th", "line", "n", "a", "b")
        runs = materialise(runs, f"runs-{k}")
        place = F.struct("d", "th", "line")
        firsts = runs.groupBy("n", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("many"))
        firsts = materialise(firsts.filter("many > 1").drop("many"), f"intervals-{k}")
        found = runs.join(firsts, ["n", "a", "b"]).filter(place != F.col("first")).select("d", "th", "line", "n")
        copies = found if copies is None else copies.union(found)
        deepest = level.agg(F.max("n")).first()[0]
        if deepest is None or deepest < 2 * width:
            return copies
        pairs = level.withColumn("other", F.col("line") + width).join(_shifted(level), ["d", "th", "other"])
        k += 1
        level = _level(pairs.select("d", "th", "line", "n", F.col("rank").alias("a"), "b"), k)


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text, n_lines, n_deleted for every row of ``docs``: text without lines of runs that occur before.

    A repeated run of fewer than ``min_chars`` characters and fewer than ``min_words`` words stays.
    Lines are divided by line feeds and equal when identical. Order is by doc_id (null ids last), then line; earlier copies
    may lie in the same document and overlap the later one. Rows with equal doc_id and text are one document and get the
    same result. Null texts stay null, as one line that is never deleted; an empty table gives no rows.
    """
    runs = later_copies(docs, min_chars, min_words).select("d", "th", "line", (F.col("line") + F.col("n")).alias("end"))
    of_doc = Window.partitionBy("d", "th").orderBy("line", "end")
    reached = F.max("end").over(of_doc.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.col("line") > F.coalesce(reached, F.lit(-1)), 1).otherwise(0)
    runs = runs.withColumn("starts", starts).withColumn("run", F.sum("starts").over(of_doc))
    merged = runs.groupBy("d", "th", "run").agg(F.min("line").alias("line"), F.max("end").alias("end"))
    gone = merged.groupBy("d", "th").agg(F.sort_array(F.collect_list(F.struct("line", "end"))).alias("gone"))
    gone = materialise(gone, "deleted-runs")
    if gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0] <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    told = _key(docs.select("doc_id", "text")).join(gone, ["d", "th"], "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda own, i: ~F.exists("gone", lambda r: (i >= r["line"]) & (i < r["end"])))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    deleted = F.coalesce(F.aggregate("gone", F.lit(0), lambda n, r: n + r["end"] - r["line"]), F.lit(0))
    many = F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(1))
    return told.select("doc_id", text.alias("text"), many.alias("n_lines"), deleted.alias("n_deleted"))
