"""Exact positions in a global order, without a global sort of the rows.

Most ranking questions here ask for a few positions of a very long order: the
last training row, the k-th score of a review queue, ten bin edges.  Each is
found by repeated bounded histograms: count rows per bucket of the sort key,
keep only the buckets that hold a wanted position, split those again.  Every
pass is a scan with a partial aggregation; no row is shuffled, and a value held
by a third of all rows is split further by the tie column.  Rows are then
compared with the positions found, which is a plain projection.

``number_rows`` is for the one case that needs a number on every row.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import materialise

Position = tuple[float | int, int]


# Up to this many ranges are told apart by literals, more by a broadcast join.
_LITERAL_RANGES = 32


@dataclass(frozen=True)
class Order:
    """An order by key, then tie, and the 0-based positions wanted of it, given its number of rows."""

    key: str
    tie: str
    wanted: Callable[[int], Iterable[int]]
    descending: bool = False


@dataclass
class _Range:
    """Consecutive positions of an order: where they start and what they span.

    A range holds all rows with a key between its ends, or, where the ends are
    one key, all rows of that key with a tie between its ends.  Orders that are
    searched together stand behind each other, so a start names one range only.
    """

    order: int
    start: int
    count: int
    low: Position
    high: Position
    wanted: list[int] = field(default_factory=list)

    @property
    def single_value(self) -> bool:
        return self.low == self.high

    @property
    def varying(self) -> tuple[str, float | int, float | int]:
        """The column that varies inside the range, key before tie, and its ends."""
        i = 0 if self.low[0] != self.high[0] else 1
        return ("_key", "_tie")[i], self.low[i], self.high[i]

    def contains(self) -> Column:
        column, low, high = self.varying
        inside = (F.col("_order") == self.order) & F.col(column).between(F.lit(low), F.lit(high))
        return inside if column == "_key" else inside & (F.col("_key") == F.lit(self.low[0]))

    def width(self, buckets: int) -> float | int:
        _, low, high = self.varying
        if isinstance(low, float):
            return (high - low) / buckets or (high - low)
        return -(-(high - low + 1) // buckets)

    def bucket(self, buckets: int) -> Column:
        """Equal-width buckets of the varying column; they never mix its order up."""
        column, low, _ = self.varying
        return F.floor((F.col(column) - F.lit(low)) / F.lit(self.width(buckets))).cast("long")


def _small_table(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """Rows computed on the driver; their number is bounded by the caller."""
    if not rows:
        return df.sparkSession.createDataFrame([], schema)
    columns = [part.split() for part in schema.split(", ")]
    arrow = df.sparkSession.createDataFrame(pa.Table.from_pylist(rows))
    return arrow.select(*[F.col(name).cast(kind) for name, kind in columns])


def order_statistics(
    df: DataFrame,
    key: str,
    tie: str,
    wanted: Callable[[int], Iterable[int]],
    descending: bool = False,
    buckets: int = 4096,
    fetch_rows: int = 4096,
) -> tuple[int, dict[int, Position]]:
    """``(n, {position: (key, tie)})`` for positions of the order (key, tie).

    ``wanted`` maps the number of rows to the 0-based positions asked for.  The
    key runs down if ``descending``; ties always run up.  Rows without a key
    take no position.  ``buckets`` bounds every histogram and ``fetch_rows``
    bounds what is sorted at the end, whatever the size of ``df``.
    """
    return order_statistics_of(df, [Order(key, tie, wanted, descending)], buckets, fetch_rows)[0]


def order_statistics_of(
    df: DataFrame, orders: list[Order], buckets: int = 4096, fetch_rows: int = 4096
) -> list[tuple[int, dict[int, Position]]]:
    """``order_statistics`` of several orders of the same rows, in the passes of one.

    Every row is counted for each order before anything is shuffled; the bounds
    hold for all orders together.  Orders by whole numbers and orders by floating
    ones are two searches, as neither kind can stand in for the other exactly.
    """
    kinds = [isinstance(df.schema[o.key].dataType, (T.DoubleType, T.FloatType)) for o in orders]
    out: list[tuple[int, dict[int, Position]]] = [(0, {})] * len(orders)
    for floating in sorted(set(kinds)):
        alike = [i for i, kind in enumerate(kinds) if kind == floating]
        for i, found in zip(alike, _search_alike(df, [orders[i] for i in alike], floating, buckets, fetch_rows)):
            out[i] = found
    return out


def _search_alike(
    df: DataFrame, orders: list[Order], floating: bool, buckets: int, fetch_rows: int
) -> list[tuple[int, dict[int, Position]]]:
    keys, ties = (list(dict.fromkeys(names)) for names in ([o.key for o in orders], [o.tie for o in orders]))
    some_key = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    held = df.where(some_key).select(
        *[F.col(k).cast("double" if floating else "long").alias(f"_key{i}") for i, k in enumerate(keys)],
        *[F.col(t).cast("long").alias(f"_tie{i}") for i, t in enumerate(ties)],
    )
    # The columns that every pass reads; a lost block is computed again from df.
    held.persist(StorageLevel.MEMORY_AND_DISK)
    entries = []
    for i, o in enumerate(orders):
        key = F.col(f"_key{keys.index(o.key)}")
        entries.append(F.struct(
            F.lit(i).alias("_order"), (-key if o.descending else key).alias("_key"),
            F.col(f"_tie{ties.index(o.tie)}").alias("_tie"),
        ))
    entry = entries[0] if len(entries) == 1 else F.explode(F.array(*entries))
    narrow = held.select(entry.alias("_e")).select("_e.*").where(F.col("_key").isNotNull())
    try:
        counts, found = _search(narrow, [o.wanted for o in orders], buckets, fetch_rows)
    finally:
        held.unpersist()
    results, base = [], 0
    for o, n in zip(orders, counts):
        of_order = {p - base: at for p, at in found.items() if base <= p < base + n}
        results.append((n, {p: (-k if o.descending else k, t) for p, (k, t) in of_order.items()}))
        base += n
    return results


def _search(
    narrow: DataFrame, wanted: list[Callable[[int], Iterable[int]]], buckets: int, fetch_rows: int
) -> tuple[list[int], dict[int, Position]]:
    """Rows of each order, and the positions found, counted through all orders."""
    spans = [
        F.count("*").alias("n"),
        F.min("_key").alias("k0"), F.max("_key").alias("k1"),
        F.min("_tie").alias("t0"), F.max("_tie").alias("t1"),
    ]
    totals = {row["_order"]: row for row in narrow.groupBy("_order").agg(*spans).collect()}
    counts = [totals[i].n if i in totals else 0 for i in range(len(wanted))]
    bases = [sum(counts[:i]) for i in range(len(wanted))]
    ranges = []
    for i, (n, base) in enumerate(zip(counts, bases)):
        positions = sorted({int(p) for p in wanted[i](n)})
        if not positions:
            continue
        if positions[0] < 0 or positions[-1] >= n:
            raise ValueError(f"positions {positions[0]}..{positions[-1]} outside 0..{n - 1}")
        t = totals[i]
        ranges.append(_Range(i, base, n, (t.k0, t.t0), (t.k1, t.t1), [base + p for p in positions]))

    found: dict[int, Position] = {}
    starts = F.array(*[F.lit(base).cast("long") for base in bases])
    rows = narrow.withColumn("_start", F.element_at(starts, F.col("_order") + 1))
    while True:
        for r in ranges:
            if r.single_value:
                found.update(dict.fromkeys(r.wanted, r.low))
        ranges = [r for r in ranges if not r.single_value]
        if not ranges:
            return counts, found
        if sum(r.count for r in ranges) <= fetch_rows:
            return counts, found | _fetch(narrow, rows, ranges)
        rows = _bucketed(narrow, rows, ranges, max(16, buckets // len(ranges)))
        histogram = sorted(rows.groupBy("_start", "_bucket").agg(*spans).collect())
        ranges, kept = _narrow(ranges, histogram)
        if len(ranges) > _LITERAL_RANGES:
            table = _small_table(rows, kept, "_start bigint, _bucket bigint, _next bigint")
            rows = rows.join(F.broadcast(table), ["_start", "_bucket"]).select(
                F.col("_next").alias("_start"), "_order", "_key", "_tie"
            )


def _one_of(ranges: list[_Range], value: Callable[[_Range], Column]) -> Column:
    return reduce(lambda chain, r: chain.when(r.contains(), value(r)), ranges, F)


def _bucketed(narrow: DataFrame, rows: DataFrame, ranges: list[_Range], buckets: int) -> DataFrame:
    """Rows of the ranges with the start of their range and their bucket in it."""
    if len(ranges) <= _LITERAL_RANGES:
        return narrow.select(
            _one_of(ranges, lambda r: F.lit(r.start).cast("long")).alias("_start"),
            _one_of(ranges, lambda r: r.bucket(buckets)).alias("_bucket"), "_order", "_key", "_tie",
        ).where(F.col("_start").isNotNull())
    cuts = [
        dict(_start=r.start, _by_key=r.varying[0] == "_key", _low=r.varying[1], _low_tie=int(r.low[1]), _width=r.width(buckets))
        for r in ranges
    ]
    keys = "double" if isinstance(ranges[0].low[0], float) else "bigint"
    for cut in cuts:
        cut["_width_tie"] = 1 if cut["_by_key"] else int(cut["_width"])
        if not cut["_by_key"]:
            cut["_low"], cut["_width"] = type(ranges[0].low[0])(0), type(ranges[0].low[0])(1)
    table = _small_table(
        rows, cuts, f"_start bigint, _by_key boolean, _low {keys}, _width {keys}, _low_tie bigint, _width_tie bigint"
    )
    by_key = F.floor((F.col("_key") - F.col("_low")) / F.col("_width")).cast("long")
    by_tie = F.floor((F.col("_tie") - F.col("_low_tie")) / F.col("_width_tie")).cast("long")
    return rows.join(F.broadcast(table), "_start").select(
        "_start", F.when(F.col("_by_key"), by_key).otherwise(by_tie).alias("_bucket"), "_order", "_key", "_tie"
    )


def _narrow(ranges: list[_Range], histogram: list) -> tuple[list[_Range], list[dict]]:
    """The buckets that hold a wanted position become the next ranges."""
    narrowed, kept = [], []
    range_at = {r.start: r for r in ranges}
    for start, hist in itertools.groupby(histogram, key=lambda h: h["_start"]):
        first = start
        for h in hist:
            inside = [p for p in range_at[start].wanted if first <= p < first + h.n]
            if inside:
                kept.append(dict(_start=start, _bucket=h["_bucket"], _next=first))
                narrowed.append(_Range(range_at[start].order, first, h.n, (h.k0, h.t0), (h.k1, h.t1), inside))
            first += h.n
    return narrowed, kept


def _fetch(narrow: DataFrame, rows: DataFrame, ranges: list[_Range]) -> dict[int, Position]:
    """Number the few remaining rows and bring back only the wanted ones."""
    if len(ranges) <= _LITERAL_RANGES:
        rows = narrow.withColumn("_start", _one_of(ranges, lambda r: F.lit(r.start).cast("long")))
    few = rows.where(F.col("_start").isin([r.start for r in ranges]))
    order = Window.partitionBy("_start").orderBy("_key", "_tie")
    placed = few.withColumn("_position", F.col("_start") + F.row_number().over(order) - 1)
    wanted = [p for r in ranges for p in r.wanted]
    picked = placed.where(F.col("_position").isin(wanted)).select("_position", "_key", "_tie").collect()
    return {row["_position"]: (row["_key"], row["_tie"]) for row in picked}


def at_or_before(key: str, tie: str, position: Position | None, descending: bool = False) -> Column:
    """Whether a row stands at or before ``position`` in the order (key, tie)."""
    if position is None:
        return F.lit(False)
    value, last = position
    k = F.col(key)
    nearer = k > F.lit(value) if descending else k < F.lit(value)
    return nearer | ((k == F.lit(value)) & (F.col(tie) <= F.lit(last)))


def evenly_spaced(n: int, k: int) -> list[int]:
    """``k`` positions spread over 0..n-1, ends included; all of them if k >= n."""
    return list(range(n)) if k >= n else np.linspace(0, n - 1, k).astype(int).tolist()


def pick_positions(
    df: DataFrame,
    key: str,
    tie: str,
    wanted: Callable[[int], Iterable[int]],
    descending: bool = False,
    number: str = "position_no",
) -> DataFrame:
    """The rows of ``df`` at the wanted positions, numbered 1, 2, … in that order.

    ``tie`` must be unique.  The join is with one row per position.
    """
    _, at = order_statistics(df, key, tie, wanted, descending)
    picks = [dict(n=i, tie_value=at[p][1]) for i, p in enumerate(sorted(at), start=1)]
    small = _small_table(df, picks, "n int, tie_value bigint")
    return (
        df.join(F.broadcast(small), F.col(tie) == F.col("tie_value"))
        .drop("tie_value")
        .withColumnRenamed("n", number)
    )


def number_rows(df: DataFrame, order: list[str], number: str, partitions: int | None = None) -> DataFrame:
    """A 0-based consecutive number on every row in the given (unique) order.

    One range exchange spreads the rows evenly whatever the key distribution;
    each partition is sorted and written with its partition and row number, and
    a table with one row per partition supplies the offsets.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = materialise(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "numbered",
    )
    part, row = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(part.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + row).alias(number))
    )
