"""Turns of conversations in order, and fingerprints of their prefixes that compose.

The fingerprint of a sequence of turns is an element (length, value) of the monoid
(n, v) . (m, w) = (n + m, v + B**n * w), with values modulo four primes. A prefix is therefore a running sum, and a part
of one conversation set before a part of another is a sum of two such values: no text is put together for it.

All orders are range partitions with running sums carried over from one to the next, so that a conversation of any
length is dealt to as many tasks as it needs.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import small
from riskframe.session import materialise

#: The largest primes below 2**31: products of two residues fit 64 bits, and four residues make a key of 124 bits.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
#: Places of a turn up to 16**DIGITS have a weight; the running sums hold as many residues.
DIGITS = 8
#: Turns taken from another conversation at most, see ``moved``.
MOST_MOVED = 3
KEY = ["fa", "fb"]


def dealt(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written in the given order, with ``_row``: a number that rises with it, its range in the bits above 33.

    Rows that are equal in all of ``order`` are dealt like others.
    """
    rows = df.withColumn("_at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_at").sortWithinPartitions(*order, "_at").drop("_at")
    return materialise(rows.withColumn("_row", F.monotonically_increasing_id()), name)


def running_sums(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows``, written by ``dealt`` with ``key`` first, with ``run_{c}``: sums of ``c`` over the key's rows up to this one.

    Only the first key of a range can have begun in an earlier one, so the carried sums are at most one row for each range.
    """
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    ends = rows.groupBy("_part").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("keys"))
    crossing = ends.select(F.explode("keys").alias(key)).groupBy(key).count().filter("count > 1").select(key)
    pieces = rows.join(F.broadcast(crossing), key, "left_semi").groupBy(key, "_part").agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(key, "_part", *[F.sum(c).over(before).alias(f"_before_{c}") for c in columns])
    carried = carried.filter(F.col(f"_before_{columns[0]}").isNotNull())
    upto = Window.partitionBy("_part", key).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(F.broadcast(carried), [key, "_part"], "left")
    sums = {f"run_{c}": F.sum(c).over(upto) + F.coalesce(f"_before_{c}", F.lit(0)) for c in columns}
    return joined.withColumns(sums).drop("_part", *[f"_before_{c}" for c in columns])


def _turn_hashes(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + i), "role", "text").alias(n) for i, n in enumerate(("ha", "hb"))]


def stored_turns(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """_row, conv_id, role, text, ha, hb of every turn; written in the order of conversations and their turns.

    A turn without number comes first, turns of one number go by role, then text. Null role and text become empty; rows
    without conversation take no part; other columns are ignored. ``_row`` is how the other tables refer to a turn.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role"), empty("text"))
    turns = turns.select("conv_id", "turn", "role", "text", *_turn_hashes(seed))
    return dealt(turns, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "turns").drop("turn")


def hashes_collide(stored: DataFrame) -> bool:
    """Whether one pair of hashes names two different turns; only turns whose hashes repeat are compared."""
    names = ["ha", "hb"]
    repeated = materialise(stored.groupBy(*names).count().filter("count > 1").select(*names), "repeated-turns")
    again = stored.join(small(repeated), names, "left_semi")
    told = again.groupBy(*names).agg(*[f(c).alias(f"{n}_{c}") for c in ("role", "text") for n, f in (("a", F.min), ("z", F.max))])
    return not told.filter("a_role <> z_role or a_text <> z_text").isEmpty()


def _base(seed: int, k: int) -> int:
    return random.Random(f"{seed}/{k}").randrange(1 << 20, PRIMES[k])


def _table(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _weight(pos: Column, seed: int, k: int) -> Column:
    """B**pos modulo the prime, one factor for each hexadecimal digit of the place."""
    p, base = PRIMES[k], _base(seed, k)
    digits = [F.shiftright(pos, 4 * i).bitwiseAND(F.lit(15)).cast("int") + 1 for i in range(DIGITS)]
    factors = [F.element_at(_table([pow(base, d << (4 * i), p) for d in range(16)]), at) for i, at in enumerate(digits)]
    return reduce(lambda a, b: a * b % p, factors)


def placed(stored: DataFrame, seed: int, *carry: Column) -> DataFrame:
    """_row, conv_id, ha, hb, pos (from 0), ``carry`` and t0 .. t3 of every turn; written, without texts.

    t0 .. t3 are the turn's value at its place, modulo each prime.
    """
    narrow = stored.select("_row", "conv_id", "ha", "hb", F.lit(1).cast("long").alias("one"), *carry)
    rows = running_sums(narrow, "conv_id", ["one"]).withColumn("pos", F.col("run_one") - 1).drop("one", "run_one")
    value = lambda k: F.pmod(F.col("ha" if k < 2 else "hb"), F.lit(PRIMES[k] - 1)) + 1
    terms = {f"t{k}": value(k) * _weight(F.col("pos"), seed, k) % PRIMES[k] for k in range(4)}
    return materialise(rows.withColumns(terms), "places")


def moved(head: Column, back: Column, run: Column, seed: int, k: int) -> Column:
    """The value of a head followed by turns with the sum ``run``, which stand ``back`` places (MOST_MOVED at most) before
    where they stood: the monoid's product, with the shift of the place as a factor."""
    p = PRIMES[k]
    inverse = pow(_base(seed, k), -1, p)
    shift = F.element_at(_table([pow(inverse, i, p) for i in range(MOST_MOVED + 1)]), (back + 1).cast("int"))
    return (head + shift * (run % p) % p) % p


def packed(values: list[Column], names: list[str]) -> list[Column]:
    """Four residues as two long columns."""
    a, b, c, d = values
    return [(a * F.lit(1 << 31) + b).alias(names[0]), (c * F.lit(1 << 31) + d).alias(names[1])]


def grouped(members: DataFrame, *more: Column) -> DataFrame:
    """One row for each (depth, fa, fb) of ``members`` (conv_id, depth, fa, fb, pa, pb, ha, hb), written: n_convs, the
    smallest conv_id, the key pa, pb of its parent, ``more``, and ``apart``.

    ``apart`` tells whether members disagree about the parent or about the turn that the group ends with. Where it is
    false everywhere, all members of a group are equal, by induction over the depth, as equal hashes mean equal turns.
    """
    same = ("pa", "pb", "ha", "hb")
    apart = reduce(Column.__or__, [F.min(c) != F.max(c) for c in same])
    nodes = members.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.coalesce(apart, F.lit(False)).alias("apart"), *more)
    return materialise(nodes, "nodes")
