"""The trie of rebuilt conversations, from fingerprints that compose; no rebuilt conversation is ever put together.

A rebuilt conversation is the head of one stored conversation followed by the rest of another. Its prefixes are named by
products of the two parts' fingerprints (see ``turns``). Equal names are verified through the stored turns they refer to.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import turns
from riskframe.llm.common import small
from riskframe.llm.turns import KEY, MOST_MOVED, PRIMES
from riskframe.session import materialise

#: Conversations c and c - c % EVERY share the head of the latter; it has fewer than HEADS turns.
EVERY, HEADS = 20, MOST_MOVED + 1
_WORD = r"[^\x20\x09-\x0D]+"
_NO_TURN = {"ha": 0, "hb": 0, "words": 0}


def _head_size(conv: str = "conv_id"):
    return F.crc32(F.col(conv).cast("string")) % HEADS


def _heads(rows: DataFrame) -> DataFrame:
    """For each base conversation: the number of its first turns (HEADS - 1 at most), and an array with each one's hashes,
    words and the values t0 .. t3 summed up to it."""
    first = rows.filter((F.col("conv_id") % EVERY == 0) & (F.col("pos") < HEADS - 1))
    facts = F.struct("ha", "hb", "words", *[f"t{k}" for k in range(4)])
    turn = lambda i: F.max(F.when(F.col("pos") == i, facts)).alias(f"turn{i}")
    base = first.groupBy("conv_id").agg(F.count("*").cast("int").alias("n_head"), *[turn(i) for i in range(HEADS - 1)])

    def upto(i):
        sums = [sum((F.col(f"turn{j}.t{k}") for j in range(i)), F.lit(0)) + F.col(f"turn{i}.t{k}") for k in range(4)]
        return F.struct(*[F.col(f"turn{i}.{c}").alias(c) for c in _NO_TURN],
                        *[(s % PRIMES[k]).alias(f"t{k}") for k, s in enumerate(sums)])

    return base.select(F.col("conv_id").alias("base_id"), "n_head", F.array(*[upto(i) for i in range(HEADS - 1)]).alias("head"))


def rebuilt(stored: DataFrame, seed: int) -> DataFrame:
    """The prefixes of all rebuilt conversations, without texts: conv_id, depth, fa, fb (name), pa, pb (name of the prefix
    one turn shorter), ha, hb and words of the last turn, ends (the whole conversation); written, deepest first."""
    rows = turns.placed(stored, seed, F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"))
    rows = rows.withColumn("h", _head_size())
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    sizes = sizes.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % EVERY, "h": _head_size()})
    convs = sizes.join(_heads(rows), "base_id", "left")
    taken = F.least(F.col("h"), F.coalesce("n_head", F.lit(0)))
    convs = convs.withColumns({"taken": taken, "length": taken + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))})
    convs = materialise(convs.drop("base_id", "n_head", "n_own", "h"), "conversations")

    def named(values, before, depth, ends, last):
        return [F.col("conv_id"), depth.cast("long").alias("depth"), *turns.packed(values, KEY), *turns.packed(before, ["pa", "pb"]),
                *last, ends.alias("ends")]

    zero = [F.lit(0).cast("long")] * 4
    turnless = [F.lit(v).cast("long").alias(c) for c, v in _NO_TURN.items()]
    root = convs.select(*named(zero, zero, F.lit(0), F.col("length") == 0, turnless))

    own_head = convs.filter("taken > 0").withColumn("depth", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int"))))
    at = lambda i, k: F.coalesce(F.get("head", i)[f"t{k}"], F.lit(0).cast("long"))
    here = F.col("depth") - 1
    heads = own_head.select(*named(
        [at(here, k) for k in range(4)], [at(here - 1, k) for k in range(4)], F.col("depth"), F.col("depth") == F.col("length"),
        [F.get("head", here)[c].alias(c) for c in _NO_TURN]))

    rest = rows.withColumns({f"t{k}": F.when(F.col("pos") >= F.col("h"), F.col(f"t{k}")).otherwise(F.lit(0)) for k in range(4)})
    rest = turns.running_sums(rest, "conv_id", [f"t{k}" for k in range(4)]).filter("pos >= h")
    rest = rest.join(convs, "conv_id")
    back, front = F.col("h") - F.col("taken"), (F.col("taken") - 1).cast("int")
    value = lambda run: [turns.moved(at(front, k), back, run(k), seed, k) for k in range(4)]
    depth = F.col("pos") - back + 1
    own = rest.select(*named(
        value(lambda k: F.col(f"run_t{k}")), value(lambda k: F.col(f"run_t{k}") - F.col(f"t{k}")), depth,
        depth == F.col("length"), [F.col(c) for c in _NO_TURN]))
    return turns.dealt(root.unionByName(heads).unionByName(own), [F.col("conv_id"), F.desc("depth")], "prefixes")


def _ends_digest(members: DataFrame) -> DataFrame:
    """(depth, fa, fb, ends_sha256) of ``members`` (depth, fa, fb, conv_id).

    A digest is one sequence, so each node's ids pass through one task, in order; the task keeps a hash state only.
    """
    def run(batches):
        open_key, state = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("depth", *KEY)], axis=1)
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            done = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                key, text = tuple(keys[a].tolist()), ",".join(map(str, ids[a:b])).encode()
                if key == open_key:
                    state.update(b"," + text)
                    continue
                if state is not None:
                    done.append((*open_key, state.hexdigest()))
                open_key, state = key, hashlib.sha256(text)
            yield from _rows(done)
        if state is not None:
            yield from _rows([(*open_key, state.hexdigest())])

    schema = "depth bigint, fa bigint, fb bigint, ends_sha256 string"
    key = ["depth", *KEY]
    return members.repartition(*key).sortWithinPartitions(*key, "conv_id").select(*key, "conv_id").mapInArrow(run, schema)


def _rows(found):
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["depth", *KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every conv_id c is rebuilt as the first h turns of conversation c - c % 20 (as many as it has), then its own turns after
    its first h, with h = crc32(c as text) % 4. A turn without number comes first, turns of one number go by role, then text,
    repeated turns count each time; null role and text are empty; rows without conv_id take no part; ``%`` keeps the sign of
    c. An empty table gives no rows, a conversation without turns is a member of the root only. Other columns are ignored.

    What a node needs of its subtree is put down at (smallest member, depth), which names one node, summed along that
    member's path and then over the members of each node: the work grows with the number of turns, not with depth times turns.
    """
    for seed in count():
        stored = turns.stored_turns(conversations, seed)
        if turns.hashes_collide(stored):
            continue
        members = rebuilt(stored, seed)
        ending = F.col("ends").cast("long")
        nodes = turns.grouped(members, F.sum(ending).alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("first_end"),
                              F.max("words").alias("words"))
        if nodes.filter("apart").isEmpty():
            break
    key = ["depth", *KEY]
    zero = F.lit(0).cast("long")
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                       (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"), zero.alias("child"))
    above = nodes.filter("depth > 0").select("conv_id", (F.col("depth") - 1).alias("depth"), zero, zero, F.lit(1).cast("long"))
    put = own.union(above).groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("saved", "leaf", "child")])
    paths = members.select("_row", "conv_id", *key).join(put, ["conv_id", "depth"], "left")
    paths = materialise(paths.fillna(0, ["saved", "leaf", "child"]), "paths")
    sums = turns.running_sums(paths, "conv_id", ["saved", "leaf"]).groupBy(*key).agg(
        F.sum("run_saved").alias("saved_tokens"), F.sum("run_leaf").alias("n_leaves"), F.sum("child").alias("n_children"))

    many = materialise(nodes.filter("n_ends > 1").select(*key), "common-ends")
    digests = _ends_digest(members.filter("ends").select(*key, "conv_id").join(small(many), key, "left_semi"))
    digest = (F.when(F.col("n_ends") == 0, F.sha2(F.lit("").cast("binary"), 256))
              .when(F.col("n_ends") == 1, F.sha2(F.col("first_end").cast("string").cast("binary"), 256)).otherwise(F.col("ends_sha256")))

    root = nodes.filter("depth = 0").select(F.col("conv_id").alias("parent_conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"),
                           F.col("conv_id").alias("parent_conv_id"))
    nothing = F.lit(None).cast("long").alias("parent_conv_id")
    named = nodes.filter("depth = 0").withColumn("parent_conv_id", nothing).unionByName(
        nodes.filter("depth = 1").crossJoin(F.broadcast(root))).unionByName(
        nodes.filter("depth > 1").join(parents.filter("depth > 1"), ["depth", "pa", "pb"]))
    out = named.join(sums, key).join(digests, key, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"))
