"""Exact top-k by inner product: a KD-tree per shard, searched best first with the kth score carried from shard to shard.

Shards are parts of space, from median splits of a bounded sample. Every query first searches the shard it lies in; the kth
score found there goes along to those other shards whose root box can reach it, and there boxes that cannot are not opened.
A task loads its shard's tree once, and the queries stream past it.
"""

from __future__ import annotations

from heapq import heappop, heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_sample, runs, small, small_batches
from riskframe.session import materialise

#: Vectors in a shard (about), vectors in a leaf.
SHARD_ROWS, LEAF_ROWS = 8192, 64
#: Vectors whose medians cut space into shards; a part that holds more than a shard's rows is dealt on by a hash.
SAMPLE_ROWS = 20_000
#: Shards up to which the root boxes are sent to every task (1 KB each at 64 dimensions); beyond, every shard is visited.
MOST_BOXES = 20_000
#: Queries that are searched at a step.
STEP_QUERIES = 256
SCALE = 1024


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array<bigint>): floor(scale * x) of every vector that counts."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    return kept.select("vec_id", v.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def build(ids: np.ndarray, rows: np.ndarray, keys: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """A tree by median splits of the widest side: node n covers rows first[n] to last[n], inside its tight box.

    ``keys`` tell rows apart (``ids`` if not given).
    """
    keys = ids if keys is None else keys
    order = np.lexsort((keys, ids))
    first, last, child, low, high, least = [], [], [], [], [], []

    def node(a, b):
        n = len(first)
        part = rows[order[a:b]]
        first.append(a), last.append(b), child.append(0)
        low.append(part.min(axis=0)), high.append(part.max(axis=0)), least.append(ids[order[a:b]].min())
        return n

    waiting = [node(0, len(ids))]
    while waiting:
        n = waiting.pop()
        a, b = first[n], last[n]
        if b - a <= LEAF_ROWS:
            continue
        side, mid = int((high[n] - low[n]).argmax()) if rows.shape[1] else 0, (a + b) // 2
        if rows.shape[1]:
            part = order[a:b]
            order[a:b] = part[np.argpartition(rows[part, side], mid - a)]
        child[n] = node(a, mid)
        node(mid, b)  # its number is the first child's plus one
        waiting += [child[n], child[n] + 1]
    return {"ids": ids[order], "keys": keys[order], "rows": rows[order], "first": np.array(first), "last": np.array(last),
            "child": np.array(child), "least": np.array(least), "low": np.array(low), "high": np.array(high)}


def search(tree: dict[str, np.ndarray], queries: np.ndarray, query_keys: np.ndarray, k: int,
           floors: list[tuple[int, int] | None]) -> list[tuple[int, int, int]]:
    """(query key, vec_id, score) of each query's k best other rows in the tree that also beat its floor (score, -vec_id)."""
    reach = [int(np.abs(x).max(initial=0)) for x in (tree["rows"], queries)]
    most = reach[0] * reach[1] * max(1, queries.shape[1])
    if most >= 1 << 63:
        raise OverflowError("scores of these vectors do not fit 64 bits")
    kind = np.float64 if most < 1 << 53 else np.int64  # both exact here; the first is faster
    rows, q = tree["rows"].astype(kind), queries.astype(kind)
    bounds = np.maximum(q, 0) @ tree["high"].astype(kind).T + np.minimum(q, 0) @ tree["low"].astype(kind).T
    ids, keys = tree["ids"], tree["keys"]
    first, last, child, least = (tree[n].tolist() for n in ("first", "last", "child", "least"))
    found = []
    for i, own in enumerate(query_keys.tolist()):
        bound, floor, best = bounds[i].tolist(), floors[i], []
        heap = [(-bound[0], 0)]
        while heap:
            b, n = heappop(heap)
            if floor is not None:
                if -b < floor[0]:
                    break
                if -b == floor[0] and -least[n] <= floor[1]:
                    continue
            if child[n]:
                for c in (child[n], child[n] + 1):
                    if floor is None or bound[c] >= floor[0]:
                        heappush(heap, (-bound[c], c))
                continue
            scores = rows[first[n]:last[n]] @ q[i]
            hits = range(len(scores)) if floor is None else np.flatnonzero(scores >= floor[0]).tolist()
            for j in hits:
                entry = int(scores[j]), -int(ids[first[n] + j])
                if keys[first[n] + j] == own or (floor is not None and entry <= floor):
                    continue
                if len(best) < k:
                    heappush(best, entry)
                else:
                    heappushpop(best, entry)
                if len(best) == k and (floor is None or best[0] > floor):
                    floor = best[0]
        found += [(own, -e[1], e[0]) for e in best]
    return found


_TREE = ["ids", "keys", "first", "last", "child", "least", "rows", "low", "high"]
_TREES = "dim int, shard bigint, wide boolean, " + ", ".join(f"{n} binary" for n in _TREE)


def _trees(vectors: DataFrame) -> DataFrame:
    """One row for each (dim, shard): its tree, vectors and boxes in 32 bits where they fit."""
    def grow(key, table):
        table, dim = table.combine_chunks(), key[0].as_py()
        ids, keys = (table.column(c).to_numpy() for c in ("vec_id", "row"))
        tree = build(ids, _matrix(table.column("v").combine_chunks(), dim), keys)
        wide = int(np.abs(tree["rows"]).max(initial=0)) >= 1 << 31
        kind = lambda n: np.int32 if n in ("rows", "low", "high") and not wide else np.int64
        blobs = [pa.array([tree[n].astype(kind(n)).tobytes()], pa.binary()) for n in _TREE]
        return pa.table([pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([wide]), *blobs],
                        names=["dim", "shard", "wide", *_TREE])

    return vectors.groupBy("dim", "shard").applyInArrow(grow, _TREES)


def _unpacked(row: dict, names: list[str]) -> dict[str, np.ndarray]:
    tree = {}
    for n in names:
        shaped = n in ("rows", "low", "high")
        tree[n] = np.frombuffer(row[n], np.int32 if shaped and not row["wide"] else np.int64)
        if shaped:
            count = len(row["ids"] if n == "rows" else row["first"]) // 8
            tree[n] = tree[n].astype(np.int64).reshape(count, row["dim"])
    return tree


def median_cuts(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int]]:
    """(side, value, first child) of a tree of median splits of the widest side; a leaf has side -1 and its number."""
    nodes, waiting, done = [(-1, 0, 0)], [(0, sample)], 0
    while waiting:
        at, part = waiting.pop(0)
        spread = part.max(axis=0) - part.min(axis=0) if part.size else np.zeros(0)
        if len(waiting) + done + 2 <= leaves and len(part) > 1 and spread.max(initial=0) > 0:
            side = int(spread.argmax())
            value = int(np.sort(part[:, side])[len(part) // 2])
            if value == part[:, side].min():
                value += 1  # the lower side keeps the common value
            nodes[at] = (side, value, len(nodes))
            waiting += [(len(nodes), part[part[:, side] < value]), (len(nodes) + 1, part[part[:, side] >= value])]
            nodes += [(-1, 0, 0), (-1, 0, 0)]
        else:
            nodes[at] = (-1, done, 0)
            done += 1
    return nodes


def leaf_of(nodes: list[tuple[int, int, int]], rows: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out, waiting = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
    while waiting:
        n, at = waiting.pop()
        side, value, child = nodes[n]
        if side < 0:
            out[at] = value
            continue
        low = rows[at, side] < value
        waiting += [(child, at[low]), (child + 1, at[~low])]
    return out


def _sharded(rows: DataFrame) -> DataFrame:
    """``rows`` (row, vec_id, v, dim) with their shard; written."""
    sizes = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one for each length of vectors
    cuts = {}
    for dim, n in sizes.items():
        leaves = min(-(-n // SHARD_ROWS), SAMPLE_ROWS // 8)
        if leaves > 1:
            drawn = bounded_sample(rows.filter(F.col("dim") == dim).select("v"), SAMPLE_ROWS).toArrow()
            cuts[dim] = median_cuts(_matrix(drawn.column("v").combine_chunks(), dim), leaves)

    def place(batches):
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            dims = batch.column("dim").to_numpy()
            for dim in set(dims.tolist()) & cuts.keys():
                at = np.flatnonzero(dims == dim)
                leaf[at] = leaf_of(cuts[dim], _matrix(batch.column("v").take(pa.array(at)), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    placed = materialise(rows.mapInArrow(place, type(rows.schema)([*rows.schema.fields]).add("leaf", "long")), "leaves")
    parts = F.ceil(F.count("*") / SHARD_ROWS).alias("parts")
    counted = materialise(placed.groupBy("dim", "leaf").agg(parts), "leaf-sizes")
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    # leaves are few; a part number stays below 2**40
    shard = (F.col("leaf") * F.lit(1 << 40) + part).alias("shard")
    return materialise(placed.join(small(counted), ["dim", "leaf"]).select("row", "vec_id", "v", "dim", shard), "shards")


def _searched(trees: DataFrame, queries: DataFrame, tasks: int, k: int) -> DataFrame:
    """(row, vec_id, score) of searches of ``queries`` (dim, shard, row, v, floor, floor_id) in the tree of their shard."""
    asked = {"row": "bigint", "v": "array<bigint>", "floor": "bigint", "floor_id": "bigint"}
    tree = {"wide": "boolean", **dict.fromkeys(_TREE, "binary")}
    none = lambda kinds: [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    left = trees.select("dim", "shard", F.lit(0).alias("turn"), *tree, *none(asked))
    right = queries.select("dim", "shard", F.lit(1).alias("turn"), *none(tree), *asked)

    def run(batches):
        key, held = None, None
        for batch in batches:
            found = []
            names = list(zip(*[batch.column(c).to_pylist() for c in ("dim", "shard", "turn")]))
            starts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                if names[a][2] == 0:
                    key, held = names[a][:2], _unpacked(batch.slice(a, 1).to_pylist()[0], _TREE)
                    continue
                if key != names[a][:2]:
                    raise ValueError(f"no tree for shard {names[a][:2]}")
                for i in range(a, b, STEP_QUERIES):
                    part = batch.slice(i, min(STEP_QUERIES, b - i))
                    floors = [None if s is None else (s, -d) for s, d in zip(part.column("floor").to_pylist(), part.column("floor_id").to_pylist())]
                    found += search(held, _matrix(part.column("v"), key[0]), part.column("row").to_numpy(), k, floors)
            cols = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row", "vec_id", "score"])

    both = left.unionByName(right).repartition(tasks, "dim", "shard").sortWithinPartitions("dim", "shard", "turn")
    return both.mapInArrow(run, "row bigint, vec_id bigint, score bigint")


def _within_reach(queries: DataFrame, trees: DataFrame, shards: int) -> DataFrame:
    """``queries`` (row, v, dim, shard, floor, floor_id), once for each other shard whose root box can reach the floor."""
    schema = type(queries.schema)(queries.schema.fields)
    if shards > MOST_BOXES:
        names = trees.select("dim", F.col("shard").alias("other"))
        pairs = queries.join(names, "dim").filter("shard <> other")
        return pairs.drop("shard").withColumnRenamed("other", "shard").select(*queries.columns)
    boxes = {}
    width = lambda c: F.substring(c, 1, (F.when(F.col("wide"), 8).otherwise(4) * F.col("dim")).cast("int"))
    for r in trees.select("dim", "shard", "wide", width(F.col("low")).alias("low"), width(F.col("high")).alias("high")).collect():
        low, high = (np.frombuffer(x, np.int64 if r.wide else np.int32).astype(np.float64) for x in (r.low, r.high))
        boxes.setdefault(r.dim, []).append((r.shard, low, high))
    boxes = {dim: [np.array(c) for c in zip(*found)] for dim, found in boxes.items()}

    def send(batches):
        for batch in batches:
            for at in runs(list(range(batch.num_rows)), STEP_QUERIES):
                part = batch.slice(at[0], len(at))
                dims, own = part.column("dim").to_numpy(), part.column("shard").to_numpy()
                floors = part.column("floor").to_pylist()
                for dim in sorted(set(dims.tolist())):
                    shard, low, high = boxes[dim]
                    rows = np.flatnonzero(dims == dim)
                    q = _matrix(part.column("v").take(pa.array(rows)), dim).astype(np.float64)
                    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
                    least = np.array([-np.inf if floors[i] is None else floors[i] for i in rows.tolist()], np.float64)
                    # sums of doubles may be off by their rounding: a box that close is opened
                    slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T)
                    reach = (bound + slack >= least[:, None]) & (shard[None, :] != own[rows][:, None])
                    i, j = np.nonzero(reach)
                    sent = part.take(pa.array(rows[i]))
                    arrays = [pa.array(shard[j], pa.int64()) if n == "shard" else sent.column(n) for n in part.schema.names]
                    yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

    return queries.mapInArrow(send, schema)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row whose vec_id is divisible by ``every``.

    Ties go to the smaller vec_id; all are given where there are fewer than k. A vector with a null id, null or holding null,
    NaN or infinite components takes no part; vectors of other lengths than the query's are no candidates. Rows count as
    rows: of an id that occurs more than once each row is a candidate, also for the others of its id, and each is a query of
    its own. Components whose products do not fit 64 bits are an error. An empty table gives no rows; other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    told = scaled(vectors).withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()})
    rows = _sharded(materialise(told.select("row", "vec_id", "v", "dim"), "vectors"))
    trees = materialise(_trees(rows), "trees")
    shards = max(1, trees.count())
    queries = rows.filter(F.col("vec_id") % every == 0).select("row", "v", "dim", "shard")
    no_floor = [F.lit(None).cast("bigint").alias(c) for c in ("floor", "floor_id")]
    found = materialise(_searched(trees, queries.select("*", *no_floor), shards, k), "home-shards")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    if shards > 1:
        kth = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        kth = kth.select("row", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
        floored = queries.join(kth, "row", "left").select(*queries.columns, "floor", "floor_id")
        found = found.union(_searched(trees, _within_reach(floored, trees, shards), shards, k))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = rows.select("row", F.col("vec_id").alias("query_id"))
    return ranked.join(ids.filter(F.col("query_id") % every == 0), "row").select("query_id", "rank", "vec_id", "score")
