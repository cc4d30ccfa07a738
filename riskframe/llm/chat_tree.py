"""Conversations as one stream of tokens in which shared beginnings stand once, in depth-first order.

Conversations that begin with the same turns share those nodes of a prefix tree. Each node belongs to the smallest
conversation that runs through it; the nodes of one conversation form a segment, which is a path downwards and stands in
one piece in the depth-first order. A segment has the intervals of the stream that its tokens attend to besides what
stands before them in the segment itself, and the position id of its first token.

The template is ``<|turn|>role\\ntext<|end|>`` for each turn. In the stream both marks are ids of their own, beyond the
vocabulary; in formatted text they are control strings. A control string inside a role or text gets a backslash behind its
first character (one more, if it has some already), so that none is left and the way back is unique. A role's own
backslashes are doubled before and its line feeds written as ``\\n``.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import byte_bpe, turns
from riskframe.llm.common import small, small_batches
from riskframe.llm.turns import KEY
from riskframe.session import materialise

TURN, END = "<|turn|>", "<|end|>"
#: The first character of a control string, backslashes put behind it, and its rest. Besides the template's own marks
#: those of other common templates are escaped.
_CONTROL = r"([<\[])(\\*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
_ESCAPED = _CONTROL.replace(r"(\\*)", r"(\\*)\\")
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, r"\1\2\3", text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class ChatTree:
    """``tokens``: _row, segment, ids, loss_from and loss_to (offsets of the trained tokens in ids) of each node; within a
    segment they stand in the order of _row.
    ``places``: _row, segment, depth, start, end (of the node's tokens in the stream), position (id of its first token),
    n_convs (conversations through it).
    ``segments``: segment, start, end, position (id of its first token), attends (segment, start, end of each interval of
    earlier segments, in order).
    ``conversations``: conv_id, n_turns, segment and depth of its last node.

    A segment is named by the conversation whose turns it holds. All are written tables.
    """

    tokens: DataFrame
    places: DataFrame
    segments: DataFrame
    conversations: DataFrame
    path: str

    @property
    def nodes(self) -> DataFrame:
        """segment, depth, start, end, ids, position_ids, loss_from, loss_to, n_convs: tokens beside their places."""
        rows = self.places.join(self.tokens.drop("segment"), "_row")
        position_ids = F.sequence("position", F.col("position") + F.col("end") - F.col("start") - 1)
        return rows.select("segment", "depth", "start", "end", "ids", position_ids.alias("position_ids"), "loss_from", "loss_to", "n_convs")


def _members(stored: DataFrame, seed: int) -> DataFrame:
    """conv_id, depth, the name of the prefix and of the one a turn shorter, the hashes and place of the last turn, ends."""
    rows = turns.running_sums(turns.placed(stored, seed), "conv_id", [f"t{k}" for k in range(4)])
    sizes = rows.groupBy("conv_id").agg(F.max("pos").alias("last"))
    upto = [F.col(f"run_t{k}") % p for k, p in enumerate(turns.PRIMES)]
    before = [(F.col(f"run_t{k}") - F.col(f"t{k}")) % p for k, p in enumerate(turns.PRIMES)]
    named = rows.join(sizes, "conv_id").select(
        "_row", "conv_id", (F.col("pos") + 1).alias("depth"), *turns.packed(upto, KEY), *turns.packed(before, ["pa", "pb"]),
        "ha", "hb", (F.col("pos") == F.col("last")).alias("ends"))
    return materialise(named, "prefixes")


def _encoded(nodes: DataFrame, stored: DataFrame, path: str) -> DataFrame:
    """_row, segment, ids, loss_from, loss_to, n_tokens of each node; written.

    A conversation owns its path from some turn on, so a text meets one row for each owner; roles are encoded once each.
    """
    owners = materialise(nodes.groupBy("conv_id").agg(F.min("_row").alias("first")), "owners")
    owned = stored.join(small(owners), "conv_id").filter(F.col("_row") >= F.col("first"))
    roles = stored.select("role").distinct().select("role", F.concat(escape_role("role"), F.lit("\n")).alias("heading"))
    roles = materialise(byte_bpe.encode(roles, path, "heading").select("role", F.col("ids").alias("role_ids")), "roles")
    texts = owned.select("_row", F.col("conv_id").alias("segment"), "role", escape("text").alias("text"))
    rows = byte_bpe.encode(texts, path, "text").drop("offsets").join(small(roles), "role")
    first, trained = F.size("role_ids") + 1, F.col("role") == TRAINED_ROLE
    mark = lambda i: F.array(F.lit(_marks(path)[i]).cast("int"))
    return materialise(rows.select(
        "_row", "segment", F.concat(mark(0), "role_ids", "ids", mark(1)).alias("ids"), first.alias("loss_from"),
        (first + F.when(trained, F.size("ids")).otherwise(0)).alias("loss_to"),
        (first + F.size("ids") + 1).cast("long").alias("n_tokens")), "tokens")


@cache
def _marks(path: str) -> tuple[int, int]:
    size = max(byte_bpe.read_ranks(path).values()) + 1
    return size, size + 1


def chat_tree(conversations: DataFrame, path: str) -> ChatTree:
    """The tree of ``conversations`` (conv_id, turn, role, text), tokenised with the ranks at ``path``.

    A turn without number comes first, turns of one number go by role, then text; repeated turns count each time; null role
    and text are empty; rows without conv_id take no part; other columns are ignored. An empty table gives empty tables.
    Conversations equal as a whole share their last node. Texts are never cut.
    """
    for seed in count():
        stored = turns.stored_turns(conversations, seed)
        if turns.hashes_collide(stored):
            continue
        members = _members(stored, seed)
        nodes = turns.grouped(members, F.min_by("_row", "conv_id").alias("_row"))
        if nodes.filter("apart").isEmpty():
            break
    encoded = _encoded(nodes, stored, path)
    upto = turns.running_sums(encoded.select("_row", "segment", "n_tokens"), "segment", ["n_tokens"])
    inside = materialise(upto.join(nodes.select("_row", "depth", "n_convs"), "_row").select(
        "_row", "segment", "depth", "n_tokens", F.col("run_n_tokens").alias("upto"), "n_convs"), "inside")

    key = ["depth", *KEY]
    named = nodes.select(*key, F.col("conv_id").alias("segment"))
    whole = members.filter("ends").join(named, key).select("conv_id", F.col("depth").alias("n_turns"), "segment", "depth")

    sizes = inside.groupBy("segment").agg(F.min("depth").alias("top"), F.sum("n_tokens").alias("size"))
    # the nodes above each segment's own, on the path of the conversation that names it
    above = members.join(sizes.filter("top > 1").select(F.col("segment").alias("conv_id"), "top"), "conv_id").filter("depth < top")
    above = above.select(F.col("conv_id").alias("own"), *key).join(named, key).join(inside, ["segment", "depth"])
    # of each segment passed on the way down, its first depth and how far it is followed
    passed = above.groupBy("own", "segment").agg(F.min("depth").alias("top"), F.max("upto").alias("cut"))
    lists = passed.groupBy("own").agg(F.sort_array(F.collect_list(F.struct("segment", "top", "cut"))).alias("passed"))
    rows = sizes.join(lists.withColumnRenamed("own", "segment"), "segment", "left")
    rows = rows.withColumn("passed", F.coalesce("passed", F.array().cast("array<struct<segment:bigint,top:bigint,cut:bigint>>")))
    # branches further down come first in depth-first order, and of those at one node the smaller conversation
    step = lambda top, segment: F.struct((-top).alias("up"), segment.alias("segment"))
    order = F.concat(F.transform("passed", lambda p: step(p["top"], p["segment"])), F.array(step(F.col("top"), F.col("segment"))))
    ordered = turns.dealt(rows.select(F.lit(0).alias("stream"), "segment", "size", "passed", order.alias("place")), [F.col("place")], "order")
    starts = turns.running_sums(ordered, "stream", ["size"]).withColumn("start", F.col("run_size") - F.col("size"))
    starts = materialise(starts.select("segment", "start", F.col("run_size").alias("end"), "passed"), "starts")

    cuts = starts.select(F.col("segment").alias("own"), F.explode("passed").alias("p")).select("own", "p.segment", "p.cut")
    cuts = cuts.join(starts.select("segment", "start"), "segment")
    interval = F.struct("segment", "start", (F.col("start") + F.col("cut")).alias("end"))
    attends = cuts.groupBy("own").agg(F.sort_array(F.collect_list(interval)).alias("attends"), F.sum("cut").alias("position"))
    segments = starts.drop("passed").join(attends.withColumnRenamed("own", "segment"), "segment", "left")
    empty = F.array().cast("array<struct<segment:bigint,start:bigint,end:bigint>>")
    segments = materialise(segments.select("segment", "start", "end", F.coalesce("position", F.lit(0)).alias("position"),
                                           F.coalesce("attends", empty).alias("attends")), "segments")

    at = inside.join(segments.select("segment", F.col("start").alias("first"), "position"), "segment").withColumn(
        "before", F.col("upto") - F.col("n_tokens"))
    places = at.select(
        "_row", "segment", "depth", (F.col("first") + F.col("before")).alias("start"), (F.col("first") + F.col("upto")).alias("end"),
        (F.col("position") + F.col("before")).alias("position"), "n_convs")
    return ChatTree(encoded.drop("n_tokens"), materialise(places, "places"), segments, materialise(whole, "conversations"), path)


def _reading(tree: ChatTree) -> DataFrame:
    """What each segment ``of`` reads, in the order (of, own, at, ends): the nodes that it attends to, then its own; behind a
    node that is some conversation's last, a row with ``ends`` and the number of tokens up to there as ``position``.

    A segment's own tokens move once and meet no other table; attended ones are looked up by a narrow one.
    """
    read = tree.segments.select(F.col("segment").alias("of"), F.explode("attends").alias("part"))
    read = read.select("of", F.col("part.segment").alias("segment"), F.col("part.end").alias("stop"))
    above = read.join(tree.places.select("_row", "segment", "end", "position"), "segment").filter("end <= stop")
    above = materialise(above.select("of", "_row", "position"), "attended")
    last = tree.conversations.select("segment", "depth").distinct().join(tree.places, ["segment", "depth"])
    nothing = lambda name, kind: F.lit(None).cast(kind).alias(name)
    yes, no = F.lit(True).alias("ends"), F.lit(False).alias("ends")
    attended = tree.tokens.drop("segment").join(small(above), "_row").select(
        "of", F.lit(0).alias("own"), F.col("position").alias("at"), no, "position", nothing("depth", "bigint"), "ids", "loss_from", "loss_to")
    own = tree.tokens.select(
        F.col("segment").alias("of"), F.lit(1).alias("own"), F.col("_row").alias("at"), no, nothing("position", "bigint"),
        nothing("depth", "bigint"), "ids", "loss_from", "loss_to")
    ends = last.select(
        F.col("segment").alias("of"), F.lit(1).alias("own"), F.col("_row").alias("at"), yes,
        (F.col("position") + F.col("end") - F.col("start")).alias("position"), "depth", nothing("ids", "array<int>"),
        nothing("loss_from", "int"), nothing("loss_to", "int"))
    return attended.unionByName(own).unionByName(ends)


def read_back(tree: ChatTree) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation, from the stream alone.

    A segment's tokens are read once, behind those it attends to, for all conversations that end in it. Position ids must
    be without gap; a worker holds one turn at a time.
    """
    path = tree.path
    order = ["of", "own", "at", "ends"]
    rows = _reading(tree).repartition("of").sortWithinPartitions(*order)

    def run(batches):
        ranks = byte_bpe.read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        tokens += [TURN.encode(), END.encode()]
        reader = None
        for batch in batches:
            done, lists = [], batch.column("ids")
            cuts, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            narrow = [batch.column(c).to_pylist() for c in ("of", "ends", "position", "depth", "loss_from", "loss_to")]
            for i, (of, ends, position, depth, a, b) in enumerate(zip(*narrow)):
                if reader is None or reader.segment != of:
                    reader = _Reader(of, tokens)
                reader.expect(position)
                if ends:
                    done.append(reader.row(depth))
                else:
                    reader.take(flat[cuts[i]:cuts[i + 1]].tolist(), a, b)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=_NAMES)

    small_batches(rows.sparkSession)
    read = rows.mapInArrow(run, _READ)
    named = tree.conversations.select("conv_id", F.col("segment").alias("of"), F.col("depth").alias("to"))
    return named.join(read, ["of", "to"]).drop("of", "to")


_NAMES = ["of", "to", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_READ = "of bigint, to bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Reader:
    """Reads the turns of a segment one after another and keeps digests and counts only."""

    def __init__(self, segment: int, tokens: list[bytes]):
        self.segment, self.tokens, self.position = segment, tokens, 0
        self.n_turns = self.loss_chars = self.formatted = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def expect(self, position: int | None) -> None:
        if position is not None and position != self.position:
            raise ValueError(f"segment {self.segment}: position {position} where {self.position} is next")

    def _text(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode()

    def take(self, ids: list[int], loss_from: int, loss_to: int) -> None:
        self.position += len(ids)
        formatted = self._text(ids)
        if not (formatted.startswith(TURN) and formatted.endswith(END)):
            raise ValueError(f"segment {self.segment}: a turn without its marks")
        role, _, text = formatted[len(TURN):-len(END)].partition("\n")
        self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        if loss_to > loss_from:
            learned = unescape(self._text(ids[loss_from:loss_to]))
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.formatted += len(formatted)
        self.n_turns += 1

    def row(self, depth: int) -> tuple:
        """What has been read so far, as the conversations that end here have it."""
        return (self.segment, depth, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted)
