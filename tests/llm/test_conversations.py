"""Chat formatting and the conversation trie against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from compare import difference

from riskframe.llm import chat_tree, prefix_trie, queries, turns
from riskframe.llm.vocabulary import vocabulary

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, _row string, words double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", None) for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hello there you"), (0, 2, "assistant", "hi"), (0, 3, "user", "more  words\tof it"),
    (1, None, "user", "null turn first"), (1, 0, "system", "be kind"), (1, 0, "system", "be kind"), (1, 5, None, None),
    (3, 1, "b", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "sie"), (4, 0, "user", ""), (5, 0, None, "only"), (7, 1, "us\ner\\n", "role <|end|>"),
    (20, 0, "user", "one"), (25, 0, "user", "x"), (25, 1, "assistant", "y"), (25, 2, "user", "z"), (26, 0, "user", "x"), (31, 0, "user", "x"),
    (-3, 0, "user", "negative"), (-3, 1, "assistant", "</s>[INST] ok [/INST]"), (None, 0, "user", "no conversation"),
    (45, 0, "user", "lonely base missing"), (46, 0, "a", "1"), (46, 1, "a", "2"), (46, 2, "a", "3"), (46, 3, "a", "4"),
]


def many(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "", "c d e"])))
    return rows


def trie_by_force(rows):
    convs = ordered(rows)
    nodes = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        whole = base[:h] + convs[c][h:]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"all": [], "ends": []})
            node["all"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    out = []
    for p, node in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        children = lambda q: [r for r in nodes if len(r) == len(q) + 1 and r[:len(q)] == q]
        words = lambda q: len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        out.append((min(node["all"]), len(p), min(nodes[p[:-1]]["all"]) if p else None, len(node["all"]), len(children(p)),
                    sum(not children(q) for q in below), sum((len(nodes[q]["all"]) - 1) * words(q) for q in below),
                    digest(",".join(map(str, sorted(node["ends"]))))))
    return sorted(out, key=str)


def trie(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_trie_against_plain_python(spark):
    rows = ODD + [(c + 2000, *r) for c, *r in many(random.Random(1), 90)]
    assert trie(prefix_trie.prefix_trie(frame(spark, rows).repartition(3))) == trie_by_force(rows)


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0


def test_shared_hashes_lead_to_another_seed(spark, monkeypatch):
    """With weak hashes in the first round, different turns share them."""
    strong, seeds = turns._turn_hashes, []

    def weak(seed):
        seeds.append(seed)
        return [c.bitwiseAND(1).alias(n) for c, n in zip(strong(seed), ("ha", "hb"))] if seed == 0 else strong(seed)

    monkeypatch.setattr(turns, "_turn_hashes", weak)
    assert trie(prefix_trie.prefix_trie(frame(spark, ODD))) == trie_by_force(ODD) and seeds == [0, 1]


def test_shared_fingerprints_lead_to_another_seed(spark, monkeypatch):
    weight, seeds = turns._weight, []

    def flat(pos, seed, k):
        seeds.append(seed)
        return pos * 0 + 1 if seed == 0 else weight(pos, seed, k)  # sums without places: swapped turns look alike

    monkeypatch.setattr(turns, "_weight", flat)
    rows = [(1, 0, "a", "x"), (1, 1, "a", "y"), (2, 0, "a", "y"), (2, 1, "a", "x")]
    tree = chat_tree.chat_tree(frame(spark, rows), vocabulary(spark, "byte_bpe_50k.tiktoken"))
    assert set(seeds) == {0, 1} and tree.nodes.count() == 4


def test_a_conversation_may_span_ranges(spark):
    rows = [(5, t, "user", f"t{t % 7}") for t in range(500)] + [(6, t, "user", "u") for t in range(3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    stored = turns.dealt(frame(spark, rows).select("conv_id", "turn"), [turns.F.col("conv_id"), turns.F.col("turn")], "rows")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert stored.select(turns.F.shiftright("_row", 33)).distinct().count() > 1
    got = turns.running_sums(stored.withColumn("one", turns.F.lit(1)), "conv_id", ["one"]).collect()
    assert {(r.conv_id, r.turn): r.run_one for r in got} == {(c, t): t + 1 for c, t, _, _ in rows}


def formatted_by_force(rows):
    out = {}
    for c, conv in ordered(rows).items():
        learned = "".join(x for r, x in conv if r == "assistant")
        out[c] = (len(conv), digest("".join(f"{r}\n{x}\n" for r, x in conv)), len(learned), digest(learned))
    return out


def test_formatted_conversations_read_back(spark):
    rows = ODD + [(c + 2000, *r) for c, *r in many(random.Random(2), 60)]
    tree = chat_tree.chat_tree(frame(spark, rows).repartition(3), vocabulary(spark, "byte_bpe_50k.tiktoken"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_tree.read_back(tree).collect()}
    assert got == formatted_by_force(rows)


def test_stream_is_depth_first_and_attends_to_ancestors_only(spark):
    rows = many(random.Random(4), 50)
    convs = ordered(rows)
    tree = chat_tree.chat_tree(frame(spark, rows), vocabulary(spark, "byte_bpe_50k.tiktoken"))
    nodes = sorted(tree.nodes.collect(), key=lambda r: r.start)
    prefixes = [tuple(convs[r.segment][:r.depth]) for r in nodes]
    assert len(set(prefixes)) == len(prefixes) == len({tuple(v[:d]) for v in convs.values() for d in range(1, len(v) + 1)})
    at = 0
    for r in nodes:  # no gap, each token once
        assert r.start == at and r.end == at + len(r.ids) == r.start + len(r.position_ids)
        at = r.end
    for i, p in enumerate(prefixes):  # a subtree stands in one piece
        inside = [j for j, q in enumerate(prefixes) if q[:len(p)] == p]
        assert inside == list(range(i, i + len(inside)))
    segments = {r.segment: r for r in tree.segments.collect()}
    own = {p: r for p, r in zip(prefixes, nodes)}
    for p, r in own.items():
        s = segments[r.segment]
        seen = [k for part in s.attends for k in range(part.start, part.end)] + list(range(s.start, r.end))
        path = [own[p[:d]] for d in range(1, len(p) + 1)]
        assert seen == [k for q in path for k in range(q.start, q.end)]
        assert [k for q in path for k in q.position_ids] == list(range(len(seen)))


def test_empty_table_and_escapes(spark):
    tree = chat_tree.chat_tree(frame(spark, []), vocabulary(spark, "byte_bpe_50k.tiktoken"))
    assert tree.nodes.count() == tree.segments.count() == chat_tree.read_back(tree).count() == 0
    rng = random.Random(6)
    parts = ["<", "[", "\\", "|turn|>", "|end|>", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "|im_end|>", "\n", "n", "x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    marks = ["<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>"]
    for t, a, b in df.select("t", chat_tree.escape(turns.F.col("t")), chat_tree.escape_role(turns.F.col("t"))).collect():
        assert chat_tree.unescape(a) == t and chat_tree.unescape_role(b) == t
        assert not any(m in a or m in b for m in marks) and "\n" not in b


@pytest.mark.parametrize("name", ["op11_chat_formatting", "op12_prefix_trie"])
def test_queries_equal_their_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), queries.SQL[name], SMALL) is None
