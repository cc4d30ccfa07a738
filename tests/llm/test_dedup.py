"""Exact dedup and SimHash near-dedup against brute force."""

import random
import re

import pytest
import xxhash
from compare import difference

from riskframe.llm import components, exact_dedup, golay, queries, simhash

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def noise(rng, words):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(words))


def keep_by_force(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id, i))
    best = {k: min(v, key=lambda x: (x[0], x[1], x[2] or 0, x[3])) for k, v in groups.items()}
    return {k: (len(v), best[k][2]) for k, v in groups.items()}


@pytest.mark.parametrize("bits", [64, 5])
def test_exact_dedup_with_and_without_shared_hashes(spark, bits):
    rng = random.Random(1)
    long = noise(rng, 3000)
    rows = [(1, long), (2, long.replace(" ", "\n")), (3, long + " x"), (4, None), (5, " \t"), (6, ""), (None, "a b"),
            (7, "ab"), (8, "a  b"), (9, "a b"), (10, "😀" * 3000), (11, "😀 " * 3000), (11, "😀 " * 3000)]
    rows += [(20 + i, noise(rng, rng.randint(1, 400))) for i in range(30)]
    got = exact_dedup.exact_dedup(frame(spark, rows), bits).collect()
    want = keep_by_force(rows)
    assert len(got) == len(rows)
    for r in got:
        sizes = {want[re.sub(r"[\x20\x09-\x0D]", "", t or "")] for i, t in rows if i == r.doc_id}
        assert (r.group_size, r.keep_id) in sizes
    assert sum(r.kept for r in got) == len(want)
    assert {r.doc_id for r in got if r.kept and r.group_size > 1} == {1, 5, 8, 11}


def test_exact_dedup_keeps_one_row_of_repeated_ones(spark):
    rows = [(1, "x", "a"), (1, "x", "a"), (2, "x ", "b"), (3, "y", None), (None, "z", None), (None, "z", None)]
    left = exact_dedup.keep_one(frame(spark, rows, "doc_id long, text string, kept string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.kept) for r in left) == [(0, "z", None), (2, "x ", "b"), (3, "y", None)]
    assert exact_dedup.keep_one(frame(spark, [])).count() == 0


def test_exact_dedup_equals_its_sql(spark):
    name = "op9_exact_dedup"
    assert difference(queries.QUERIES[name](spark, SMALL), queries.SQL[name], SMALL) is None


def test_golay_words_two_bits_apart_share_a_codeword():
    import numpy as np
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 4000)
    other = words ^ (1 << rng.integers(0, 23, 4000)) ^ (1 << rng.integers(0, 23, 4000))
    a, na = golay.near_codewords(words)
    b, nb = golay.near_codewords(other)
    assert na.max() == 6
    for x, i, y, j in zip(a, na, b, nb):
        assert set(x[:i]) & set(y[:j])
    near = golay.near_codewords(words[:1])
    codes = np.arange(4096) << 11 | golay.parity(np.arange(4096))
    assert set(near[0][0][:near[1][0]]) == set(np.nonzero(np.bitwise_count(codes ^ words[0]) <= 4)[0])


def print_by_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_by_force(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def check_near_dedup(df):
    rows = [(r.doc_id, print_by_force(r.text)) for r in df.collect()]
    root = roots_by_force(sorted({p for _, p in rows}))
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    want = sorted(((d, f"{p:016x}", least.get(root[p])) for d, p in rows), key=str)
    got = simhash.near_dedup(df).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert sum(r.kept for r in got) == len(set(root.values()))


def test_near_dedup_on_the_documents(spark):
    check_near_dedup(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_near_dedup_on_odd_rows(spark):
    rng = random.Random(5)
    base = [noise(rng, 300) for _ in range(4)]
    rows = [(i, b) for i, b in enumerate(base)]
    rows += [(10 + i, b + " tail" * (i % 3)) for i, b in enumerate(base * 3)]
    rows += [(50, None), (51, " \t\n"), (52, "one"), (52, "one"), (None, "ONE"), (53, "Ä ä"), (54, noise(rng, 20000)), (None, "zz")]
    check_near_dedup(frame(spark, rows))
    assert simhash.near_dedup(frame(spark, [])).count() == 0


def test_links_of_a_crowded_ball(spark):
    """Many distinct fingerprints near each other, and chains of two-bit steps."""
    rng = random.Random(7)
    mid = rng.getrandbits(63)
    prints = {mid} | {mid ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i, 40, 3)}
    at = rng.getrandbits(63)
    for _ in range(60):
        at ^= (1 << rng.randrange(63)) | (1 << rng.randrange(63))
        prints.add(at)
    prints |= {rng.getrandbits(63) for _ in range(300)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(df)).collect()}
    want = roots_by_force(sorted(prints))
    same = {}
    for p in prints:
        same.setdefault(want[p], set()).add(found.get(p, p))
    assert all(len(v) == 1 for v in same.values())
    assert len({min(v) for v in same.values()}) == len(same)
