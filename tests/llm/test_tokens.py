"""Encoding, decoding and the two packings against the public libraries and plain recounts."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from riskframe.llm import byte_bpe, common, packed_rows, packing, packing_plan, pair_merge, queries, word_tokens

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["'", "'s", "'ll", "'re", "'r", "s", "ve", " ", "  ", "\n", "\t", "a", "Zé", "1", "½", "²", "!", "😀", "é", "'T",
       "_", "\x1c", "\x85", "中文", "  '", "\r\n", " ", "ß", "İ", "Σ", "%%%", "Word", "don't"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(n)]
    return texts + ["", "   ", "'", " '", "a ", "ab" * 3000, " " * 3000 + "x", "".join(rng.choices("abcdefgh", k=9000))]


def bpe():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def documents(spark, texts, extra=()):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    texts, own = odd_texts(1500), bpe()
    df = documents(spark, texts, [(None, None, None), (7, texts[7], "x")]).drop("ids")
    rows = byte_bpe.encode(df, RANKS)
    for r in rows.collect():
        text = texts[r.doc_id] if r.doc_id is not None else ""
        assert r.ids == own.encode_ordinary(text)
        parts = [own.decode_single_token_bytes(i) for i in r.ids]
        assert r.offsets == np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(int).tolist()
    back = byte_bpe.decode(rows, RANKS).collect()
    assert len(back) == len(texts) + 2
    assert all(bytes(r.bytes).decode() == (texts[r.doc_id] if r.doc_id is not None else "") for r in back)


def test_scan_equals_the_step_by_step_states():
    rng = np.random.default_rng(2)
    kinds = np.array([byte_bpe.PLAIN, byte_bpe.ONE_LETTER, byte_bpe.TWO_LETTERS, byte_bpe.RESET], np.uint8)
    for n in (1, 2, 7, 100, 1001):
        functions = kinds[rng.integers(0, 4, n)]
        state, want = 0, []
        for f in functions.tolist():
            want.append(state)
            state = f >> 2 * state & 3
        assert byte_bpe._scan(functions).tolist() == want


def test_query_digests_of_the_documents(spark):
    own = bpe()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op10_byte_bpe"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_word_ids_equal_the_library():
    library = Tokenizer.from_file(WORDS)
    texts = odd_texts(2000, 3) + ["Don't STOP's<|endoftext|>x", "<|ENDOFTEXT|>!!", "ab<|startoftext|>cd.", "ΣΑΣ ΣΑΣ!", "x\u0085y"]
    own = word_tokens.word_ids(WORDS)(texts)
    for text, ids in zip(texts, own):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


CUT = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿ]+")


def test_plain_texts_are_cut_like_the_pre_tokeniser():
    rng = random.Random(5)
    some = ["'", "''", "'s", "'LL", "'re", "'l", "'r", "l", "e", "s", "ve", " ", "\n", "\x0b", "\x1c", "\0", "a", "Zé", "23", "ß", "ÿ", "À", "!"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 12))) for _ in range(5000)] + ["'", "x'l", "'s", "", "\n"]
    parts, numbers, ends = word_tokens._cut(texts)
    assert len(set(parts)) == len(parts)
    got = [parts[i].decode("latin-1") for i in numbers]
    for text, a, b in zip(texts, [0, *ends], ends):
        assert got[a:b] == CUT.findall(text.lower())


def test_ids_put_together_in_blocks_are_the_same(monkeypatch):
    texts = odd_texts(200, 7) + [None, "plain words, don't stop"]
    want = word_tokens.word_ids(WORDS)(texts)
    monkeypatch.setattr(word_tokens, "BLOCK", 3)
    assert word_tokens.word_ids(WORDS)(texts) == want


def test_words_of_a_long_text_are_no_object_each():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 9))) for _ in range(500)]
    text, ids_of = " ".join(rng.choices(words, k=600_000)), word_tokens.word_ids(WORDS)
    ids_of([text])
    tracemalloc.start()
    try:
        ids_of([text])
        assert tracemalloc.get_traced_memory()[1] < 20 * len(text)  # an object each: about 26 bytes a character
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("pairs", [
    [], [(0, 0, 5)], [(97, 97, 300), (97, 97, 299), (299, 97, 301)],
    [(97 + i % 5, 97 + i // 5, 300 + 7 * i % 25) for i in range(25)] + [(300 + i % 25, 97 + i // 25, 400 + 11 * i % 125) for i in range(125)]])
def test_words_merged_together_equal_words_merged_alone(pairs):
    rank = {}
    for a, b, c in pairs:
        rank[a, b] = min(c, rank.get((a, b), c))
    rng, byte = random.Random(8), np.arange(256)
    words = [bytes(rng.choices(b"abcde", k=rng.randint(0, 40))) for _ in range(400)] + [b"", b"a", b"a" * 40]
    for word, got in zip(words, pair_merge.PairMerger(pairs)(words, byte, byte)):
        ids = list(word)
        while found := [(rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]:
            low, i = min(found)
            ids[i:i + 2] = [low]
        assert np.frombuffer(got, "<i4").tolist() == ids


@pytest.fixture(scope="module")
def long_documents(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "b", "c", "!"], k=rng.choice([1, 5, 60, 300, 900]))) for _ in range(150)]
    texts += ["a " * n for n in (254, 255, 256, 511, 512, 1000)] * 2
    return documents(spark, texts, [(None, "a", None), (900, None, None), (901, "", None), (0, texts[0], "x")])


def all_ids(df, library):
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in df.collect()]
    return rows


def test_packing_loses_nothing_and_is_tight(spark, long_documents):
    capacity, library = 256, Tokenizer.from_file(WORDS)
    want = []
    for doc_id, ids in all_ids(long_documents, library):
        for piece, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at:at + capacity]
            want.append((doc_id, piece, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    got = packing.pack(long_documents, WORDS, capacity).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(w[3] for w in want) // capacity)
    plain = len(packed_rows.best_fit_decreasing([w[3] for w in want], capacity))
    assert least <= len(by) <= plain + 1


def test_packing_is_the_same_without_a_broadcast(spark, long_documents, monkeypatch):
    rows = lambda: sorted((tuple(r) for r in packing.pack(long_documents.coalesce(3), WORDS, 256).collect()), key=str)
    want = rows()
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_documents_pack_to_nothing(spark):
    empty = documents(spark, [])
    assert packing.pack(empty, WORDS).count() == 0
    assert packed_rows.packed_rows(empty, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 90))
    counts = np.zeros(capacity + 1, np.int64)
    some = rng.integers(1, capacity + 1, 12)
    counts[some] = rng.integers(0, 400, 12)
    plan = packing_plan.plan(counts, capacity)
    length = np.repeat(np.arange(capacity + 1), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    if not len(length):
        assert plan.sequences == 0
        return
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    first = np.r_[True, s[1:] != s[:-1]]
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all()
    assert (o + n).max() <= capacity and len(set(s.tolist())) == plan.sequences
    plain = len(packed_rows.best_fit_decreasing(length.tolist(), capacity))
    assert plan.sequences <= plain * 1.02 + 2


def test_best_filling_equals_all_fillings():
    rng = random.Random(9)
    for _ in range(20):
        capacity = rng.randint(3, 24)
        price = np.full(capacity + 1, -np.inf)
        for l in rng.sample(range(1, capacity + 1), min(3, capacity)):
            price[l] = rng.random()
        best = [0.0] * (capacity + 1)
        for room in range(1, capacity + 1):
            best[room] = max([best[room - 1]] + [best[room - l] + price[l] for l in range(1, room + 1)])
        found = packing_plan.best_filling(price, capacity)
        assert sum(l * n for l, n in found.items()) <= capacity
        assert sum(max(price[l], 0) * n for l, n in found.items()) == pytest.approx(best[capacity])


def test_segment_tree_finds_the_least_room():
    rng = random.Random(3)
    lengths = [rng.randint(1, 100) for _ in range(600)]
    rows, room = [], []
    for i in sorted(range(600), key=lambda i: (-lengths[i], i)):
        fits = [r for r in range(len(rows)) if room[r] >= lengths[i]]
        if not fits:
            rows.append([]), room.append(100)
            fits = [len(rows) - 1]
        r = min(fits, key=lambda r: room[r])
        rows[r].append(i)
        room[r] -= lengths[i]
    got = packed_rows.best_fit_decreasing(lengths, 100)
    assert len(got) == len(rows) and sorted(i for r in got for i in r) == list(range(600))
    assert sorted(100 - sum(lengths[i] for i in r) for r in got) == sorted(room)


def test_packed_rows_give_the_documents_back(spark, long_documents, tmp_path):
    library = Tokenizer.from_file(WORDS)
    packed_rows.write_rows(long_documents, WORDS, str(tmp_path / "out"), capacity=256)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    found = []
    for r in rows:
        ids, positions = np.frombuffer(r.input_ids, "<i4"), np.frombuffer(r.position_ids, "<i4")
        assert len(ids) == len(positions) == 256 and r.cu_seqlens[0] == 0
        assert (ids[r.cu_seqlens[-1]:] == 0).all() and (positions[r.cu_seqlens[-1]:] == 0).all()
        for a, b, doc_id, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            assert (positions[a:b] == np.arange(b - a)).all()
            found.append((doc_id, start, ids[a:b].tolist()))
    want = [(d, at, ids[at:at + 256]) for d, ids in all_ids(long_documents, library) for at in range(0, len(ids), 256)]
    assert sorted(map(str, found)) == sorted(map(str, want))


@pytest.mark.parametrize("group_tokens", [packed_rows.GROUP_TOKENS, 50_000])
def test_packed_rows_hardly_depend_on_partitions(spark, group_tokens, monkeypatch):
    monkeypatch.setattr(packed_rows, "GROUP_TOKENS", group_tokens)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = set()
    for parts in (1, 8, 64):
        rows = packed_rows.packed_rows(docs.repartition(parts), WORDS).select("sequence_id", "cu_seqlens", "doc_ids", "starts").collect()
        assert len({r.sequence_id for r in rows}) == len(rows)
        tokens = sum(r.cu_seqlens[-1] for r in rows)
        assert len(rows) <= -(-tokens // 4096) * 1.01 + 1 + tokens // group_tokens  # each group may leave a row part empty
        seen.add((tokens, tuple(sorted(p for r in rows for p in zip(r.doc_ids, r.starts)))))
    assert len(seen) == 1
