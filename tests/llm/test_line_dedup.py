"""Line dedup against a plain search for earlier runs."""

import random

from riskframe.llm import line_dedup

SMALL = "/root/testdata/sf0.001"


def by_force(rows, least):
    """Text, lines and deleted lines by (doc_id, text)."""
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows})
    seen, out = {}, {}
    gone = {key: set() for key in docs}
    for key in docs:
        lines = key[2].split("\n")
        for i in range(len(lines)):
            size, n = 0, 0
            while size < least and i + n < len(lines):
                size += len(lines[i + n]) + 1
                n += 1
            if size < least:
                break
            run = tuple(lines[i:i + n])
            if run in seen:
                gone[key].update(range(i, i + n))
            seen.setdefault(run, key)
    for key in docs:
        lines = key[2].split("\n")
        kept = [x for i, x in enumerate(lines) if i not in gone[key]]
        out[key] = ("\n".join(kept), len(lines), len(gone[key]))
    return out


def check(df, least):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = by_force(rows, least)
    got = line_dedup.line_dedup(df, least).collect()
    expected = []
    for d, t in rows:
        text, n, deleted = want[(d is None, d or 0, t or "")]
        expected.append((d, None if t is None else text, n, deleted))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    return sum(e[3] for e in expected)


def test_documents(spark):
    assert check(spark.read.parquet(f"{SMALL}/documents.parquet"), line_dedup.MIN_CHARS) > 0


def test_short_lines_and_overlaps(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choices(["a", "b", "", "long line here"], k=rng.randint(1, 40)))) for i in range(60)]
    rows += [(70, "\n" * 300), (71, "\n" * 200 + "a"), (72, None), (73, ""), (None, rows[3][1]), (None, None), (5, rows[5][1]), (80, rows[8][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "'x' as d", "2 as rank")
    for least in (1, 9, 40):
        assert check(df, least) > 0


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.line_dedup(empty).count() == 0
    assert check(spark.createDataFrame([(1, "x" * 500)], "doc_id long, text string"), 200) == 0


def words_by_force(text, seen, least_chars, least_words):
    """Lines deleted when a run of enough characters or words was seen before; runs of this text are added to ``seen``."""
    lines, gone = text.split("\n"), set()
    for i in range(len(lines)):
        for n in range(1, len(lines) - i + 1):
            run = lines[i:i + n]
            if sum(len(x) + 1 for x in run) >= least_chars or sum(len(x.split()) for x in run) >= least_words:
                if tuple(run) in seen:
                    gone.update(range(i, i + n))
                seen.add(tuple(run))
                break
    return len(gone)


def test_passages_of_short_words_go(spark):
    """51 words of one letter are a passage of 101 characters; blank lines between carry no word."""
    lines = [" ".join("abcdefghijklmnopq") for _ in range(3)]
    fifty = " ".join(["x"] * 50)
    rows = [(1, "first\n" + "\n".join(lines) + "\nend"), (2, "other\n" + "\n".join(lines) + "\nlast"),
            (3, fifty), (4, fifty), (5, "\n\n" + " ".join("y" * 51)), (6, "\n\n\n" + " ".join("y" * 51) + "\n\n")]
    rng = random.Random(4)
    rows += [(10 + i, "\n".join(rng.choices(["a b c d e f g h i j", "k", "", "l m n"], k=rng.randint(5, 60)))) for i in range(40)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].n_deleted == 3 and got[2].text == "other\nlast" and got[4].n_deleted == 0 and got[6].n_deleted == 3
    seen = set()
    assert {d: got[d].n_deleted for d, _ in rows} == {d: words_by_force(t, seen, 200, 51) for d, t in rows}
