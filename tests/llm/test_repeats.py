"""Substring deduplication (11): against a plain search over all windows, and the query against its SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from quarry.llm import queries, repeats
from quarry.llm.recompression import Rounds, least_between, windows_of

SCHEMA = "doc_id long, text string"


def plain(rows, width=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - width + 1) if i is not None else ():
            w = tuple(words[k : k + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1) if i is not None else ():
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed, n=150):
    """Few different words, shared passages, near copies, runs, periods, copies."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    some = lambda k: " ".join(r.choices(words, k=k))
    passages = [some(r.randint(45, 140)) for _ in range(6)]
    base = some(300).split()
    out = []
    for i in range(n):
        kind = i % 7
        if kind == 0:
            out.append(some(r.randint(0, 160)))
        elif kind == 1:
            out.append(f"{some(r.randint(0, 30))} {r.choice(passages)}\n{some(r.randint(0, 30))} {r.choice(passages)}")
        elif kind == 2:
            near = list(base)
            for _ in range(r.randint(0, 4)):
                near[r.randrange(300)] = "changed"
            out.append(" ".join(near))
        elif kind == 3:
            out.append(" ".join(["same"] * r.randint(1, 130)))
        elif kind == 4:
            out.append(" ".join(["tick", "tock", "tack"] * r.randint(10, 40)) + " " + some(5))
        elif kind == 5:
            out.append(passages[0] + "\tÜber  " + passages[1])
        else:
            out.append(some(20) + " " + " ".join(base[r.randint(0, 200):]))
    return out


@pytest.mark.parametrize("seed,block", [(1, 2_000_000), (2, 3_000)])
def test_equals_the_plain_search(spark, monkeypatch, seed, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rows = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(rows)
    copy = "copied words " * 60
    rows += [(1000 + i, copy) for i in range(80)]                           # a third are one text
    rows += [(None, rows[0][1]), (3, None), (4, ""), (5, "only two"), (7, copy), (7, copy), (7, "own words " + rows[3][1]), (2000, " ".join(["long"] * 60_000)), (2001, " ".join(["long"] * 300))]
    df = spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA + ", spans string").repartition(6)
    assert sorted(map(tuple, repeats.repeats_removed(df).collect()), key=str) == plain(rows)


def test_other_widths(spark):
    rows = list(enumerate(texts(3, 60)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for width in (1, 7, 20):
        got = repeats.repeats_removed(df, width).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, width)


def test_equal_substrings_are_spelled_alike_and_others_are_not():
    r = np.random.default_rng(1)
    lengths = np.array([400, 1, 0, 350, 60])
    words = r.integers(0, 3, lengths.sum()).astype(np.uint64)
    words[:200], words[500:700] = 1, np.tile([0, 1, 2, 1], 50)
    names = (words * np.uint64(77) + np.uint64(5), words * np.uint64(991) + np.uint64(3))
    rounds = Rounds(names, np.repeat(np.arange(5), lengths))
    for width in (1, 2, 7, 30):
        at = windows_of(lengths, width)
        a, b = rounds.spellings(at, at + width)
        content = [words[i : i + width].tobytes() for i in at]
        assert len(set(zip(a.tolist(), b.tolist()))) == len(set(content)) == len({(c, x) for c, x in zip(content, a.tolist())})
        anchors = rounds.anchors(at, at + width, 8)
        assert len({(c, int(n)) for c, n in zip(content, anchors[4])}) == len(set(content))       # an anchor depends on the content alone


def test_least_between():
    r = np.random.default_rng(2)
    v = r.integers(0, 5, 90)
    low = r.integers(0, 80, 300)
    high = low + r.integers(1, 11, 300)
    assert least_between(v, low, high).tolist() == [a + int(np.argmin(v[a:b])) for a, b in zip(low, high)]


def test_empty_table(spark):
    assert repeats.repeats_removed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({queries.ORACLE['op11_substring_dedup']})").fetchall()
    got = queries.QUERIES["op11_substring_dedup"](spark, sf).collect()
    assert sum(r.n_removed for r in got) and sorted(map(tuple, got)) == sorted(want)
