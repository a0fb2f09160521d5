"""Conversation prefix trie (13): against a plain trie in Python, and the query against its SQL."""

import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from quarry.llm import prefixtrie, queries
from quarry.llm.prefixtrie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes by walking every prefix of every rebuilt conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for node, ids in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaves = sum(not any(len(o) == len(m) + 1 and o[: len(m)] == m for o in below) for m in below)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in ids if len(built[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), sum(len(m) == len(node) + 1 for m in below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, prefix_trie(df).collect()), key=str)


def test_equals_a_plain_trie(spark):
    r = random.Random(2)
    rows = []
    for c in [*range(60), -7, -5, 900]:
        for turn in range(r.randint(1, 9)):
            rows.append((c, turn, r.choice(["user", "bot", None]), r.choice(["hi", "ja und ü", "", None])))
    rows += [(c, t, "user", f"text {t}") for c in range(1000, 1400) for t in range(9)]      # copies: most rebuilt conversations are one
    rows += [(3, None, "system", "first"), (None, 0, "user", "lost"), (4, 1, "x", "y" * 50_000), (5000, 0, "a", "b"), (5000, 0, "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["conv_id", "turn"]).union(spark.createDataFrame([(5000, 0, "a", "b")], SCHEMA))
    rows = [tuple(x) for x in df.collect()]
    df = df.withColumn("depth", F.lit(1)).withColumn("x1", F.lit("clash")).repartition(6)
    assert got(df) == plain(rows)


def test_long_groups_of_ends_go_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOB", 64)
    rows = [(c, 0, "user", "one") for c in range(700)] + [(c, 0, "user", f"other {c % 3}") for c in range(700, 760)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7)) == plain(rows)


def test_deep_tails_are_peeled_at_once(spark):
    rows = [(10, t, "user", f"t{t}") for t in range(300)] + [(11, t, "user", f"t{t}") for t in range(3)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_empty_table_and_missing_columns(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(0,)], "conv_id long")) == plain([(0, None, None, None)])


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    want = con.execute(f"SELECT {names} FROM ({queries.ORACLE['op13_conversation_trie']})").fetchall()
    rows = queries.QUERIES["op13_conversation_trie"](spark, sf).select(*names.split(", ")).collect()
    assert len(rows) > 100 and sorted(map(tuple, rows), key=str) == sorted(want, key=str)
