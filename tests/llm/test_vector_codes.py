"""Vector codes (12): the dual-tree iteration against the plain one, and the query against its SQL."""

import hashlib
import math

import duckdb
import numpy as np

from quarry.llm import queries, veccodes


def plain(rows, rounds=4, entries=256):
    """Lloyd's iteration over all pairs, in Python integers."""
    kept = sorted(((i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // 4
    books = [[v[p * width : (p + 1) * width] for _, v, _ in kept[:entries]] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for _, v, _ in kept:
                part = v[p * width : (p + 1) * width]
                groups.setdefault(nearest(part, books[p])[1], []).append(part)
            for j, parts in groups.items():
                books[p][j] = [sum(c) // len(parts) for c in zip(*parts)]
    out = []
    for i, v, label in kept:
        found = [nearest(v[p * width : (p + 1) * width], books[p]) for p in range(4)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), label))
    errors = {}
    for _, _, e, label in out:
        errors[label] = errors.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((i, c, e, errors[label], digest) for i, c, e, label in out)


def test_equals_the_plain_iteration(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 8))
    points = centres[r.integers(0, 12, 400)] + 0.02 * r.standard_normal((400, 8))
    points[100:230] = points[0]                                             # a third are one vector: ties among entries
    rows = [(i, p.tolist(), None if i % 5 == 0 else int(i % 3)) for i, p in enumerate(points)]
    rows += [(7, None, 1), (8, [], 1), (9, [1.0, None] + [0.0] * 6, 1), (10, [math.nan] * 8, 1), (11, [math.inf] + [0.0] * 7, 2), rows[20], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", df_lit()).repartition(5)
    got = sorted(map(tuple, veccodes.vector_codes(df).collect()))
    assert got == plain(rows)


def df_lit():
    from pyspark.sql import functions as F

    return F.lit("a clashing name")


def test_large_blocks_assign_whole_nodes_and_leaves_alike():
    r = np.random.default_rng(4)
    centres = r.integers(-900, 900, (40, 5))
    points = centres[r.integers(0, 40, 4000)] + r.integers(-25, 25, (4000, 5))
    entries = points[:256].astype(np.int64)
    entries[7] = entries[3]                                                 # equal entries: the lower index
    tree = veccodes.KdTree(points, veccodes.LEAF)
    want = np.argmin(((points[:, None, :] - entries[None]) ** 2).sum(axis=2), axis=1)
    assert (veccodes._codes(tree, entries) == want).all()
    whole, places, _ = veccodes.assign(tree, entries)
    assert sum(len(n) for _, n, _ in whole) and len(places)                 # both ways are taken
    sums, counts = np.zeros_like(entries), np.zeros(256, np.int64)
    veccodes._add_sums(tree, entries, sums, counts)
    expected = np.zeros_like(entries)
    np.add.at(expected, want, points)
    assert (sums == expected).all() and (counts == np.bincount(want, minlength=256)).all()


def test_large_components_stay_exact():
    points = np.array([[1 << 24, -(1 << 24)], [(1 << 24) - 1, 5]])
    assert veccodes._compare(points, points[::-1].copy()).tolist() == [1, 0]


def test_empty_few_and_odd_widths(spark):
    schema = "vec_id long, embedding array<float>"
    assert veccodes.vector_codes(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.0]), (5, [0.5, 0.0, -1.0]), (6, [1.0])]      # another length is dropped
    got = sorted(map(tuple, veccodes.vector_codes(spark.createDataFrame(rows, schema)).select("vec_id", "code", "error").collect()), key=str)
    assert got == [(4, "00000000", 0), (5, "01010100", 0), (None, "00000000", 0)]


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({queries.ORACLE['op12_vector_codes']})").fetchall()
    got = queries.QUERIES["op12_vector_codes"](spark, sf).collect()
    assert len(got) > 300 and sorted(map(tuple, got)) == sorted(want)
