"""Nearest neighbours (3) and URL rules (5)."""

import numpy as np

from quarry.llm import ann
from quarry.llm.urlfilter import split_url, url_filter


def rows_of(vectors):
    return [(i, v) for i, v in enumerate(vectors)]


def brute(rows, k, every=1):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % every == 0:
            scores = (points * np.array(v)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), scores[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_against_brute_force_with_copies(spark):
    r = np.random.default_rng(5)
    centres = r.standard_normal((30, 16))
    points = (centres[r.integers(0, 30, 2000)] + 0.3 * r.standard_normal((2000, 16)))
    points = (points / np.sqrt((points**2).sum(axis=1))[:, None]).astype(np.float32).astype(float)
    points[:600] = points[0]                                               # a third are one vector
    rows = rows_of(points.tolist())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, want = found(ann.search(df, "vec_id % 20 = 0", k=10)), brute(rows, 10, 20)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert [i for i, _ in got[0]] == list(range(1, 11))                    # ties go to smaller ids
    exact = {i: s for i, s in want[20]}
    assert all(abs(exact[i] - s) < 1e-12 for i, s in got[20] if i in exact)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.search(df, "vec_id % 20 = 0"))
    assert got == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}    # all candidates where there are fewer
    assert ann.search(df.limit(0), "vec_id % 20 = 0").count() == 0
    assert ann.search(df.where("vec_id = 3"), "vec_id % 20 = 0").count() == 0


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def test_url_rules(spark):
    cases = {1: ("https://A.Example.NET/en/x?q", ("a.example.net", "/en/x", "example.net/en/", "allow")), 2: ("http://a.example.net/de", ("a.example.net", "/de", "net/", "block")),
             3: ("http://example.com/de/1#t", ("example.com", "/de/1", "example.com/de/", "block")), 4: ("http://notexample.com/de/1", ("notexample.com", "/de/1", None, "allow")),
             5: ("x", ("", "", None, "allow")), 6: (None, ("", "", None, "allow")), 7: ("http://b.net", ("b.net", "", None, "allow")), 8: ("http://b.net?x/y", ("b.net", "", None, "allow")),
             9: ("ftp://Ä.org/fr/://z", ("Ä.org", "/fr/://z", "org/fr/", "allow")), 10: ("http:///p", ("", "/p", None, "allow")), 11: ("http://net/", ("net", "/", "net/", "block")), None: ("http://x.net/", ("x.net", "/", "net/", "block"))}
    df = spark.createDataFrame([(i, u, "v", "w") for i, (u, _) in cases.items()], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(df, RULES).collect()}
    assert got == {i: want for i, (_, want) in cases.items()}
    assert url_filter(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_filter(df, spark.createDataFrame([], "verdict string, host string, path string"), default="block").collect()} == {"block"}
    assert split_url("a://b/c://d") == ("b", "/c://d")
