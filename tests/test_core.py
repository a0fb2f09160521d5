import hashlib
import math

from pyspark.sql import functions as F

from quarry.operators.core import exact_hash_split, keep_first, quota_per_group


def _keys(n):
    return [(f"k{i}", i % 7) for i in range(n)]


def test_exact_split_size_and_order(spark):
    for n in (5, 10, 37, 1000):
        df = spark.createDataFrame(_keys(n), "key string, g int")
        out = {r["key"]: r["is_train"] for r in exact_hash_split(df, key="key", fraction=0.9, seed=42).collect()}
        assert len(out) == n
        want_train = n if n < 10 else math.floor(n * 0.9)
        assert sum(out.values()) == want_train
        order = sorted(out, key=lambda k: (hashlib.md5((k + "42").encode()).hexdigest(), k))
        assert {k for k in order[:want_train]} == {k for k, v in out.items() if v}


def test_exact_split_partition_invariant(spark):
    df = spark.createDataFrame(_keys(500), "key string, g int")
    a = {tuple(r) for r in exact_hash_split(df.repartition(1), key="key").select("key", "is_train").collect()}
    b = {tuple(r) for r in exact_hash_split(df.repartition(7), key="key").select("key", "is_train").collect()}
    assert a == b


def test_keep_first_idempotent_and_first(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("b", 5), ("c", 9)], "k string, o int")
    once = keep_first(df, key="k", order=["o"])
    twice = keep_first(once, key="k", order=["o"])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2), ("c", 9)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_quota_per_group(spark):
    df = spark.createDataFrame([(g, i) for g in ("x", "y") for i in range(10)], "g string, i int")
    out = quota_per_group(df, group="g", quota=3, order=[F.col("i").desc()])
    got = sorted(map(tuple, out.collect()))
    assert got == [("x", 7), ("x", 8), ("x", 9), ("y", 7), ("y", 8), ("y", 9)]


def test_anti_plus_semi_is_input(spark):
    from quarry.operators.core import anti_join_on_key
    df = spark.createDataFrame([(i,) for i in range(20)], "key int")
    seen = spark.createDataFrame([(i,) for i in range(0, 20, 3)], "key int")
    anti = anti_join_on_key(df, seen, key="key")
    semi = df.join(seen, "key", "left_semi")
    assert sorted(r[0] for r in anti.union(semi).collect()) == list(range(20))


def test_partition_count_invariance(spark):
    from quarry.operators import links as lk
    from quarry.operators import repos as rp
    from quarry.sources.fixtures import fixture
    lines = fixture(spark, "/root/testdata/sf0.001", "v_md_lines")
    files = fixture(spark, "/root/testdata/sf0.001", "v_repo_files")
    for build in (lambda l, f: lk.dedup_links(lk.md_links(l)),
                  lambda l, f: rp.repo_summary(f).withColumn("key_files", F.to_json("key_files")),
                  lambda l, f: rp.well_structured(f)):
        a = sorted(map(tuple, build(lines.repartition(1), files.repartition(1)).collect()))
        b = sorted(map(tuple, build(lines.repartition(7), files.repartition(7)).collect()))
        assert a == b


def test_keep_first_and_upsert_random(spark):
    import random

    from quarry.operators import vectors as vx
    rng = random.Random(4)
    rows = [(rng.randint(0, 30), rng.randint(0, 5), i, f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a int, b int, v string")
    got = {r["k"]: r["v"] for r in keep_first(df, key="k", order=["a", "b"]).collect()}
    want = {}
    for k, a, b, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault(k, v)
    assert got == want
    cur = spark.createDataFrame([(i, "c0") for i in range(20)], "id long, content string")
    batches = [[(rng.randint(0, 30), f"b{j}") for _ in range(10)] for j in range(1, 4)]
    dfs = [spark.createDataFrame(list({i: (i, c) for i, c in b}.values()), "id long, content string") for b in batches]
    got_u = dict(map(tuple, vx.upsert(cur, *dfs).collect()))
    want_u = {i: "c0" for i in range(20)}
    for b in batches:
        for i, c in b:
            want_u[i] = c
    assert got_u == want_u


def test_exact_split_random_fractions(spark):
    import random
    rng = random.Random(8)
    for _ in range(6):
        n = rng.randint(0, 400)
        frac = rng.choice([0.05, 0.5, 0.9, 0.95])
        df = spark.createDataFrame([(f"key-{i}",) for i in range(n)] or [("x",)], "k string")
        if n == 0:
            df = df.filter("false")
        out = exact_hash_split(df, key="k", fraction=frac, seed=13, prefix_len=2)
        flags = dict(map(tuple, out.select("k", "is_train").collect()))
        want = n if n < 10 else math.floor(n * frac)
        assert len(flags) == n and sum(flags.values()) == want
        again = dict(map(tuple, exact_hash_split(df, key="k", fraction=frac, seed=13, prefix_len=2).select("k", "is_train").collect()))
        assert again == flags
