"""Anti join through a sketch (J1, J5, K1) against the exact one."""

import random

from pyspark.sql import functions as F

from quarry.operators import sketches
from quarry.operators.sketches import key_sketch, may_be_stored, sketch_anti_join


def test_no_row_is_lost_and_none_too_many(spark, monkeypatch):
    r = random.Random(5)
    for n, most in ((0, 64 << 20), (1, 64 << 20), (3000, 64 << 20), (3000, 100)):
        monkeypatch.setattr(sketches, "MOST_BYTES", most)
        stored = [(f"k{r.randint(0, 5000)}",) for _ in range(n)] + [(None,)] * 2
        rows = [(f"k{r.randint(0, 6000)}", i) for i in range(2000)] + [(None, -1), ("k1", -2), ("k1", -2)]
        got = sketch_anti_join(spark.createDataFrame(rows, "key string, n int"), spark.createDataFrame(stored, "old string"), key="key", stored_key="old")
        known = {k for (k,) in stored if k is not None}
        assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, i) for k, i in rows if k not in known), key=str)


def test_few_unseen_keys_go_on_to_the_join(spark):
    stored = spark.range(50_000).select(F.col("id").alias("key"))
    bits = 50_000 * sketches.BITS // sketches.BLOCK_BITS * sketches.BLOCK_BITS + sketches.BLOCK_BITS
    sketch = key_sketch(stored, "key", bits)
    probed = may_be_stored(spark.range(100_000, 140_000).select(F.col("id").alias("key")), sketch, "key", bits)
    assert probed.filter("_maybe").count() < 40_000 * 0.03
    assert may_be_stored(stored, sketch, "key", bits).filter("NOT _maybe").isEmpty()
    plan = probed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
