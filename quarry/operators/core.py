"""Shared relational building blocks: keep-first, per-group quotas, ordered
limits, anti joins, first-success lookups and the exact hash split.

Every "first" is defined by explicit ordinal columns; nothing relies on input
order. Ranking windows with ``row_number() <= k`` are planned by Catalyst as a
partial ``WindowGroupLimit`` before the shuffle and a final one after it, so a
hot key sends at most ``k`` rows per map task across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_first(df: DataFrame, *, key, order) -> DataFrame:
    """One row per ``key`` — the first by ``order`` (ties must be broken by the caller)."""
    key = [key] if isinstance(key, (str, Column)) else list(key)
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def quota_per_group(df: DataFrame, *, group, quota: int, order, rank_col: str | None = None) -> DataFrame:
    """L3/L4: first ``quota`` rows of every group by ``order``."""
    group = [group] if isinstance(group, (str, Column)) else list(group)
    w = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= quota)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def ordered_limit(df: DataFrame, n: int, *, order) -> DataFrame:
    """First ``n`` rows by an explicit order (``TakeOrderedAndProject``: per-task top-n, then merge)."""
    return df.orderBy(*_cols(order)).limit(n)


def anti_join_on_key(df: DataFrame, seen: DataFrame, *, key: str = "key", seen_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``seen`` (left anti join; AQE may broadcast a small side)."""
    seen_key = seen_key or key
    s = seen.select(F.col(seen_key).alias("_seen_key"))   # duplicates do not change an anti join
    return df.join(s, df[key] == s["_seen_key"], "left_anti")


def first_success(candidates: DataFrame, responses: DataFrame, *, key, url: str = "url",
                  rank: str = "rank", ok=None, value: str = "body") -> DataFrame:
    """For each key, the value of the best-ranked candidate whose response succeeded.

    ``candidates(key..., rank, url)`` joined to ``responses(url, status, body)``;
    ``min_by`` keeps the aggregation partial (map-side combine) under skew.
    """
    key = [key] if isinstance(key, str) else list(key)
    ok = ok if ok is not None else (F.col("status") == 200)
    hits = candidates.join(responses.filter(ok).select(url, value), url, "inner")
    return hits.groupBy(*key).agg(F.min_by(F.col(value), F.col(rank)).alias(value),
                                  F.min(rank).alias(rank))


def exact_hash_split(df: DataFrame, *, key, fraction: float = 0.9, seed: int = 42,
                     min_rows: int = 10, prefix_len: int = 4, flag: str = "is_train") -> DataFrame:
    """Deterministic exact split — the first ``floor(n * fraction)`` rows by
    ``md5(key || seed)`` go to train (all rows when ``n < min_rows``, as in the reference; 0 switches that off).

    The rows are written once to the shared checkpoint folder and read from there, so the input is evaluated
    once. A pass over their keys counts hash prefixes (at most 16**prefix_len buckets) and finds the one bucket that
    the boundary cuts; the other rows are labelled by comparing their prefix with it, without a shuffle, and
    only that bucket's rows are ranked.
    """
    from quarry.session import materialize

    key_col = key if isinstance(key, Column) else F.col(key)
    h = df.withColumn("_h", F.md5(F.concat(key_col.cast("string"), F.lit(str(seed))))) \
          .withColumn("_p", F.substring("_h", 1, prefix_len)).withColumn("_k", key_col.cast("string"))
    h = materialize(h, "exact-split")
    hist = h.groupBy("_p").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("_cnt").over(w)                                       # a window over the buckets, at most 16**prefix_len rows
    hist = hist.withColumn("_upto", upto).withColumn("_n", F.sum("_cnt").over(Window.partitionBy()))
    hist = hist.withColumn("_ntrain", F.when(F.col("_n") < min_rows, F.col("_n"))
                           .otherwise(F.floor(F.col("_n") * F.lit(float(fraction)))).cast("long"))
    cut = F.when(F.col("_upto") > F.col("_ntrain"), F.col("_p"))
    bound = hist.agg(F.min(cut).alias("_cut"), F.min_by(F.col("_ntrain") - F.col("_upto") + F.col("_cnt"), cut).alias("_take"))
    j = h.join(F.broadcast(bound))                                     # one row
    clear = j.filter(F.col("_cut").isNull() | (F.col("_p") != F.col("_cut"))) \
        .withColumn(flag, F.col("_cut").isNull() | (F.col("_p") < F.col("_cut")))
    edge = j.filter(F.col("_p") == F.col("_cut"))
    wr = Window.partitionBy("_p").orderBy("_h", "_k")
    edge = edge.withColumn(flag, F.row_number().over(wr) <= F.col("_take"))
    return clear.unionByName(edge).drop("_h", "_p", "_k", "_cut", "_take")
