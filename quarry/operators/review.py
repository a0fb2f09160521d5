"""Manual review: decision log -> state (R1-R3), unreviewed candidates (J5),
first ``limit`` candidates passing the pre-filter with the pass rate (L6),
review cards (R4).

Decisions are an append-only log ``(repo_url, decision, ts, event_id)``; the
state is a per-URL aggregation (``max_by`` keeps it partial under skew).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def review_state(log: DataFrame) -> DataFrame:
    """``(repo_url, state)`` with state kept / discarded / none.

    The latest keep/discard wins; an ``undo`` after the latest keep removes it
    from the kept list (an undo never touches a discard); other text is ignored.
    """
    order = F.struct("ts", "event_id")
    kd = F.col("decision").isin("keep", "discard")
    g = log.groupBy("repo_url").agg(
        F.max_by(F.when(kd, F.col("decision")), F.when(kd, order)).alias("_last"),
        F.max(F.when(kd, order)).alias("_last_at"),
        F.max(F.when(F.col("decision") == "undo", order)).alias("_undo_at"))
    state = (F.when(F.col("_last") == "discard", "discarded")
             .when((F.col("_last") == "keep") & (F.col("_undo_at").isNull() | (F.col("_undo_at") < F.col("_last_at"))), "kept")
             .otherwise("none"))
    return g.select("repo_url", state.alias("state"))


def kept_repos(log: DataFrame) -> DataFrame:
    """The kept list."""
    return review_state(log).filter(F.col("state") == "kept").select("repo_url")


def unreviewed(candidates: DataFrame, log: DataFrame, *, url: str = "repo_url") -> DataFrame:
    """Candidates that are neither kept nor discarded (left anti join)."""
    seen = review_state(log).filter(F.col("state") != "none").select(F.col("repo_url").alias("_u"))
    return candidates.join(seen, candidates[url] == seen["_u"], "left_anti")


def candidates(repos: DataFrame, log: DataFrame, prefilter: DataFrame, *, limit: int = 100,
               order: str = "repo_no", key: str = "repo_id", url: str = "repo_url"):
    """(candidates, stats). Repositories are examined by the unique ``order`` column;
    reviewed ones are skipped, the pre-filter decides, examination stops at the
    ``limit``-th pass. ``total_checked`` = repositories examined up to that point.

    The first ``limit`` passing rows are an ordered limit (per-task top-n, then merge),
    not a global window over all repositories.
    """
    seen = review_state(log).filter(F.col("state") != "none").select(F.col("repo_url").alias("_u"))
    seen = seen.hint("merge")                           # as many rows as there are reviewed repositories: not to be broadcast
    r = repos.join(seen, repos[url] == seen["_u"], "left").withColumn("_reviewed", F.col("_u").isNotNull()).drop("_u")
    r = r.join(prefilter.select(key, F.col("ok").alias("_ok")).hint("merge"), key, "left")
    passing = r.filter(~F.col("_reviewed") & F.coalesce(F.col("_ok"), F.lit(False)))
    chosen = passing.orderBy(order).limit(limit)
    chosen = chosen.withColumn("cand_no", F.row_number().over(Window.orderBy(order)))   # <= limit rows
    ch = chosen.agg(F.count(F.lit(1)).alias("candidates"), F.max(order).alias("_last")).withColumn("_k", F.lit(1))
    examined = r.withColumn("_k", F.lit(1)).join(F.broadcast(ch), "_k") \
        .filter((F.col("candidates") < limit) | (F.col(order) <= F.col("_last")))
    checked = examined.agg(F.count(F.lit(1)).alias("total_checked")).withColumn("_k", F.lit(1))
    s = ch.join(checked, "_k", "left").drop("_k")
    tc = F.coalesce(F.col("total_checked"), F.lit(0))
    stats = s.select("candidates", tc.alias("total_checked"),
                     F.when(tc > 0, F.round(F.col("candidates") / tc, 6)).otherwise(F.lit(0.0)).alias("pass_rate"))
    return chosen.select(key, url, "cand_no"), stats


def review_cards(files: DataFrame, *, max_depth: int = 3, repo: str = "repo_id") -> DataFrame:
    """Per repository type, language, structure flags, key files and the review tree."""
    from quarry.operators.docs import render_tree
    from quarry.operators.repos import repo_summary, structure_stats

    s = repo_summary(files)
    st = structure_stats(files)
    t = render_tree(files, max_depth=max_depth, repo=repo)
    return s.join(st, repo, "left").join(t, repo, "left")
