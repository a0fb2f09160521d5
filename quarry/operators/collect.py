"""Collection operators: length gate (F1), prior-run merge (J2), README resolution (J3),
enrichment (J4) and the run reports (A9, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_by_length(df: DataFrame, col: str = "readme", *, min_length: int = 500):
    """(kept, failed) — text present and at least ``min_length`` code points.

    Both outputs are filters over the same lazy plan; nothing is materialised.
    """
    ok = F.coalesce(F.length(F.col(col)) >= min_length, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def merge_prior(ok: DataFrame, failed: DataFrame, *, key: str = "key", legacy: bool = False) -> DataFrame:
    """Prior successes and failures keyed by repo: ``(key, status)``.

    Reference behaviour (``legacy=True``): a key present in both lists counts
    as failed and its sample is lost. Default: the success wins.
    """
    a = ok.select(F.col(key).alias("key")).withColumn("_failed", F.lit(False))
    b = failed.select(F.col(key).alias("key")).withColumn("_failed", F.lit(True))
    u = a.unionByName(b).groupBy("key").agg(
        (F.max("_failed") if legacy else F.min("_failed")).alias("_failed"))
    return u.select("key", F.when(F.col("_failed"), F.lit("failed")).otherwise(F.lit("collected")).alias("status"))


# README locations tried in order (branch, file name).
README_CANDIDATES = ["/main/README.md", "/master/README.md", "/main/readme.md", "/master/readme.md"]


def readme_candidates(repos: DataFrame, *, owner: str = "owner", repo: str = "repo",
                      keep=("repo_url",)) -> DataFrame:
    """J3 (left side): one row per repo and candidate raw URL with its ``rank`` (1-based)."""
    arr = F.array(*[F.lit(x) for x in README_CANDIDATES])
    base = F.concat(F.lit("https://raw.githubusercontent.com/"), F.col(owner), F.lit("/"), F.col(repo))
    return repos.select(*keep, base.alias("_base"), F.posexplode(arr).alias("rank", "_suffix")) \
        .select(*keep, (F.col("rank") + 1).cast("int").alias("rank"),
                F.concat(F.col("_base"), F.col("_suffix")).alias("url"))


def resolve_readme(repos: DataFrame, fetches: DataFrame, *, key: str = "repo_url", api: DataFrame | None = None) -> DataFrame:
    """README text = first candidate URL answered with 200, else the API answer (base64)."""
    from quarry.operators.core import first_success

    cand = readme_candidates(repos, keep=(key,))
    found = first_success(cand, fetches, key=key, value="body").withColumnRenamed("body", "readme")
    if api is not None:
        dec = api.filter(F.col("status") == 200).select(
            F.col(key), F.try_validate_utf8(F.unbase64(F.col("content")).cast("string")).alias("_api"))
        found = found.join(dec, key, "full_outer").select(
            key, F.coalesce("readme", "_api").alias("readme"),
            F.when(F.col("readme").isNotNull(), F.col("rank")).otherwise(F.lit(len(README_CANDIDATES) + 1)).alias("rank"))
    return found


def collect_samples(samples: DataFrame, trees: DataFrame | None = None, *, min_length: int = 500,
                    tree_key: str = "files_repo_id", trees_key: str = "repo_id"):
    """J4 + F1 + P6 + P8: (samples, failed) in the README-sample schema.

    ``trees(repo_id, file_tree)`` is joined late (left, default ``[]``) so the
    tree is attached once per kept repo, after the length gate.
    """
    from quarry.functions.text import readme_type

    kept, failed = split_by_length(samples, "readme", min_length=min_length)
    out = kept.withColumn("project_type", readme_type("readme"))
    if trees is not None:
        t = trees.select(F.col(trees_key).alias("_tk"), F.col("file_tree").alias("_tree"))
        out = out.join(t, out[tree_key] == t["_tk"], "left").drop("_tk")
        out = out.withColumn("file_tree", F.coalesce("_tree", F.array().cast("array<string>"))).drop("_tree")
    elif "file_tree" not in out.columns:
        out = out.withColumn("file_tree", F.array().cast("array<string>"))
    out = out.withColumn("stars", F.coalesce(F.col("stars"), F.lit(0))) \
             .withColumn("readme_length", F.length("readme")) \
             .withColumn("file_count", F.size("file_tree"))
    return out, failed


def type_histogram(samples: DataFrame) -> DataFrame:
    """Samples per project type plus an overall row (``project_type='*'``) with
    the integer mean README length (rollup: one partial+final aggregation)."""
    g = samples.rollup("project_type").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("readme_length").alias("_sum"),
        F.grouping("project_type").alias("_g"))
    return g.select(
        F.when(F.col("_g") == 1, F.lit("*")).otherwise(F.col("project_type")).alias("project_type"),
        "samples",
        F.when(F.col("_g") == 1, F.floor(F.col("_sum") / F.col("samples")).cast("long")).alias("avg_readme_length"))


def collect_report(total_links: DataFrame, collected: DataFrame, failed: DataFrame) -> DataFrame:
    """A10: one-row run metadata (links considered, collected, failed) — three global counts."""
    tagged = (total_links.select(F.lit(0).alias("_t"))
              .unionByName(collected.select(F.lit(1).alias("_t")))
              .unionByName(failed.select(F.lit(2).alias("_t"))))
    return tagged.agg(F.count_if(F.col("_t") == 0).alias("total_repos"),
                      F.count_if(F.col("_t") == 1).alias("collected"),
                      F.count_if(F.col("_t") == 2).alias("failed"))
