"""Registered queries: review decisions, candidates and cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import code as cd
from quarry.operators import review as rv
from quarry.plans.code_plans import PRE_CTES
from quarry.plans.repo_plans import TYPE_CASE as REPO_TYPE_CASE
from quarry.plans import doc_plans  # noqa: F401  (registers the tree's SQL)
from quarry.plans.registry import ORACLE, register
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture
from quarry.sources.tables import table

STATE_CTES = [
    ("kd", """SELECT * FROM v_review_log WHERE decision IN ('keep', 'discard')
              QUALIFY row_number() OVER (PARTITION BY repo_url ORDER BY ts DESC, event_id DESC) = 1"""),
    ("un", """SELECT * FROM v_review_log WHERE decision = 'undo'
              QUALIFY row_number() OVER (PARTITION BY repo_url ORDER BY ts DESC, event_id DESC) = 1"""),
    ("state", """SELECT u.repo_url, CASE WHEN kd.decision = 'discard' THEN 'discarded'
          WHEN kd.decision = 'keep' AND (un.ts IS NULL OR un.ts < kd.ts OR (un.ts = kd.ts AND un.event_id < kd.event_id)) THEN 'kept'
          ELSE 'none' END AS state
        FROM (SELECT DISTINCT repo_url FROM v_review_log) u LEFT JOIN kd ON kd.repo_url = u.repo_url
        LEFT JOIN un ON un.repo_url = u.repo_url"""),
]


def _log(spark, sf):
    return fixture(spark, sf, "v_review_log")


@register("review_state", with_views(["v_review_log"], STATE_CTES) + "SELECT repo_url, state FROM state")
def q_review_state(spark, sf):
    return rv.review_state(_log(spark, sf))


@register("kept_repos", with_views(["v_review_log"], STATE_CTES) + "SELECT repo_url FROM state WHERE state = 'kept'")
def q_kept_repos(spark, sf):
    return rv.kept_repos(_log(spark, sf))


@register("unreviewed", with_views(["v_review_log"], STATE_CTES) + """
SELECT DISTINCT 'https://github.com/u/r' || CAST(user_id AS VARCHAR) AS repo_url FROM events
WHERE 'https://github.com/u/r' || CAST(user_id AS VARCHAR) NOT IN (SELECT repo_url FROM state WHERE state <> 'none')""")
def q_unreviewed(spark, sf):
    ev = table(spark, sf, "events")
    cands = ev.select(F.concat(F.lit("https://github.com/u/r"), F.col("user_id").cast("string")).alias("repo_url")).distinct()
    return rv.unreviewed(cands, _log(spark, sf))


@register("candidates", with_views(["v_repo_files", "v_review_log"], PRE_CTES + STATE_CTES + [
    ("pre", f"""SELECT repo_id, reason IS NULL AS ok FROM (
        SELECT g.repo_id, CASE
          WHEN (CASE WHEN _visible = 0 THEN 1 WHEN _pyv < 5 THEN 1 WHEN _codev / _visible < 0.25 THEN 1 WHEN NOT _struct THEN 1 END) IS NOT NULL THEN 'x'
          WHEN ({REPO_TYPE_CASE}) = 'library' THEN 'x'
          WHEN ({REPO_TYPE_CASE}) NOT IN ('application', 'cli') AND e.repo_id IS NULL THEN 'x'
          WHEN coalesce(l.layer_count, 0) < 2 THEN 'x' WHEN coalesce(l.component_count, 0) < 3 THEN 'x'
          WHEN coalesce(nc.conns, 0) = 0 AND coalesce(l.component_count, 0) < 4 THEN 'x'
          WHEN _code < 10 THEN 'x' WHEN _code > 500 THEN 'x' WHEN _code_dirs < 3 THEN 'x' END AS reason
        FROM g LEFT JOIN (SELECT *, CAST(frontend_layer AS INT) + CAST(application_layer AS INT) + CAST(data_layer AS INT) AS layer_count FROM lay) l
          ON l.repo_id = g.repo_id LEFT JOIN entry e ON e.repo_id = g.repo_id LEFT JOIN ncon nc ON nc.repo_id = g.repo_id)"""),
    ("repos", """SELECT DISTINCT p.repo_id, 'https://github.com/u/r' || CAST(p.repo_id AS VARCHAR) AS repo_url,
                 coalesce(s.state, 'none') <> 'none' AS reviewed, pre.ok
                 FROM pf p LEFT JOIN state s ON s.repo_url = 'https://github.com/u/r' || CAST(p.repo_id AS VARCHAR)
                 LEFT JOIN pre ON pre.repo_id = p.repo_id"""),
    ("chosen", """SELECT repo_id, repo_url, CAST(row_number() OVER (ORDER BY repo_id) AS INT) AS cand_no FROM
                 (SELECT * FROM repos WHERE NOT reviewed AND coalesce(ok, false) ORDER BY repo_id LIMIT 5)"""),
    ("st", """SELECT count(*) AS candidates, max(repo_id) AS last FROM chosen"""),
    ("checked", """SELECT count(*) AS total_checked FROM repos, st WHERE st.candidates < 5 OR repos.repo_id <= st.last"""),
]) + """
SELECT c.repo_id, c.repo_url, c.cand_no, st.candidates, k.total_checked,
       CASE WHEN k.total_checked > 0 THEN round(st.candidates / k.total_checked, 6) ELSE 0.0 END AS pass_rate
FROM chosen c, st, checked k""")
def q_candidates(spark, sf):
    files = fixture(spark, sf, "v_repo_files")
    repos = files.select("repo_id").distinct().select(
        "repo_id", F.concat(F.lit("https://github.com/u/r"), F.col("repo_id").cast("string")).alias("repo_url"),
        F.col("repo_id").alias("repo_no"))
    _, comps, conns = cd.architecture(files, mode="regex")
    pre = cd.review_prefilter(files, comps, conns)
    chosen, stats = rv.candidates(repos, _log(spark, sf), pre, limit=5)
    return chosen.withColumn("_k", F.lit(1)).join(stats.withColumn("_k", F.lit(1)), "_k").drop("_k")


CARD_SQL = f"""
SELECT s.*, st.* EXCLUDE (repo_id), t.* EXCLUDE (repo_id) FROM ({ORACLE["repo_summary"]}) s
LEFT JOIN ({ORACLE["structure_stats"]}) st ON st.repo_id = s.repo_id LEFT JOIN ({ORACLE["render_tree"]}) t ON t.repo_id = s.repo_id"""


@register("review_cards", CARD_SQL)
def q_review_cards(spark, sf):
    c = rv.review_cards(fixture(spark, sf, "v_repo_files"))
    key_files = F.array_join(F.transform(F.map_entries("key_files"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return c.withColumn("key_files", F.when(F.size("key_files") > 0, key_files)).withColumn("top_level_dirs", F.array_join("top_level_dirs", "|"))
