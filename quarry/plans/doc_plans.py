"""Registered queries: trees, prompts, bullets, fences, guard, batch docs, evaluation
(P19-P23, C6, E1)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import code as cd
from quarry.operators import docs as dc
from quarry.operators import evaluate as ev
from quarry.operators import repos as rp
from quarry.plans.code_plans import CNT_CTE, COMP_CTE, EDGE_CTES, _edge_inputs
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture
from quarry.session import materialize
from quarry.sources.tables import table


def _files(spark, sf):
    return fixture(spark, sf, "v_repo_files")


SKIP = ", ".join(f"'{x}'" for x in dc.REVIEW_TREE_SKIP)
RENDER_TREE_SQL = with_views(["v_repo_files"], [
    ("p", "SELECT repo_id, string_split(path, '/') AS parts FROM v_repo_files"),
    ("e0", """SELECT DISTINCT repo_id, parts[1:k + 1] AS anc, parts[k + 1] AS name, k < len(parts) - 1 AS is_dir, CAST(k AS INT) AS lvl
              FROM p, range(0, len(parts)) t(k) WHERE k <= 3"""),
    ("e", f"""SELECT *, anc[1:lvl] AS parent FROM e0
              WHERE NOT list_bool_or(list_transform(anc, lambda x: starts_with(x, '.') OR x IN ({SKIP})))"""),
    ("el", """SELECT *, row_number() OVER (PARTITION BY repo_id, parent ORDER BY (NOT is_dir) DESC, lower(name) DESC, name DESC) = 1 AS is_last
              FROM e"""),
    ("fl", """SELECT c.repo_id, c.anc, string_agg(CASE WHEN a.is_last THEN '    ' ELSE '│   ' END, '' ORDER BY a.lvl) AS prefix
              FROM el c JOIN el a ON a.repo_id = c.repo_id AND a.lvl < c.lvl AND a.anc = c.anc[1:a.lvl + 1] GROUP BY c.repo_id, c.anc"""),
    ("ln", """SELECT el.repo_id, coalesce(fl.prefix, '') || CASE WHEN el.is_last THEN '└── ' ELSE '├── ' END || el.name AS line,
                 list_transform(range(1, el.lvl + 2), lambda i: {'f': i = el.lvl + 1 AND NOT el.is_dir, 'l': lower(el.anc[i]), 'n': el.anc[i]}) AS dfs
              FROM el LEFT JOIN fl ON fl.repo_id = el.repo_id AND fl.anc = el.anc"""),
]) + """
SELECT repo_id, string_agg(line, chr(10) ORDER BY rn) AS tree FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY dfs) AS rn FROM ln) WHERE rn <= 200 GROUP BY repo_id"""


@register("render_tree", RENDER_TREE_SQL)
def q_render_tree(spark, sf):
    return dc.render_tree(_files(spark, sf), max_depth=3, max_lines=200)


FORMAT_TREE_SQL = with_views(["v_repo_files"], [
    ("p", "SELECT repo_id, string_split(path, '/') AS parts FROM v_repo_files"),
    ("f", """SELECT * FROM p WHERE len(parts) <= 3 AND NOT list_bool_or(list_transform(parts, lambda x:
              (starts_with(x, '.') AND x <> '.env.example') OR x IN ('__pycache__', '.git')))"""),
    ("top", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY parts) AS rank FROM f) WHERE rank <= 100"),
    ("under", "SELECT repo_id, rank, parts[1:k] AS dir FROM top, range(0, len(parts)) t(k)"),
    ("span", "SELECT repo_id, dir, min(rank) AS first_rank, max(rank) AS last_rank FROM under GROUP BY repo_id, dir"),
    ("lines", """SELECT t.repo_id, t.rank, 1048576 AS lvl,
          CASE WHEN len(t.parts) = 1 THEN '' ELSE repeat('│   ', len(t.parts) - 1) END
          || CASE WHEN t.rank = s.last_rank THEN '└── ' ELSE '├── ' END || t.parts[len(t.parts)] AS line
        FROM top t JOIN span s ON s.repo_id = t.repo_id AND s.dir = t.parts[1:len(t.parts) - 1]
        UNION ALL
        SELECT repo_id, first_rank, len(dir) - 1,
          CASE WHEN len(dir) = 1 THEN '├── ' ELSE repeat('│   ', len(dir) - 1) || '├── ' END || dir[len(dir)] || '/'
        FROM span WHERE len(dir) > 0"""),
]) + """
SELECT r.repo_id, coalesce(l.tree, '') AS tree FROM (SELECT DISTINCT repo_id FROM v_repo_files) r
LEFT JOIN (SELECT repo_id, string_agg(line, chr(10) ORDER BY rank, lvl) AS tree FROM lines GROUP BY repo_id) l ON l.repo_id = r.repo_id"""


@register("format_tree", FORMAT_TREE_SQL)
def q_format_tree(spark, sf):
    return dc.format_file_tree(_files(spark, sf), max_depth=3, max_files=100)


@register("doc_prompts")
def q_doc_prompts(spark, sf):
    files = _files(spark, sf)
    return dc.doc_prompts(files, rp.repo_summary(files))


@register("batch_docs", with_views(["v_repo_files"]) + """
SELECT repo_id, CAST(NULL AS VARCHAR) AS doc, 'empty answer' AS error, CAST(0 AS BIGINT) AS succeeded,
       count(*) OVER () AS failed
FROM (SELECT DISTINCT repo_id FROM v_repo_files)""")
def q_batch_docs(spark, sf):
    """Every repository's prompt through the (offline) model; failures become errors, counted."""
    files = _files(spark, sf)
    prompts = dc.doc_prompts(files, rp.repo_summary(files))
    res = materialize(dc.batch_docs(prompts), "batch-docs")     # the model answers once; rows and counts read its answers
    counts = dc.batch_counts(res).withColumn("_k", F.lit(1))
    return res.withColumn("_k", F.lit(1)).join(counts, "_k").drop("_k")


@register("graph_bullets", with_views(["v_repo_files"], EDGE_CTES + [CNT_CTE, COMP_CTE, (
    "edges", """SELECT k.repo_id, k.file_no, k.imp_no, k."from", coalesce(k._kw, th._theta) AS "to"
               FROM kw k LEFT JOIN theta th ON th.repo_id = k.repo_id AND th.import = k.import
               WHERE coalesce(k._kw, th._theta) IS NOT NULL""")]) + """
SELECT coalesce(c.repo_id, e.repo_id) AS repo_id, c.components_text, e.connections_text FROM
 (SELECT repo_id, string_agg('- ' || name || ' (' || type || ')', chr(10) ORDER BY component_no) AS components_text FROM comps GROUP BY repo_id) c
 FULL OUTER JOIN
 (SELECT repo_id, string_agg('- ' || "from" || ' → ' || "to", chr(10) ORDER BY file_no, imp_no) AS connections_text FROM edges GROUP BY repo_id) e
 ON c.repo_id = e.repo_id""")
def q_graph_bullets(spark, sf):
    typed, imps = _edge_inputs(spark, sf)
    comps = cd.components(typed)
    conns = cd.import_edges(typed, imps)
    g = dc.graph_bullets(comps, conns)
    return g.select("repo_id", "components_text", "connections_text")


FENCE_SQL = """regexp_replace(CASE WHEN contains(t, '```mermaid') THEN split_part(split_part(t, '```mermaid', 2), '```', 1)
        WHEN contains(t, '```') THEN split_part(split_part(t, '```', 2), '```', 1) ELSE t END, '^\\s+|\\s+$', '', 'g')"""


@register("fence_extract", with_views(["v_api_docs"]) + f"""
SELECT doc_id, turn, {FENCE_SQL} AS body FROM (SELECT doc_id, turn, regexp_replace(content, '^\\s+|\\s+$', '', 'g') AS t FROM v_api_docs)""")
def q_fence_extract(spark, sf):
    d = fixture(spark, sf, "v_api_docs")
    return d.select("doc_id", "turn", dc.fence_extract(F.col("content")).alias("body"))


def has_any(col, words):
    return "(" + " OR ".join(f"contains(lower({col}), '{w}')" for w in words) + ")"


FB = "'" + dc.FALLBACK_EXPLANATION + "'"


@register("content_guard", f"""
SELECT conv_id, turn, CASE WHEN {has_any('text', dc.EXPLANATION_BANNED)} THEN {FB} ELSE text END AS explanation
FROM conversations""")
def q_content_guard(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", dc.content_guard(F.col("text")).alias("explanation"))


def page_sql(diagram, expl):
    return (f"'# Architecture Diagram' || chr(10) || 'Last updated: 2024-01-01 00:00:00 UTC' || chr(10) || chr(10) || '```mermaid' || chr(10) "
            f"|| {diagram} || chr(10) || '```' || chr(10) || chr(10) || '## Overview' || chr(10) || chr(10) || {expl} || chr(10)")


@register("architecture_doc", with_views(["v_api_docs"], [
    ("x", f"""SELECT a.doc_id, a.turn, {FENCE_SQL.replace('t,', 'a.t,').replace("(t, '```", "(a.t, '```").replace('ELSE t END', 'ELSE a.t END')} AS diagram,
             CASE WHEN {has_any('c.text', dc.DOC_BANNED)} THEN {FB} ELSE c.text END AS expl
             FROM (SELECT doc_id, turn, regexp_replace(content, '^\\s+|\\s+$', '', 'g') AS t FROM v_api_docs) a
             JOIN conversations c ON c.conv_id = a.doc_id AND c.turn = a.turn"""),
]) + f"""
SELECT doc_id, turn, CASE WHEN {has_any(page_sql('diagram', 'expl'), dc.FINAL_BANNED)} THEN {page_sql('diagram', FB)}
                          ELSE {page_sql('diagram', 'expl')} END AS doc FROM x""")
def q_architecture_doc(spark, sf):
    d = fixture(spark, sf, "v_api_docs")
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "text")
    j = d.join(c, ["doc_id", "turn"])
    return j.select("doc_id", "turn", dc.architecture_doc(dc.fence_extract(F.col("content")), F.col("text"),
                                                          F.lit("2024-01-01 00:00:00 UTC")).alias("doc"))


def _tasks(spark, sf):
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("output", F.lead("text").over(w)).withColumn("context", F.lag("text").over(w))
    return c.filter(F.col("role") == "user").select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("task_id"),
                                                     F.col("text").alias("query"), "output", "context")


TOK = "list_distinct(list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[\\s\\pP]+'), lambda t: t <> ''))"
TASKS_CTES = [
    ("t0", """SELECT conv_id || '/' || turn AS task_id, role, text AS query, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS output,
              lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS context FROM conversations"""),
    ("tk", f"SELECT task_id, {TOK.format(x='query')} AS q, {TOK.format(x='output')} AS o, {TOK.format(x='context')} AS c FROM t0 WHERE role = 'user'"),
    ("scores", """SELECT task_id,
        round(CASE WHEN len(q) > 0 THEN len(list_filter(q, lambda x: list_contains(o, x))) / len(q) ELSE 0.0 END, 6) AS relevance_score,
        round(CASE WHEN len(o) > 0 AND len(c) > 0 THEN len(list_filter(o, lambda x: NOT list_contains(c, x))) / len(o) ELSE 0.0 END, 6) AS hallucination_score
        FROM tk"""),
]


@register("eval_scores", with_views([], TASKS_CTES) + "SELECT * FROM scores")
def q_eval_scores(spark, sf):
    return ev.eval_batch(_tasks(spark, sf))[0]


@register("eval_batch", with_views([], TASKS_CTES) + """
SELECT count(*) AS tasks, round(avg(relevance_score), 6) AS avg_relevance_score,
       round(avg(hallucination_score), 6) AS avg_hallucination_score FROM scores""")
def q_eval_batch(spark, sf):
    return ev.eval_batch(_tasks(spark, sf))[1]
