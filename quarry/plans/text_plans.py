"""Registered queries: README text operators (P1-P6, K3, T3-T6) and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import chunks as ch
from quarry.operators.collect import split_by_length
from quarry.plans.registry import register
from quarry.plans.sqlkit import sentence_chunk_ctes, with_views
from quarry.sources.fixtures import fixture

# ---------------------------------------------------------------- flagship
FLAGSHIP_SQL = with_views(
    ["v_readme_samples"],
    [("kept", "SELECT * FROM v_readme_samples WHERE length(readme) >= 500"),
     ("typed", """SELECT repo_url, readme, CASE
        WHEN contains(lower(readme), 'api') OR contains(lower(readme), 'rest') OR contains(lower(readme), 'endpoint') THEN 'api'
        WHEN contains(lower(readme), 'web') OR contains(lower(readme), 'frontend') OR contains(lower(readme), 'react') THEN 'web_application'
        WHEN contains(lower(readme), 'cli') OR contains(lower(readme), 'command') OR contains(lower(readme), 'tool') THEN 'cli_tool'
        WHEN contains(lower(readme), 'library') OR contains(lower(readme), 'package') OR contains(lower(readme), 'sdk') THEN 'library'
        WHEN contains(lower(readme), 'framework') THEN 'framework'
        WHEN contains(lower(readme), 'mobile') OR contains(lower(readme), 'ios') OR contains(lower(readme), 'android') THEN 'mobile_app'
        ELSE 'other' END AS project_type FROM kept""")]
    + sentence_chunk_ctes("typed", "repo_url", "readme"),
    recursive=True,
) + """SELECT t.project_type, CAST(count(*) AS BIGINT) AS chunks, CAST(count(DISTINCT o.id) AS BIGINT) AS repos,
       CAST(sum(length(o.chunk)) AS BIGINT) AS chunk_chars
FROM t3_out o JOIN typed t ON t.repo_url = o.id GROUP BY t.project_type"""


def readme_chunk_counts(spark, sf):
    """Flagship: README samples -> length gate (F1) -> type (P6) -> chunks (T4) -> counts per type."""
    samples = fixture(spark, sf, "v_readme_samples")
    kept, _failed = split_by_length(samples, "readme", min_length=500)
    typed = kept.withColumn("project_type", tx.readme_type("readme"))
    chunks = ch.chunk_features(typed)
    return chunks.groupBy("project_type").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.countDistinct("repo_url").alias("repos"),
        F.sum(F.length("chunk")).alias("chunk_chars"))


register("readme_chunk_counts", FLAGSHIP_SQL)(readme_chunk_counts)


# ---------------------------------------------------------------- T3 / T4
@register("sentence_chunks", with_views(["v_readme_samples"], sentence_chunk_ctes("v_readme_samples", "doc_id", "readme"),
                                        recursive=True)
          + "SELECT id AS doc_id, chunk_no, chunk, CAST(length(chunk) AS INT) AS chunk_len FROM t3_out")
def q_sentence_chunks(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    return ch.chunk_sentences(s, "readme", keep=["doc_id"]).withColumn("chunk_len", F.length("chunk"))


@register("chunk_features", with_views(
    ["v_readme_samples", "v_repo_trees"],
    [("s", """SELECT r.repo_url, r.owner, r.repo, r.readme, coalesce(t.file_tree, []::VARCHAR[]) AS file_tree
              FROM v_readme_samples r LEFT JOIN v_repo_trees t ON t.repo_id = r.files_repo_id""")]
    + sentence_chunk_ctes("s", "repo_url", "readme"), recursive=True) + """
SELECT s.repo_url, s.owner, s.repo, 'unknown' AS project_type, array_to_string(s.file_tree, '|') AS file_tree,
       o.chunk_no, o.chunk
FROM t3_out o JOIN s ON s.repo_url = o.id""")
def q_chunk_features(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    t = fixture(spark, sf, "v_repo_trees")
    s = s.join(t, s.files_repo_id == t.repo_id, "left").select("repo_url", "owner", "repo", "readme", "file_tree")
    out = ch.chunk_features(s).drop("n_chunks")
    return out.withColumn("file_tree", F.array_join("file_tree", "|"))


# ---------------------------------------------------------------- T5 / T6
SECTIONS_SQL = with_views(["v_sectioned"], [
    ("marked", """SELECT doc_id, string_split(regexp_replace(readme, '\\n(##+ )', chr(10) || chr(1) || '\\1', 'g'), chr(1)) AS l
                  FROM v_sectioned WHERE readme IS NOT NULL AND readme <> ''"""),
    ("raw", "SELECT doc_id, unnest(l) AS s0, generate_subscripts(l, 1) AS idx FROM marked"),
    ("secs", """SELECT doc_id, CAST(idx AS INT) AS idx, regexp_replace(s0, '^\\s+|\\s+$', '', 'g') AS s FROM raw"""),
    ("sections", """SELECT doc_id, idx AS "index",
        CASE WHEN regexp_matches(s, '(?m)^##+ .+$') THEN regexp_replace(regexp_extract(s, '(?m)^##+ (.+)$', 1), '^\\s+|\\s+$', '', 'g')
             WHEN idx = 1 THEN 'Introduction' ELSE 'Section ' || CAST(idx AS VARCHAR) END AS title,
        s AS content, CAST(length(s) AS INT) AS size, CAST(len(string_split(s, chr(10))) AS INT) AS lines,
        CAST(len(regexp_extract_all(s, '\\S+')) AS INT) AS words
        FROM secs WHERE s <> ''"""),
])


@register("section_chunks", SECTIONS_SQL + "SELECT * FROM sections")
def q_section_chunks(spark, sf):
    return ch.section_chunks(fixture(spark, sf, "v_sectioned"))


@register("section_stats", SECTIONS_SQL + """
SELECT d.doc_id, CAST(count(s.doc_id) AS INT) AS sections,
       CAST(coalesce(round(avg(s.size)), 0) AS BIGINT) AS avg_size,
       CAST(coalesce(max(s.size), 0) AS INT) AS max_size, CAST(coalesce(min(s.size), 0) AS INT) AS min_size
FROM v_sectioned d LEFT JOIN sections s ON s.doc_id = d.doc_id GROUP BY d.doc_id""")
def q_section_stats(spark, sf):
    return ch.section_stats(fixture(spark, sf, "v_sectioned"))


# ---------------------------------------------------------------- scalar projections
TYPE_CASE = """CASE
  WHEN contains(lower({c}), 'api') OR contains(lower({c}), 'rest') OR contains(lower({c}), 'endpoint') THEN 'api'
  WHEN contains(lower({c}), 'web') OR contains(lower({c}), 'frontend') OR contains(lower({c}), 'react') THEN 'web_application'
  WHEN contains(lower({c}), 'cli') OR contains(lower({c}), 'command') OR contains(lower({c}), 'tool') THEN 'cli_tool'
  WHEN contains(lower({c}), 'library') OR contains(lower({c}), 'package') OR contains(lower({c}), 'sdk') THEN 'library'
  WHEN contains(lower({c}), 'framework') THEN 'framework'
  WHEN contains(lower({c}), 'mobile') OR contains(lower({c}), 'ios') OR contains(lower({c}), 'android') THEN 'mobile_app'
  ELSE 'other' END"""


@register("readme_type", with_views(["v_readme_samples"]) +
          f"SELECT doc_id, {TYPE_CASE.format(c='readme')} AS project_type FROM v_readme_samples")
def q_readme_type(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    return s.select("doc_id", tx.readme_type("readme").alias("project_type"))


URL_OF_LINE = "regexp_extract(line, '(https?://\\S+)', 1)"


@register("valid_url", with_views(["v_md_lines"]) + f"""
SELECT line_no, {URL_OF_LINE} AS url,
       coalesce(starts_with({URL_OF_LINE}, 'https://github.com/') OR starts_with({URL_OF_LINE}, 'http://github.com/')
                OR starts_with({URL_OF_LINE}, 'git@github.com:'), false) AS is_valid
FROM v_md_lines""")
def q_valid_url(spark, sf):
    lines = fixture(spark, sf, "v_md_lines")
    u = F.regexp_extract("line", r"(https?://\S+)", 1)
    return lines.select("line_no", u.alias("url"), tx.valid_github_url(u).alias("is_valid"))


@register("owner_repo", with_views(["v_md_lines"], [
    ("u", f"SELECT line_no, {URL_OF_LINE} AS url FROM v_md_lines"),
    ("c", """SELECT line_no, url,
        regexp_replace(split_part(split_part(regexp_replace(url, '/+$', ''), '?', 1), '#', 1), '\\.git$', '') AS s FROM u"""),
    ("p", """SELECT line_no, url, list_filter(string_split(CASE WHEN starts_with(s, 'git@github.com:') THEN substr(s, 16)
                   WHEN contains(s, 'github.com/') THEN string_split(s, 'github.com/')[2] END, '/'), lambda x: x <> '') AS parts,
                   (starts_with(url, 'https://github.com/') OR starts_with(url, 'http://github.com/')
                    OR starts_with(url, 'git@github.com:')) AS valid FROM c"""),
]) + """
SELECT line_no, url,
       CASE WHEN valid AND len(parts) >= 2 THEN parts[1] END AS owner,
       CASE WHEN valid AND len(parts) >= 2 THEN parts[2] END AS repo,
       CASE WHEN NOT coalesce(valid, false) THEN 'invalid url' WHEN len(parts) < 2 OR parts IS NULL THEN 'cannot extract owner and name' END AS error
FROM p""")
def q_owner_repo(spark, sf):
    lines = fixture(spark, sf, "v_md_lines")
    u = F.regexp_extract("line", r"(https?://\S+)", 1)
    return lines.select("line_no", u.alias("url")).select("line_no", "url", tx.owner_repo("url").alias("p")) \
        .select("line_no", "url", "p.owner", "p.repo", "p.error")


@register("truncate", with_views([]) + """
SELECT doc_id,
       CASE WHEN length(text) <= 100 THEN text ELSE substring(text, 1, 97) || '...' END AS short_text,
       CASE WHEN length(text) <= 600 THEN text ELSE regexp_replace(substring(text, 1, 597), '\\s+$', '') || '...' END AS preview
FROM documents""")
def q_truncate(spark, sf):
    from quarry.sources.tables import table
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.truncate("text", 100).alias("short_text"), tx.truncate_rstrip("text", 600).alias("preview"))


@register("approx_tokens", "SELECT doc_id, CAST(floor(length(text) / 4) AS BIGINT) AS approx_tokens FROM documents")
def q_approx_tokens(spark, sf):
    from quarry.sources.tables import table
    return table(spark, sf, "documents").select("doc_id", tx.approx_tokens("text").alias("approx_tokens"))


@register("path_filter", with_views(["v_repo_files"]) + """
SELECT repo_id, path,
       (contains(path, '.git') OR contains(path, 'node_modules') OR contains(path, '__pycache__') OR contains(path, '.venv')
        OR contains(path, 'venv') OR contains(path, '.pytest_cache') OR contains(path, '.mypy_cache')) AS excluded,
       len(list_intersect(string_split(path, '/'), ['.git', 'node_modules', '__pycache__', '.venv', 'venv', '.pytest_cache', '.mypy_cache'])) > 0 AS excluded_by_segment
FROM v_repo_files""")
def q_path_filter(spark, sf):
    f = fixture(spark, sf, "v_repo_files")
    return f.select("repo_id", "path", tx.path_excluded("path").alias("excluded"),
                    tx.path_excluded("path", by_segment=True).alias("excluded_by_segment"))


@register("flatten", """
SELECT doc_id, CAST(len(flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' ')))) AS INT) AS n_items,
       array_to_string(flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' '))), ' ') AS joined
FROM documents""")
def q_flatten(spark, sf):
    from quarry.sources.tables import table
    d = table(spark, sf, "documents")
    flat = F.flatten(F.transform(F.split("text", "\n", -1), lambda l: F.split(l, " ", -1)))
    return d.select("doc_id", F.size(flat).alias("n_items"), F.array_join(flat, " ").alias("joined"))


@register("safe_name", with_views(["v_readme_samples"]) + """
SELECT doc_id, regexp_replace(
    CASE WHEN contains(repo_url, '/') THEN string_split(repo_url, '/')[-2] ELSE 'unknown' END || '_'
    || replace(string_split(repo_url, '/')[-1], '.git', '') || '.json', '[^\\pL\\pN._\\-]', '', 'g') AS file_name
FROM v_readme_samples""")
def q_safe_name(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    return s.select("doc_id", tx.safe_file_name("repo_url").alias("file_name"))
