"""Registered queries: link parsing, de-duplication, limits and README collection
(T1, T2, D1, D2, L1, L2, U1, U2, P7, J1-J4, F1, A9, A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import collect as co
from quarry.operators import links as lk
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.plans.text_plans import TYPE_CASE
from quarry.sources.fixtures import fixture

MD = r"\]\s*\(\s*https://github\.com/([^/]+)/([^)/#?]+)[^)]*\)"
URL = r"https://github\.com/[\w\-\.]+/[\w\-\.]+"

# Each fixture line holds at most one link, so the rest-of-line is taken after the first match.
MD_LINKS_CTES = [
    ("m0", f"""SELECT source, source_rank, line_no, regexp_extract_all(line, '{MD}', 1) AS os,
                     regexp_extract_all(line, '{MD}', 2) AS rs, regexp_extract(line, '{MD}(.*)$', 3) AS rest0
              FROM v_md_lines"""),
    ("m1", """SELECT source, source_rank, line_no, unnest(os) AS owner, unnest(rs) AS repo,
                     CAST(generate_subscripts(os, 1) - 1 AS INT) AS match_no,
                     regexp_replace(rest0, '^\\s+|\\s+$', '', 'g') AS rest FROM m0"""),
    ("md_links", """SELECT source, source_rank, line_no, match_no,
        'https://github.com/' || owner || '/' || repo AS repo_url, owner, repo, owner || '/' || repo AS name,
        CASE WHEN starts_with(rest, '-') THEN regexp_replace(regexp_replace(rest, '^-+', ''), '^\\s+|\\s+$', '', 'g') ELSE '' END AS description,
        lower(owner || '/' || repo) AS key
      FROM m1 WHERE lower(owner) <> 'github.com' AND repo <> ''"""),
    ("dedup", """SELECT * FROM md_links
      QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, line_no, match_no) = 1"""),
]
URL_CTES = [
    ("u0", f"""SELECT source, source_rank, line_no, unnest(regexp_extract_all(line, '{URL}')) AS url,
                      CAST(generate_subscripts(regexp_extract_all(line, '{URL}'), 1) - 1 AS INT) AS match_no FROM v_md_lines"""),
    ("urls", """SELECT source, source_rank, line_no, match_no, regexp_replace(url, '/+$', '') AS url FROM u0
      QUALIFY row_number() OVER (PARTITION BY source_rank, regexp_replace(url, '/+$', '') ORDER BY source_rank, line_no, match_no) = 1"""),
]
# Prior run, derived from the link table: links of the first list were collected before,
# links written with a capitalised owner had failed (the sets overlap, exercising J2's priority rule).
PRIOR_CTES = [
    ("prior_ok", "SELECT key FROM md_links WHERE source_rank = 0"),
    ("prior_failed", "SELECT key FROM md_links WHERE owner <> lower(owner)"),
]
LINK_COLS = "source, source_rank, line_no, match_no, repo_url, owner, repo, name, description, key"


def _links(spark, sf):
    return lk.md_links(fixture(spark, sf, "v_md_lines"))


def _prior(spark, sf):
    links = _links(spark, sf)
    return (links.filter(F.col("source_rank") == 0).select("key"),
            links.filter(F.col("owner") != F.lower("owner")).select("key"))


@register("md_links", with_views(["v_md_lines"], MD_LINKS_CTES) + f"SELECT {LINK_COLS} FROM md_links")
def q_md_links(spark, sf):
    return _links(spark, sf)


@register("dedup_links", with_views(["v_md_lines"], MD_LINKS_CTES) + f"SELECT {LINK_COLS} FROM dedup")
def q_dedup_links(spark, sf):
    return lk.dedup_links(_links(spark, sf))


@register("limit_links", with_views(["v_md_lines"], MD_LINKS_CTES) +
          f"SELECT {LINK_COLS} FROM dedup ORDER BY source_rank, line_no, match_no LIMIT 100")
def q_limit_links(spark, sf):
    return lk.limit_links(lk.dedup_links(_links(spark, sf)), 100)


@register("url_scan", with_views(["v_md_lines"], URL_CTES) + "SELECT source, source_rank, line_no, match_no, url FROM urls")
def q_url_scan(spark, sf):
    return lk.url_scan(fixture(spark, sf, "v_md_lines")).select("source", "source_rank", "line_no", "match_no", "url")


@register("dedup_urls", with_views(["v_md_lines"], URL_CTES) + """
SELECT source, source_rank, line_no, match_no, url FROM urls
QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, line_no, match_no) = 1""")
def q_dedup_urls(spark, sf):
    return lk.limit_lists(lk.url_scan(fixture(spark, sf, "v_md_lines")), None) \
        .select("source", "source_rank", "line_no", "match_no", "url")


@register("limit_lists", with_views(["v_md_lines"], URL_CTES + [
    ("per_list", "SELECT source_rank, count(*) AS n FROM urls GROUP BY source_rank"),
    ("taken", """SELECT source_rank FROM (SELECT source_rank, coalesce(sum(n) OVER (ORDER BY source_rank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM per_list) WHERE before < 1000"""),
]) + """
SELECT source, source_rank, line_no, match_no, url FROM urls WHERE source_rank IN (SELECT source_rank FROM taken)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, line_no, match_no) = 1
ORDER BY source_rank, line_no, match_no LIMIT 1000""")
def q_limit_lists(spark, sf):
    return lk.limit_lists(lk.url_scan(fixture(spark, sf, "v_md_lines")), 1000) \
        .select("source", "source_rank", "line_no", "match_no", "url")


@register("raw_url", with_views(["v_md_lines"], [
    ("u", "SELECT line_no, regexp_extract(line, '(https?://\\S+)', 1) AS url FROM v_md_lines"),
    ("c", "SELECT line_no, url, replace(replace(url, 'github.com', 'raw.githubusercontent.com'), '/blob/', '/') AS conv FROM u"),
]) + """
SELECT line_no, url, CASE WHEN contains(url, 'github.com') AND NOT contains(url, 'raw') THEN
    CASE WHEN contains(conv, '/main/README.md') OR contains(conv, '/master/README.md') THEN conv
         ELSE regexp_replace(conv, '/+$', '') || '/main/README.md' END ELSE url END AS raw_url
FROM c""")
def q_raw_url(spark, sf):
    lines = fixture(spark, sf, "v_md_lines")
    u = F.regexp_extract("line", r"(https?://\S+)", 1)
    return lines.select("line_no", u.alias("url")).withColumn("raw_url", lk.raw_url("url"))


@register("fetch_union", with_views(["v_md_lines", "v_search_items"], URL_CTES + [
    ("aw", """SELECT url, string_split(url, '/')[4] AS owner, string_split(url, '/')[5] AS name
              FROM urls QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, line_no, match_no) = 1"""),
]) + """
SELECT url, owner, name, stars, language, 'github' AS origin FROM v_search_items
UNION ALL
SELECT url, owner, replace(name, '.git', '') AS name, 0 AS stars, NULL AS language, 'awesome' AS origin FROM aw""")
def q_fetch_union(spark, sf):
    gh = fixture(spark, sf, "v_search_items").select("url", "owner", "name", "stars", "language") \
        .withColumn("origin", F.lit("github"))
    urls = lk.limit_lists(lk.url_scan(fixture(spark, sf, "v_md_lines")), None)
    aw = lk.urls_to_repos(urls).select("url", "owner", "name", "stars").withColumn("origin", F.lit("awesome"))
    return lk.fetch_union(gh, aw).select("url", "owner", "name", "stars", "language", "origin")


# ---------------------------------------------------------------- collection
@register("new_repos", with_views(["v_md_lines"], MD_LINKS_CTES + PRIOR_CTES) + f"""
SELECT {LINK_COLS} FROM dedup WHERE key NOT IN (SELECT key FROM prior_ok UNION SELECT key FROM prior_failed)""")
def q_new_repos(spark, sf):
    ok, failed = _prior(spark, sf)
    from quarry.operators.core import anti_join_on_key
    return anti_join_on_key(lk.dedup_links(_links(spark, sf)), ok.unionByName(failed), key="key")


@register("merge_prior", with_views(["v_md_lines"], MD_LINKS_CTES + PRIOR_CTES) + """
SELECT key, CASE WHEN bool_and(failed) THEN 'failed' ELSE 'collected' END AS status,
       CASE WHEN bool_or(failed) THEN 'failed' ELSE 'collected' END AS legacy_status
FROM (SELECT key, false AS failed FROM prior_ok UNION ALL SELECT key, true FROM prior_failed) GROUP BY key""")
def q_merge_prior(spark, sf):
    ok, failed = _prior(spark, sf)
    a = co.merge_prior(ok, failed)
    b = co.merge_prior(ok, failed, legacy=True).withColumnRenamed("status", "legacy_status")
    return a.join(b, "key")


@register("resolve_readme", with_views(["v_readme_samples", "v_fetches"], [
    ("cand", """SELECT repo_url, r AS rank, 'https://raw.githubusercontent.com/' || owner || '/' || repo
                || ['/main/README.md', '/master/README.md', '/main/readme.md', '/master/readme.md'][r] AS url
                FROM v_readme_samples, range(1, 5) t(r)"""),
]) + """
SELECT c.repo_url, arg_min(f.body, c.rank) AS readme, CAST(min(c.rank) AS INT) AS rank
FROM cand c JOIN v_fetches f ON f.url = c.url WHERE f.status = 200 GROUP BY c.repo_url""")
def q_resolve_readme(spark, sf):
    repos = fixture(spark, sf, "v_readme_samples")
    return co.resolve_readme(repos, fixture(spark, sf, "v_fetches"), key="repo_url").select("repo_url", "readme", "rank")


COLLECT_CTES = [
    ("kept", "SELECT * FROM v_readme_samples WHERE length(readme) >= 500"),
    ("collected", f"""SELECT k.repo_url, k.owner, k.repo, k.name, k.description, {TYPE_CASE.format(c='k.readme')} AS project_type,
        k.language, coalesce(k.stars, 0) AS stars, k.readme, CAST(length(k.readme) AS INT) AS readme_length,
        coalesce(t.file_tree, []::VARCHAR[]) AS file_tree, CAST(len(coalesce(t.file_tree, []::VARCHAR[])) AS INT) AS file_count, k.source
        FROM kept k LEFT JOIN v_repo_trees t ON t.repo_id = k.files_repo_id"""),
]


def _collect(spark, sf):
    samples = fixture(spark, sf, "v_readme_samples")
    trees = fixture(spark, sf, "v_repo_trees")
    return co.collect_samples(samples, trees, min_length=500)


@register("collect", with_views(["v_readme_samples", "v_repo_trees"], COLLECT_CTES) + """
SELECT repo_url, owner, repo, name, description, project_type, language, stars, readme_length,
       array_to_string(file_tree, '|') AS file_tree, file_count, source FROM collected""")
def q_collect(spark, sf):
    out, _ = _collect(spark, sf)
    return out.select("repo_url", "owner", "repo", "name", "description", "project_type", "language", "stars",
                      "readme_length", F.array_join("file_tree", "|").alias("file_tree"), "file_count", "source")


@register("collect_split", with_views(["v_readme_samples"]) + """
SELECT repo_url, coalesce(length(readme) >= 500, false) AS kept FROM v_readme_samples""")
def q_collect_split(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    kept, failed = co.split_by_length(s, "readme", min_length=500)
    return kept.select("repo_url", F.lit(True).alias("kept")).unionByName(
        failed.select("repo_url", F.lit(False).alias("kept")))


@register("type_histogram", with_views(["v_readme_samples", "v_repo_trees"], COLLECT_CTES) + """
SELECT project_type, CAST(count(*) AS BIGINT) AS samples, CAST(NULL AS BIGINT) AS avg_readme_length FROM collected GROUP BY project_type
UNION ALL
SELECT '*', CAST(count(*) AS BIGINT), CAST(floor(sum(readme_length) / count(*)) AS BIGINT) FROM collected""")
def q_type_histogram(spark, sf):
    out, _ = _collect(spark, sf)
    return co.type_histogram(out)


@register("collect_report", with_views(["v_readme_samples", "v_repo_trees"], COLLECT_CTES) + """
SELECT (SELECT count(*) FROM v_readme_samples) AS total_repos, (SELECT count(*) FROM collected) AS collected,
       (SELECT count(*) FROM v_readme_samples) - (SELECT count(*) FROM collected) AS failed""")
def q_collect_report(spark, sf):
    samples = fixture(spark, sf, "v_readme_samples")
    out, failed = _collect(spark, sf)
    return co.collect_report(samples, out, failed)
