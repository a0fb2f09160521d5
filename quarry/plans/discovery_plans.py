"""Registered queries: discovery filters and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import discovery as dv
from quarry.operators.filterdocs import as_asked, cut_filters, find_table
from quarry.operators.searches import saved_searches
from quarry.plans.registry import register
from quarry.plans.repo_plans import like_any
from quarry.plans.sqlkit import with_views
from quarry.session import materialize
from quarry.sources.fixtures import fixture
from quarry.operators.repos import FINDER_KEYWORDS

TEXT = "lower(concat_ws(' ', name, coalesce(description, ''), array_to_string(coalesce(topics, []::VARCHAR[]), ' ')))"


def pred_sql(min_stars, language=None, project_type=None, negative=None, pushed=True):
    pos, neg = dv.PROJECT_TERMS.get(project_type, ([], []))
    neg = negative if negative is not None else neg
    c = [f"stars >= {min_stars}"]
    if pushed:
        c.append(f"updated_at > CAST('{dv.PUSHED_AFTER}' AS TIMESTAMP)")
    if language:
        c.append(f"lower(language) = '{language.lower()}'")
    if pos:
        c.append(like_any(TEXT, pos))
    if neg:
        c.append("NOT " + like_any(TEXT, neg))
    return " AND ".join(c)


def crawl_sql(language=None, keywords=dv.CRAWL_KEYWORDS, name_keywords=dv.CRAWL_NAME_KEYWORDS):
    kws = ", ".join(f"'{k}'" for k in keywords)
    c = []
    c.append("NOT " + like_any("lower(coalesce(description, ''))", keywords))
    c.append(f"NOT len(list_intersect(list_transform(coalesce(topics, []::VARCHAR[]), lambda t: lower(t)), [{kws}])) > 0")
    c.append("NOT " + like_any("lower(name)", name_keywords))
    if language:
        c.append(f"(coalesce(lower(language), '') = '' OR lower(language) = '{language.lower()}')")
    return "coalesce(" + " AND ".join(c) + ", false)"


COLS = "url, owner, name, stars, language"


def _items(spark, sf):
    return fixture(spark, sf, "v_search_items")


@register("repo_search", with_views(["v_search_items"]) + f"""
SELECT {COLS} FROM v_search_items WHERE {pred_sql(100, 'Python', 'api')}""")
def q_repo_search(spark, sf):
    return _items(spark, sf).filter(dv.search_predicate(min_stars=100, language="Python", project_type="api")).select(*COLS.split(", "))


@register("crawl_filter", with_views(["v_search_items"]) + f"""
SELECT {COLS} FROM v_search_items WHERE {crawl_sql('python')}""")
def q_crawl_filter(spark, sf):
    return _items(spark, sf).filter(dv.crawl_filter("python")).select(*COLS.split(", "))


@register("fresh_repos", with_views(["v_search_items"]) + f"""
SELECT {COLS} FROM v_search_items WHERE updated_at >= CAST('2024-01-01' AS TIMESTAMP) - INTERVAL 24 MONTH""")
def q_fresh_repos(spark, sf):
    return _items(spark, sf).filter(dv.fresh("2024-01-01")).select(*COLS.split(", "))


# parameters for which the strict search finds nothing, so the fallback answers
FB_LANG, FB_TYPE, FB_STARS = "Java", "fullstack", 830
STRICT_SQL = f"""SELECT {COLS}, 'strict' AS origin FROM v_search_items WHERE {pred_sql(FB_STARS, FB_LANG, FB_TYPE)} AND {crawl_sql(FB_LANG.lower())}
   ORDER BY stars DESC, url LIMIT 1000"""
WEAK_SQL = f"""SELECT {COLS}, 'fallback' AS origin FROM v_search_items
   WHERE {pred_sql(FB_STARS, FB_LANG, None, negative=dv.FALLBACK_NEGATIVE)} AND {crawl_sql(None, dv.FALLBACK_KEYWORDS, dv.FALLBACK_NAME_KEYWORDS)}
   ORDER BY updated_at DESC, url LIMIT 100"""


@register("search_fallback", with_views(["v_search_items"], [("strict", STRICT_SQL), ("weak", WEAK_SQL)]) + """
SELECT * FROM strict UNION ALL SELECT * FROM weak WHERE (SELECT count(*) FROM strict) = 0""")
def q_search_fallback(spark, sf):
    r = dv.search_repos(_items(spark, sf), min_stars=FB_STARS, language=FB_LANG, project_type=FB_TYPE, limit=1000)
    return r.select(*COLS.split(", "), "origin")


@register("search_strict", with_views(["v_search_items"]) + f"""
SELECT {COLS}, 'strict' AS origin FROM v_search_items WHERE {pred_sql(50, 'Python', 'api')} AND {crawl_sql('python')}
ORDER BY stars DESC, url LIMIT 1000""")
def q_search_strict(spark, sf):
    r = dv.search_repos(_items(spark, sf), min_stars=50, language="Python", project_type="api", limit=1000)
    return r.select(*COLS.split(", "), "origin")


LANGS = ["Python", "JavaScript", "Go"]


@register("language_quota", with_views(["v_search_items"], [("hits", "SELECT *, CASE lower(language) " + " ".join(
    f"WHEN '{l.lower()}' THEN {i}" for i, l in enumerate(LANGS)) + " END AS lang_no FROM v_search_items WHERE " + " OR ".join(
    f"({pred_sql(100, l, None)} AND {crawl_sql(l)})" for l in LANGS))]) + f"""
SELECT {COLS}, lang_no, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang_no ORDER BY stars DESC, url) AS rank FROM hits) WHERE rank <= {300 // 3}
ORDER BY lang_no, rank LIMIT 300""")
def q_language_quota(spark, sf):
    r = dv.language_quota(_items(spark, sf), LANGS, min_stars=100, limit=300)
    return r.select(*COLS.split(", "), "lang_no", F.col("rank").cast("int").alias("rank"))


FINDER_KW = list(dict.fromkeys(FINDER_KEYWORDS))


@register("query_quota", with_views(["v_search_items"], [
    ("base", f"""SELECT * FROM v_search_items WHERE stars >= 20 AND NOT {like_any(TEXT, dv.FINDER_NEGATIVE)}
        AND NOT ({like_any("lower(coalesce(name, ''))", FINDER_KW)} OR {like_any("lower(coalesce(description, ''))", FINDER_KW)}
                 OR contains(lower(coalesce(owner, '')), 'awesome') OR contains(lower(coalesce(name, '')), 'awesome'))"""),
    ("ranked", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_no ORDER BY stars DESC, url) AS rank FROM base) WHERE rank <= 200 // 6"),
    ("uniq", "SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY url ORDER BY query_no, rank) = 1"),
    ("perq", """SELECT query_no FROM (SELECT query_no, coalesce(sum(n) OVER (ORDER BY query_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT query_no, count(*) AS n FROM uniq GROUP BY query_no)) WHERE before < 200"""),
]) + f"""
SELECT {COLS}, query_no, CAST(rank AS INT) AS rank FROM uniq WHERE query_no IN (SELECT query_no FROM perq)
ORDER BY query_no, rank LIMIT 200""")
def q_query_quota(spark, sf):
    r = dv.query_quota(_items(spark, sf), n_queries=6, min_stars=20, limit=200)
    return r.select(*COLS.split(", "), "query_no", F.col("rank").cast("int").alias("rank"))


ITEM_TEXT = TEXT.replace("name", "i.name").replace("description", "i.description").replace("topics", "i.topics")


@register("saved_searches", with_views(["v_search_items", "v_searches"]) + f"""
SELECT s.search_id, i.url FROM v_searches s JOIN v_search_items i ON i.stars >= s.min_stars AND (s.language IS NULL OR lower(s.language) = lower(i.language))
   AND (s.pushed_after IS NULL OR i.updated_at > s.pushed_after)
WHERE (len(list_filter(s.positive, lambda t: t <> '')) = 0 OR len(list_filter(s.positive, lambda t: t <> '' AND contains({ITEM_TEXT}, lower(t)))) > 0)
  AND len(list_filter(s.negative, lambda t: t <> '' AND contains({ITEM_TEXT}, lower(t)))) = 0""")
def q_saved_searches(spark, sf):
    """F6 for a table of searches, one for each supplier."""
    return saved_searches(_items(spark, sf), fixture(spark, sf, "v_searches"))


@register("filter_table", with_views(["v_search_items"]) + """
SELECT s.s_suppkey AS filter_id, count(*) AS n, min(i.url) AS first_url FROM supplier s JOIN v_search_items i
  ON i.stars >= s.s_suppkey * 7 % 800 AND i.stars < s.s_suppkey * 7 % 800 + 60
WHERE CASE WHEN s.s_suppkey % 6 = 0 THEN i.language IS NULL ELSE coalesce(i.language, '') = split_part('Python|JavaScript|Go|Java|Rust', '|', CAST(1 + s.s_suppkey % 5 AS INT)) END
   OR (coalesce(list_has_any(i.topics, ['web', 'k8s']), false) AND i.description IS NOT NULL)
GROUP BY s.s_suppkey""")
def q_filter_table(spark, sf):
    """F15, A15 for a table of filter documents, one for each supplier."""
    filters = cut_filters(fixture(spark, sf, "v_filters"))
    # items numbered in the order of their URLs, so that the first is found among numbers
    items = _items(spark, sf)
    asked = as_asked(items, filters)
    items = materialize(items.select(F.col("url").alias("_url"), *asked).orderBy("_url").withColumn("_no", F.monotonically_increasing_id()), "filtered-items")
    # items that agree in all that filters read are found together, with their number and the first of them
    alike = items.groupBy(*[c for c in items.columns if c not in ("_url", "_no")]) \
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("_url").isNotNull(), F.col("_no"))).alias("_no")).filter("_n > 0")
    alike = materialize(alike, "items-alike")
    found = find_table(alike, filters, few=alike.count() <= filters.held.count())
    n = found.groupBy("filter_id").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.min("_no").alias("_no"))
    return n.join(items.select("_no", F.col("_url").alias("first_url")).hint("merge"), "_no", "left").select("filter_id", "n", "first_url")
