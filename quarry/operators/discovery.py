"""Repository discovery over landed search results
``search_items(url, owner, name, stars, language, description, topics, updated_at[, query_no])``:
search predicate (F6), crawler filter (F4), staleness (F5), strict-or-fallback (F7),
ordering (L5), per-language and per-query quotas (L3, L4).

Every step is a filter or a ranking window on typed columns, so predicates on
``stars`` / ``language`` / ``updated_at`` reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.core import keep_first, ordered_limit, quota_per_group
from quarry.operators.repos import exclude_flag

# Search terms per project type (any of the positive terms; none of the negative ones).
PROJECT_TERMS = {
    "webapp": (["webapp", "web app", "web application", "full stack", "fullstack"],
               ["framework", "library", "boilerplate", "template", "starter"]),
    "fullstack": (["full stack", "fullstack", "frontend backend", "api server"], ["framework", "library", "boilerplate"]),
    "api": (["api", "rest api", "graphql api", "api server"], ["framework", "library", "sdk", "boilerplate"]),
    None: ([], ["framework", "library", "boilerplate", "template"]),
}
FALLBACK_NEGATIVE = ["framework", "library", "boilerplate"]
PUSHED_AFTER = "2022-01-01"
# Crawler post-filter keywords.
CRAWL_KEYWORDS = ["awesome", "list", "books", "resources", "curated", "collection", "learning", "tutorial", "course",
                  "education", "framework", "library", "boilerplate", "template", "starter", "sdk", "toolkit",
                  "engine", "compiler", "interpreter"]
CRAWL_NAME_KEYWORDS = ["awesome", "list", "framework", "library", "sdk", "toolkit"]
FALLBACK_KEYWORDS = ["awesome", "list", "framework", "library", "boilerplate", "template", "starter", "sdk", "toolkit"]
FALLBACK_NAME_KEYWORDS = ["awesome", "list", "framework", "library"]
FINDER_NEGATIVE = ["awesome", "list", "tutorial", "example", "demo", "boilerplate", "template", "starter"]


def _any_contains(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def search_text(df: DataFrame | None = None) -> Column:
    """Lower-cased text a search term is matched against: name, description, topics."""
    return F.lower(F.concat_ws(" ", F.col("name"), F.coalesce(F.col("description"), F.lit("")),
                               F.array_join(F.coalesce(F.col("topics"), F.array().cast("array<string>")), " ")))


def search_predicate(*, min_stars: int, language: str | None = None, project_type: str | None = None,
                     pushed_after: str | None = PUSHED_AFTER, positive=None, negative=None) -> Column:
    """stars, language, pushed date, project-type OR-terms and negative terms."""
    pos, neg = PROJECT_TERMS.get(project_type, ([], []))
    pos = positive if positive is not None else pos
    neg = negative if negative is not None else neg
    t = search_text()
    cond = F.col("stars") >= min_stars
    if pushed_after:
        cond = cond & (F.col("updated_at") > F.to_timestamp(F.lit(pushed_after)))
    if language:
        cond = cond & (F.lower(F.col("language")) == language.lower())
    if pos:
        cond = cond & _any_contains(t, pos)
    if neg:
        cond = cond & ~_any_contains(t, neg)
    return cond


def crawl_filter(language: str | None = None, *, keywords=CRAWL_KEYWORDS, name_keywords=CRAWL_NAME_KEYWORDS) -> Column:
    """keep when the language agrees (both known), no keyword in the description,
    no topic equal to a keyword, no name keyword."""
    desc = F.lower(F.coalesce(F.col("description"), F.lit("")))
    topics = F.transform(F.coalesce(F.col("topics"), F.array().cast("array<string>")), lambda t: F.lower(t))
    name = F.lower(F.col("name"))
    ok = ~_any_contains(desc, keywords) & ~F.arrays_overlap(topics, F.array(*[F.lit(k) for k in keywords])) \
        & ~_any_contains(name, name_keywords)
    if language:
        lang = F.lower(F.coalesce(F.col("language"), F.lit("")))
        ok = ok & ((lang == "") | (lang == language.lower()))
    return F.coalesce(ok, F.lit(False))


def fresh(as_of: str, years: int = 2) -> Column:
    """updated within ``years`` of ``as_of`` (explicit date; the reference's check never applied)."""
    return F.col("updated_at") >= F.add_months(F.to_timestamp(F.lit(as_of)), -12 * years)


def stars_order() -> list[Column]:
    """Stars descending, URL as the unique tiebreak (built lazily: no Column at import time)."""
    return [F.col("stars").desc(), F.col("url")]


def search_repos(items: DataFrame, *, min_stars: int = 100, language: str | None = None,
                 project_type: str | None = None, limit: int | None = None, as_of: str | None = None,
                 fallback: bool = True) -> DataFrame:
    """F4-F7 + L5: strict search, post-filter, sort by stars; when the strict result is empty
    and a project type was asked, the weaker fallback (sorted by update time).

    The switch is a join with a one-row count (broadcast): no driver round trip.
    """
    strict = items.filter(search_predicate(min_stars=min_stars, language=language, project_type=project_type))
    strict = strict.filter(crawl_filter(language))
    if as_of:
        strict = strict.filter(fresh(as_of))
    strict = strict.withColumn("origin", F.lit("strict"))
    strict = ordered_limit(strict, limit, order=stars_order()) if limit else strict
    if not (fallback and project_type):
        return strict
    weak = items.filter(search_predicate(min_stars=min_stars, language=language, project_type=None,
                                         negative=FALLBACK_NEGATIVE))
    weak = weak.filter(crawl_filter(None, keywords=FALLBACK_KEYWORDS, name_keywords=FALLBACK_NAME_KEYWORDS))
    weak = ordered_limit(weak, limit, order=[F.col("updated_at").desc(), F.col("url")]) if limit else weak
    weak = weak.withColumn("origin", F.lit("fallback"))
    empty = strict.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0").select(F.lit(1).alias("_k"))
    weak = weak.withColumn("_k", F.lit(1)).join(F.broadcast(empty), "_k").drop("_k")
    return strict.unionByName(weak)


def language_quota(items: DataFrame, languages, *, limit: int, min_stars: int = 100,
                   project_type: str | None = None) -> DataFrame:
    """L3: per language ``limit // len(languages)`` best repositories (by stars), concatenated
    in language order, cut at ``limit``."""
    q = limit // len(languages)
    lang_rank = F.create_map(*[x for i, l in enumerate(languages) for x in (F.lit(l.lower()), F.lit(i))])
    cond = None
    for l in languages:
        c = search_predicate(min_stars=min_stars, language=l, project_type=project_type) & crawl_filter(l)
        cond = c if cond is None else cond | c
    hits = items.filter(cond).withColumn("lang_no", lang_rank[F.lower(F.col("language"))])
    ranked = quota_per_group(hits, group="lang_no", quota=q, order=stars_order(), rank_col="rank")
    return ordered_limit(ranked, limit, order=["lang_no", "rank"])


def query_quota(items: DataFrame, *, n_queries: int, min_stars: int = 20, limit: int = 200) -> DataFrame:
    """L4: per query (``query_no``) the first ``limit // n_queries`` repositories by stars
    after the finder's exclusions; URL keep-first across queries in query order; queries
    after the one that reaches ``limit`` unique repositories are not read; cut at ``limit``."""
    q = limit // n_queries
    base = items.filter((F.col("stars") >= min_stars) & ~_any_contains(search_text(), FINDER_NEGATIVE))
    base = base.filter(~exclude_flag(F.col("name"), F.col("description"), F.col("owner")))
    ranked = quota_per_group(base, group="query_no", quota=q, order=stars_order(), rank_col="rank")
    uniq = keep_first(ranked, key="url", order=["query_no", "rank"])
    per_q = uniq.groupBy("query_no").agg(F.count(F.lit(1)).alias("_new"))
    w = Window.orderBy("query_no").rowsBetween(Window.unboundedPreceding, -1)
    per_q = per_q.withColumn("_before", F.coalesce(F.sum("_new").over(w), F.lit(0)))
    read = per_q.filter(F.col("_before") < limit).select("query_no")
    return ordered_limit(uniq.join(read, "query_no"), limit, order=["query_no", "rank"])
