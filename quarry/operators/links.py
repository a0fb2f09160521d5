"""Link discovery: markdown link parsing (T1), URL scanning (T2), first-seen
de-duplication (D1, D2), limits (L1, L2), URL -> repo rows (U2), source union (U1).

Inputs are line tables ``(source, source_rank, line_no, line)``; a whole
markdown document is turned into one with :func:`split_lines`. Parsing is a
per-row ``regexp_extract_all`` + ``posexplode`` (no shuffle); only the
keep-first steps shuffle, on the repository key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import owner_repo, ustrip
from quarry.operators.core import keep_first, ordered_limit

# Markdown link to a repository; the rest of the line is captured in a look-ahead.
MD_LINK = r"(?U)\]\s*\(\s*https://github\.com/([^/]+)/([^)/#?]+)[^)]*\)"
# Fixed value: bare repository URL as found by the list crawler.
REPO_URL = r"(?U)https://github\.com/[\w\-\.]+/[\w\-\.]+"
# Line breaks recognised by Python's ``str.splitlines``.
LINE_BREAKS = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def split_lines(docs: DataFrame, content: str = "content", *, keep=("source", "source_rank")) -> DataFrame:
    """Markdown documents -> one row per line with a 1-based ``line_no``."""
    return docs.select(*keep, F.posexplode(F.split(F.col(content), LINE_BREAKS, -1)).alias("line_no", "line")) \
        .withColumn("line_no", F.col("line_no") + 1)


def md_links(lines: DataFrame, *, sources=None) -> DataFrame:
    """Repository links of every line with owner, repo, description and ``match_no``.

    Owner ``github.com`` is skipped. The description is the rest of the line
    after the link when it starts with '-' (leading dashes removed), else ''.
    """
    if sources is not None:
        lines = lines.filter(F.col("source").isin(list(sources)))
    pat = MD_LINK + r"(?=(.*)$)"
    m = lines.select(
        "source", "source_rank", "line_no",
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all("line", F.lit(pat), 1).alias("owner"),
            F.regexp_extract_all("line", F.lit(pat), 2).alias("repo"),
            F.regexp_extract_all("line", F.lit(pat), 3).alias("rest"),
        )).alias("match_no", "m"))
    rest = ustrip(F.col("m.rest"))
    desc = F.when(rest.startswith("-"), ustrip(F.regexp_replace(rest, "^-+", ""))).otherwise(F.lit(""))
    owner, repo = F.col("m.owner"), F.regexp_replace(F.col("m.repo"), "/+$", "")
    out = m.select(
        "source", "source_rank", "line_no", F.col("match_no").cast("int").alias("match_no"),
        F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo).alias("repo_url"),
        owner.alias("owner"), repo.alias("repo"),
        F.concat(owner, F.lit("/"), repo).alias("name"),
        desc.alias("description"),
        F.lower(F.concat(owner, F.lit("/"), repo)).alias("key"),
    )
    return out.filter((F.lower("owner") != "github.com") & (F.col("repo") != ""))


LINK_ORDER = ["source_rank", "line_no", "match_no"]


def dedup_links(links: DataFrame, *, key: str = "key") -> DataFrame:
    """First occurrence of every (lower-case) repo key across lists in source order."""
    return keep_first(links, key=key, order=LINK_ORDER)


def limit_links(links: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` de-duplicated links in list order."""
    return ordered_limit(links, n, order=LINK_ORDER)


def url_scan(lines: DataFrame) -> DataFrame:
    """Every bare repository URL, first-seen distinct (case-sensitive) within a list."""
    m = lines.select("source", "source_rank", "line_no",
                     F.posexplode(F.regexp_extract_all("line", F.lit(REPO_URL), 0)).alias("match_no", "url"))
    m = m.withColumn("url", F.regexp_replace("url", "/+$", "")).withColumn("match_no", F.col("match_no").cast("int"))
    return keep_first(m, key=["source_rank", "url"], order=LINK_ORDER)


def limit_lists(urls: DataFrame, limit: int | None) -> DataFrame:
    """L2: read lists in order until the raw URL total reaches ``limit``; then
    de-duplicate across lists (first seen wins) and keep the first ``limit``.

    The per-list count table has one row per list (size-bounded), so the
    running total is computed on it and broadcast back.
    """
    if not limit:
        return keep_first(urls, key="url", order=LINK_ORDER)
    per_list = urls.groupBy("source_rank").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("source_rank").rowsBetween(Window.unboundedPreceding, -1)
    per_list = per_list.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    taken = urls.join(per_list.filter(F.col("_before") < limit).select("source_rank"), "source_rank")
    return ordered_limit(keep_first(taken, key="url", order=LINK_ORDER), limit, order=LINK_ORDER)


def urls_to_repos(urls: DataFrame, url: str = "url") -> DataFrame:
    """URL -> (url, owner, name, stars 0, has_readme); unparsable URLs are dropped."""
    p = owner_repo(F.col(url), legacy_git_strip=True)
    return urls.withColumn("_p", p).filter(F.col("_p.error").isNull()).select(
        "*", F.col("_p.owner").alias("owner"), F.col("_p.repo").alias("name"),
        F.lit(0).alias("stars"), F.lit(True).alias("has_readme")).drop("_p")


def fetch_union(github: DataFrame, awesome: DataFrame) -> DataFrame:
    """Both sources concatenated without de-duplication (columns by name)."""
    return github.unionByName(awesome, allowMissingColumns=True)


def raw_url(url) -> "F.Column":
    """List URL -> raw-content URL (host swap, drop ``/blob/``, default ``/main/README.md``)."""
    u = F.col(url) if isinstance(url, str) else url
    conv = F.regexp_replace(F.regexp_replace(u, "github\\.com", "raw.githubusercontent.com"), "/blob/", "/")
    has_branch = conv.contains("/main/README.md") | conv.contains("/master/README.md")
    conv = F.when(has_branch, conv).otherwise(F.concat(F.regexp_replace(conv, "/+$", ""), F.lit("/main/README.md")))
    return F.when(u.contains("github.com") & ~u.contains("raw"), conv).otherwise(u)
