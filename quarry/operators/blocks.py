"""Marker-block documents: block parsing (T7), API headings / code examples (T8),
two- and three-mode merges (M1, M2) and the incremental text merge (M3).

A document is rebuilt per row: ``split`` by the block pattern gives the text
between blocks, ``regexp_extract_all`` the blocks; each block is rendered by a
``transform`` and the pieces are re-joined. New blocks arrive as an
``array<struct<name, content>>`` column (built from a long table with a
bounded per-document ``collect_list``). No shuffle except that grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import urstrip, ustrip

def _strip(c: Column) -> Column:
    return ustrip(c)


def block_pattern(marker: str = "DOC", modes=("AUTO", "MANUAL")) -> str:
    """T7 pattern: ``<!-- {marker}_MODE:name vN -->...<!-- {marker}_MODE_END:name -->``
    (DOTALL, non-greedy, the end tag names the same block)."""
    m = "|".join(modes)
    return (rf"(?sU)<!--\s*{marker}_({m}):(\w+)\s+v(\d+)\s*-->(.*?)"
            rf"<!--\s*{marker}_({m})_END:\2\s*-->")


BLOCK_TYPE = "array<struct<mode:string,name:string,version:int,content:string,full_match:string>>"


def parse_blocks(text: Column, marker: str = "DOC", modes=("AUTO", "MANUAL")) -> Column:
    """Blocks in document order (content stripped)."""
    p = F.lit(block_pattern(marker, modes))
    z = F.arrays_zip(
        F.regexp_extract_all(text, p, 1).alias("mode"), F.regexp_extract_all(text, p, 2).alias("name"),
        F.regexp_extract_all(text, p, 3).alias("version"), F.regexp_extract_all(text, p, 4).alias("content"),
        F.regexp_extract_all(text, p, 0).alias("full_match"))
    return F.transform(z, lambda b: F.struct(
        b["mode"].alias("mode"), b["name"].alias("name"), b["version"].try_cast("long").alias("version"),
        _strip(b["content"]).alias("content"), b["full_match"].alias("full_match")))


def _tag(marker: str, mode, name: Column, version: Column, content: Column) -> Column:
    mode = F.lit(mode) if isinstance(mode, str) else mode
    return F.concat(F.lit(f"<!-- {marker}_"), mode, F.lit(":"), name, F.lit(" v"), version.cast("string"), F.lit(" -->\n"),
                    content, F.lit(f"\n<!-- {marker}_"), mode, F.lit("_END:"), name, F.lit(" -->"))


# API heading, python fence, API section (body up to the next heading or fence) and title patterns.
API_HEADING = r"###\s+([\w\.]+)\([^)]*\)"
PY_FENCE = r"(?s)```python\n(.*?)\n```"
API_SECTION = r"(?sU)###\s+([\w\.]+)\([^)]*\)\s*\n(.*?)(?=\n###|\n```|$)"
TITLE = r"(?mU)^##\s+(.+)$"


def api_headings(text: Column) -> Column:
    """Distinct API names of ``### name(...)`` headings."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?U)" + API_HEADING), 1))


def code_examples(text: Column) -> Column:
    """Bodies of python code fences, in order."""
    return F.regexp_extract_all(text, F.lit(PY_FENCE), 1)


def incremental_merge(user: Column, new: Column) -> Column:
    """M3: user title; sorted union of APIs with the body from the new text, else the
    user's; code examples de-duplicated (by stripped text), user's first."""
    apis = F.array_sort(F.array_union(api_headings(user), api_headings(new)))

    def sections(t):
        return F.arrays_zip(F.regexp_extract_all(t, F.lit(API_SECTION), 1).alias("api"),
                            F.regexp_extract_all(t, F.lit(API_SECTION), 2).alias("body"))

    su, sn = sections(user), sections(new)

    def body(api):
        bn = F.try_element_at(F.filter(sn, lambda s: s["api"] == api), F.lit(1))
        bu = F.try_element_at(F.filter(su, lambda s: s["api"] == api), F.lit(1))
        return F.coalesce(bn["body"], bu["body"])

    api_lines = F.flatten(F.transform(apis, lambda a: F.when(body(a).isNull(), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("### "), a, F.lit("()")), _strip(body(a)), F.lit(""))))).alias("x")
    exs = F.concat(code_examples(user), code_examples(new))
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("seen"))
    uniq = F.aggregate(exs, zero, lambda acc, x: F.when(F.array_contains(acc["seen"], _strip(x)), acc).otherwise(
        F.struct(F.concat(acc["out"], F.array(x)).alias("out"), F.concat(acc["seen"], F.array(_strip(x))).alias("seen"))),
        lambda acc: acc["out"])
    ex_lines = F.when(F.size(uniq) > 0, F.concat(F.array(F.lit("## Examples"), F.lit("")), F.flatten(F.transform(
        uniq, lambda e: F.array(F.lit("```python"), _strip(e), F.lit("```"), F.lit("")))))).otherwise(F.array().cast("array<string>"))
    title = F.regexp_extract(user, TITLE, 1)
    has_title = user.rlike(TITLE)
    title_lines = F.when(has_title, F.array(F.concat(F.lit("## "), title), F.lit(""))).otherwise(F.array().cast("array<string>"))
    return _strip(F.array_join(F.concat(title_lines, api_lines, ex_lines), "\n"))


def merge_document(existing: Column, new_blocks: Column, *, policy: str = "two_mode", auto_detect: bool = True,
                   marker: str = "DOC") -> Column:
    """M1/M2: the merged document text for one row.

    ``new_blocks``: ``array<struct<name, content>>`` in insertion order.
    """
    modes = ("AUTO", "MANUAL") if policy == "two_mode" else ("AUTO", "MANUAL", "INCREMENTAL")
    pat = block_pattern(marker, modes)
    blocks = parse_blocks(existing, marker, modes)
    segs = F.split(existing, pat, -1)
    nb = F.coalesce(new_blocks, F.array().cast("array<struct<name:string,content:string>>"))

    def new_of(name):
        return F.try_element_at(F.filter(nb, lambda x: x["name"] == name), F.lit(1))["content"]

    def render(b):
        new = new_of(b["name"])
        changed = F.lit(auto_detect) & (_strip(new) != _strip(b["content"]))
        auto_next = _tag(marker, "AUTO", b["name"], b["version"] + 1, new)
        if policy == "two_mode":
            on_change = _tag(marker, "MANUAL", b["name"], b["version"], b["content"])
            incremental = b["full_match"]
        else:
            merged = incremental_merge(b["content"], new)
            on_change = _tag(marker, "INCREMENTAL", b["name"], b["version"], merged)
            incremental = F.when(new.isNotNull(), _tag(marker, "INCREMENTAL", b["name"], b["version"] + 1, merged)) \
                .otherwise(b["full_match"])
        return (F.when((b["mode"] == "AUTO") & new.isNotNull(), F.when(changed, on_change).otherwise(auto_next))
                .when(b["mode"] == "INCREMENTAL", incremental)
                .otherwise(b["full_match"]))

    n = F.size(blocks)
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                    lambda i: F.concat(F.try_element_at(segs, i), render(F.try_element_at(blocks, i)))), "")
    names = F.transform(blocks, lambda b: b["name"])
    appended = F.array_join(F.transform(F.filter(nb, lambda x: ~F.array_contains(names, x["name"])),
                                        lambda x: F.concat(F.lit("\n"), _tag(marker, "AUTO", x["name"], F.lit(1), x["content"]))), "")
    rebuilt = F.concat(body, F.try_element_at(segs, F.lit(-1)), appended)
    fresh = F.concat(urstrip(existing), F.lit("\n\n"),
                     F.array_join(F.transform(nb, lambda x: F.concat(_tag(marker, "AUTO", x["name"], F.lit(1), x["content"]),
                                                                    F.lit("\n\n"))), ""))
    return F.when(n == 0, fresh).otherwise(rebuilt)


def new_blocks_by_doc(new_blocks: DataFrame, *, doc: str = "doc_id", name: str = "block_name",
                      content: str = "new_content", order: str) -> DataFrame:
    """Long table of new blocks -> ``(doc, new_blocks array)``; a document's block list is bounded.

    Blocks stand in ``order``; a repeated name keeps its first place and its last content.
    """
    once = new_blocks.groupBy(doc, name).agg(F.min(order).alias("_o"), F.max_by(content, order).alias(content))
    g = once.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("_o", F.col(name).alias("name"),
                                                                   F.col(content).alias("content")))).alias("_b"))
    return g.select(doc, F.transform("_b", lambda x: F.struct(x["name"].alias("name"), x["content"].alias("content")))
                    .alias("new_blocks"))


def merge_blocks(docs: DataFrame, new_blocks: DataFrame | None = None, *, policy: str = "two_mode",
                 auto_detect: bool = True, marker: str = "DOC", doc: str = "doc_id", existing: str = "existing",
                 order: str = "block_no") -> DataFrame:
    """J8 + M1/M2: documents with their new blocks merged (``merged`` column); ``order`` orders a long table of new blocks."""
    d = docs
    if new_blocks is not None:
        d = docs.join(new_blocks_by_doc(new_blocks, doc=doc, order=order), doc, "left")
    return d.withColumn("merged", merge_document(F.col(existing), F.col("new_blocks"), policy=policy,
                                                 auto_detect=auto_detect, marker=marker))
