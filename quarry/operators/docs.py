"""Documentation helpers: file-tree rendering (P21, two styles), README prompts (P19),
component/connection bullets (P20), code-fence extraction (P22), content guard and
architecture page (P23), batch document generation (C6).

Trees are built without collecting a repository's file list: directory entries are
exploded from paths, sibling order and "last child" flags come from windows over
(repo, parent), and only the capped lines (<= ``max_lines`` / ``max_files`` per
repo, a partial ``WindowGroupLimit``) are joined into text.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import ustrip

from quarry.operators.core import quota_per_group

from quarry._workers import ship_by_value

ship_by_value(__name__)

# Names skipped when listing a repository directory for review.
REVIEW_TREE_SKIP = ["node_modules", "__pycache__", ".git", "venv", "env", "dist", "build"]
BRANCH, LAST, PIPE, BLANK = "├── ", "└── ", "│   ", "    "


def _tree_entries(paths: DataFrame, max_depth: int) -> DataFrame:
    """``(repo, lvl, name, dfs)`` of the files and directories that can be listed, ``dfs`` being the order of the listing."""
    parts = paths.select("repo", F.split("path", "/", -1).alias("parts"))
    # only the first max_depth + 1 components can be listed: at most that many rows per file
    ent = parts.select("repo", "parts", F.posexplode(F.slice("parts", 1, max_depth + 1)).alias("lvl", "name"))
    ent = ent.withColumn("is_dir", F.col("lvl") < F.size("parts") - 1) \
        .withColumn("anc", F.slice("parts", 1, F.col("lvl") + 1))
    bad = F.exists(F.col("anc"), lambda p: p.startswith(".") | p.isin(REVIEW_TREE_SKIP))
    ent = ent.filter(~bad).select("repo", "anc", "is_dir").distinct() \
        .withColumn("lvl", F.size("anc") - 1).withColumn("name", F.element_at("anc", -1))
    dfs = F.transform(F.col("anc"), lambda p, i: F.struct(
        ((i == F.col("lvl")) & ~F.col("is_dir")).alias("f"), F.lower(p).alias("l"), p.alias("n")))
    return ent.select("repo", "lvl", "name", dfs.alias("dfs"))


def render_tree(files: DataFrame, *, max_depth: int = 3, max_lines: int = 200, repo: str = "repo_id") -> DataFrame:
    """P21 (review style): directory listing, directories before files, case-insensitive
    name order, hidden and build folders skipped, ``max_depth`` levels below the root,
    first ``max_lines`` lines. Returns ``(repo, tree)``.

    Paths are shuffled once, by repository; what is made of them stays in its task, so that entries, which are longer, are not written to disk."""
    paths = files.filter(F.col(repo).isNotNull()).select(F.col(repo).alias("repo"), "path").repartition("repo")
    listed = quota_per_group(_tree_entries(paths, max_depth), group="repo", quota=max_lines, order=["dfs"], rank_col="line_no").drop("dfs")
    # An entry is its directory's last child if the next entry that is not deeper stands higher, or there is none. Where lines are cut off, the
    # next one of each depth among these is needed, too: it is among the first max_lines + 1 of its level, as all before it are listed.
    # A repository with few paths has no more entries than lines.
    n = F.count(F.lit(1)).over(Window.partitionBy("repo"))
    long = paths.withColumn("n", n).filter(F.col("n") * (max_depth + 1) > max_lines).drop("n")
    kept = quota_per_group(_tree_entries(long, max_depth), group=["repo", "lvl"], quota=max_lines + 1, order=["dfs"])
    cut = kept.withColumn("no", F.row_number().over(Window.partitionBy("repo").orderBy("dfs"))).filter(F.col("no") > max_lines)
    next_cut = F.array(*[F.min_by(F.when(F.col("lvl") <= k, F.col("lvl")), F.when(F.col("lvl") <= k, F.col("no"))) for k in range(max_depth + 1)])
    cut = cut.groupBy("repo").agg(next_cut.alias("cut"))
    below = Window.partitionBy("repo").orderBy(F.col("line_no").desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = F.array(*[F.last(F.when(F.col("lvl") <= k, F.col("lvl")), ignorenulls=True).over(below) for k in range(max_depth + 1)])
    ranked = listed.withColumn("next", following).join(cut.hint("merge"), "repo", "left")
    ranked = ranked.withColumn("is_last", F.coalesce(F.coalesce(F.col("next")[F.col("lvl")], F.col("cut")[F.col("lvl")]) < F.col("lvl"), F.lit(True)))
    # in this order an entry's ancestors are the nearest lines above it, one on each level; their last-child flags give the indentation
    above = Window.partitionBy("repo").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = [F.last(F.when((F.col("lvl") == k), F.when(F.col("is_last"), F.lit(BLANK)).otherwise(F.lit(PIPE))), ignorenulls=True).over(above) for k in range(max_depth)]
    prefix = [F.when(F.col("lvl") > k, m).otherwise("") for k, m in enumerate(marks)]
    line = F.concat(*prefix, F.when(F.col("is_last"), F.lit(LAST)).otherwise(F.lit(BRANCH)), F.col("name"))
    ranked = ranked.select("repo", "line_no", line.alias("line"))
    return ranked.groupBy("repo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))),
                                                               lambda x: x["line"]), "\n").alias("tree")) \
        .withColumnRenamed("repo", repo)


def format_file_tree(files: DataFrame, *, max_depth: int = 3, max_files: int = 100, repo: str = "repo_id") -> DataFrame:
    """P21 (prompt style): files sorted by path parts, hidden parts (except ``.env.example``),
    ``__pycache__`` and ``.git`` skipped, at most ``max_depth`` parts, first ``max_files``
    files; a directory line precedes the first file under it; a file is drawn with the
    last-branch connector when no later listed file lies under its parent."""
    p = files.select(F.col(repo).alias("repo"), F.split("path", "/", -1).alias("parts"))
    keep = ~F.exists("parts", lambda x: (x.startswith(".") & (x != ".env.example")) | x.isin("__pycache__", ".git"))
    p = p.filter(keep & (F.size("parts") <= max_depth))
    top = quota_per_group(p, group="repo", quota=max_files, order=["parts"], rank_col="rank")
    # in this order the files under a directory follow each other, so a file's neighbours tell which directories it opens and
    # whether it is the last one under its parent
    near = Window.partitionBy("repo").orderBy("rank")
    top = top.withColumn("before", F.lag("parts").over(near)).withColumn("after", F.lead("parts").over(near))
    n = F.size("parts")

    def under(other, k):
        """Whether another file stands below this one's first ``k`` parts (the root: none)."""
        return F.coalesce((F.size(other) > k) & (F.slice(other, 1, k) == F.slice("parts", 1, k)), F.lit(False))

    opened = F.filter(F.sequence(F.lit(0), n - 1), lambda k: (k > 0) & ~under("before", k))
    dir_lines = F.transform(opened, lambda k: F.concat(F.repeat(F.lit(PIPE), k - 1), F.lit(BRANCH), F.element_at("parts", k), F.lit("/")))
    conn = F.when(under("after", n - 1), F.lit(BRANCH)).otherwise(F.lit(LAST))
    file_line = F.concat(F.repeat(F.lit(PIPE), n - 1), conn, F.element_at("parts", -1))
    lines = top.select("repo", "rank", F.array_join(F.concat(dir_lines, F.array(file_line)), "\n").alias("lines"))
    out = lines.groupBy("repo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "lines"))),
                                                             lambda x: x["lines"]), "\n").alias("tree"))
    repos = files.select(F.col(repo).alias("repo")).distinct()
    return repos.join(out.hint("merge"), "repo", "left").select(F.col("repo").alias(repo), F.coalesce("tree", F.lit("")).alias("tree"))


def graph_bullets(components: DataFrame, connections: DataFrame, *, repo: str = "repo_id") -> DataFrame:
    """P20: ``- name (type)`` and ``- from → to`` bullet lists per repository (in order)."""
    c = components.groupBy(repo).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("component_no", F.concat(F.lit("- "), "name", F.lit(" ("), "type", F.lit(")")).alias("t")))),
        lambda x: x["t"]), "\n").alias("components_text"))
    e = connections.groupBy(repo).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("file_no", "imp_no", F.concat(F.lit("- "), F.col("from"), F.lit(" → "), F.col("to")).alias("t")))),
        lambda x: x["t"]), "\n").alias("connections_text"))
    return c.join(e, repo, "full_outer")


def fence_extract(text: Column) -> Column:
    """The body of the first ``mermaid`` fence, else of the first fence, else the text; stripped."""
    t = ustrip(text)
    merm = F.substring_index(F.try_element_at(F.split(t, "```mermaid", -1), F.lit(2)), "```", 1)
    anyf = F.substring_index(F.try_element_at(F.split(t, "```", -1), F.lit(2)), "```", 1)
    body = F.when(t.contains("```mermaid"), merm).when(t.contains("```"), anyf).otherwise(t)
    return ustrip(body)


# README-style phrases that an architecture explanation must not contain.
EXPLANATION_BANNED = ["how to use", "installation", "clone the repository", "pip install", "usage examples",
                      "command-line", "configuration options"]
DOC_BANNED = ["how to use", "installation", "clone", "pip install", "usage examples", "command-line", "configuration",
              "project structure", "contributing", "license", "how this project works"]
FINAL_BANNED = ["how to use", "installation", "usage examples", "project structure", "contributing", "license",
                "how this project works", "command-line example"]
FALLBACK_EXPLANATION = ("This architecture consists of the components shown in the diagram above, with data flowing "
                        "between them as indicated by the arrows.")


def _has_any(c: Column, words) -> Column:
    low = F.lower(c)
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def content_guard(explanation: Column) -> Column:
    """P23 (first guard): README-like explanation -> fixed fallback text."""
    return F.when(_has_any(explanation, EXPLANATION_BANNED), F.lit(FALLBACK_EXPLANATION)).otherwise(explanation)


def architecture_doc(diagram: Column, explanation: Column, as_of: Column) -> Column:
    """Architecture page = title, timestamp, mermaid block, overview; README-like
    explanations and pages fall back to the fixed explanation."""
    expl = F.when(_has_any(explanation, DOC_BANNED), F.lit(FALLBACK_EXPLANATION)).otherwise(explanation)

    def page(e):
        return F.concat(F.lit("# Architecture Diagram\nLast updated: "), as_of, F.lit("\n\n```mermaid\n"), diagram,
                        F.lit("\n```\n\n## Overview\n\n"), e, F.lit("\n"))
    doc = page(expl)
    return F.when(_has_any(doc, FINAL_BANNED), page(F.lit(FALLBACK_EXPLANATION))).otherwise(doc)


PROMPT_TEMPLATE = ("Write a README.md for this repository.\n\nProject name: {name}\nProject type: {type}\n"
                   "Description: {description}\n\nFile tree:\n```\n{tree}\n```\n\nKey files:\n{key_files}\n\n"
                   "Code samples:\n{samples}\n")


def doc_prompts(files: DataFrame, summary: DataFrame, *, names: DataFrame | None = None, repo: str = "repo_id",
                sample_lines: int = 30, max_samples: int = 3) -> DataFrame:
    """Per repository the generation prompt: name/description (defaults), file tree
    (depth 4, 80 files), key-file list, up to three key-file heads of 30 lines.

    Joins are told to merge: a row per repository, or per key file, is too much to broadcast."""
    from quarry.operators.sft import file_head

    tree = format_file_tree(files, max_depth=4, max_files=80, repo=repo)
    kf = summary.select(repo, "project_type", F.posexplode(F.map_entries("key_files")).alias("k_no", "kv")) \
        .select(repo, "project_type", "k_no", F.col("kv.key").alias("key"), F.col("kv.value").alias("path"))
    heads = kf.filter(F.col("k_no") < max_samples).join(files.select(repo, "path", "content").hint("merge"), [repo, "path"]) \
        .select(repo, "k_no", F.concat(F.lit("\n### "), "key", F.lit(" ("), "path", F.lit("):\n```\n"),
                                       file_head(F.col("content"), sample_lines), F.lit("\n```")).alias("s"))
    samples = heads.groupBy(repo).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k_no", "s"))),
                                                               lambda x: x["s"]), "\n").alias("samples"))
    keys = kf.groupBy(repo).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k_no", "key", "path"))),
                                                         lambda x: F.concat(F.lit("- "), x["key"], F.lit(": "), x["path"])), "\n").alias("key_list"))
    base = summary.select(repo, "project_type")
    if names is not None:
        base = base.join(names, repo, "left")
    for c in ("name", "description"):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("string"))
    out = base.join(tree.hint("merge"), repo, "left").join(keys.hint("merge"), repo, "left").join(samples.hint("merge"), repo, "left")
    name = F.coalesce(F.nullif("name", F.lit("")), F.concat(F.lit("repo-"), F.col(repo).cast("string")))
    desc = F.coalesce(F.nullif("description", F.lit("")), F.lit("No description available"))
    t = PROMPT_TEMPLATE
    pieces = []
    for seg in ["{name}", "{type}", "{description}", "{tree}", "{key_files}", "{samples}"]:
        head, t = t.split(seg, 1)
        pieces.append(F.lit(head))
        pieces.append({"{name}": name, "{type}": F.col("project_type"), "{description}": desc,
                       "{tree}": F.coalesce("tree", F.lit("")),
                       "{key_files}": F.coalesce(F.nullif("key_list", F.lit("")), F.lit("No key files detected")),
                       "{samples}": F.coalesce("samples", F.lit("No code samples available"))}[seg])
    pieces.append(F.lit(t))
    return out.select(repo, name.alias("name"), F.concat(*pieces).alias("prompt"))


def batch_docs(prompts: DataFrame, complete: Callable[[list[str]], list[str]] | None = None, *,
               repo: str = "repo_id") -> DataFrame:
    """One generated document per repository (injected model in Arrow batches);
    a failed or empty answer becomes an ``error`` instead of stopping the job."""
    complete = complete or (lambda ps: [None for _ in ps])
    rtype = prompts.schema[repo].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            docs, errs = [], []
            for prompt in pdf["prompt"]:
                try:
                    answer, err = complete([prompt])[0], "empty answer"
                except Exception as e:  # noqa: BLE001 - a failure is reported for its repository alone
                    answer, err = None, f"model error: {e}"
                docs.append(answer if answer else None)
                errs.append(None if answer else err)
            yield pd.DataFrame({repo: pdf[repo], "doc": docs, "error": errs})

    return prompts.select(repo, "prompt").mapInPandas(run, f"{repo} {rtype}, doc string, error string")


def batch_counts(results: DataFrame) -> DataFrame:
    """C6 summary: succeeded / failed counts."""
    return results.agg(F.count_if(F.col("error").isNull()).alias("succeeded"),
                       F.count_if(F.col("error").isNotNull()).alias("failed"))
