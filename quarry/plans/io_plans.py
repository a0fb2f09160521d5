"""Registered queries: the sinks, dry runs and small gates.

A sink's query writes through the library and returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import links as lk
from quarry.operators import repos as rp
from quarry.operators.core import ordered_limit
from quarry.operators.filterdocs import find
from quarry.operators.sft import structure_suffix
from quarry.plans import links_plans, repo_plans, source_plans  # noqa: F401  (their SQL is wrapped here)
from quarry.plans.registry import ORACLE, register
from quarry.plans.source_plans import scratch
from quarry.plans.sqlkit import with_views
from quarry.sources import io
from quarry.sources.fixtures import fixture
from quarry.sources.tables import table
from quarry.streaming.requests import JSON_OPTIONS, REQUEST_SCHEMA


def _samples(spark, sf):
    return fixture(spark, sf, "v_readme_samples")


@register("load_chunks", with_views(["v_readme_samples"]) + "SELECT repo_url, readme AS chunk FROM v_readme_samples")
def q_load_chunks(spark, sf):
    """S3: chunk files with a ``features`` or a ``data`` array, or the array alone."""
    root = scratch(spark, "chunks")
    s = source_plans._file_numbers(_samples(spark, sf).select("repo_url", F.col("readme").alias("chunk"), "readme", "source", "doc_id"), "number", least=3)
    rows = s.groupBy("source", "number").agg(F.collect_list(F.struct("repo_url", "chunk")).alias("rows"))         # files of bounded size
    shape = F.when(F.col("number") % 3 == 0, F.to_json("rows")).when(F.col("number") % 3 == 1, F.to_json(F.struct(F.col("rows").alias("features")))).otherwise(F.to_json(F.struct(F.col("rows").alias("data"))))
    rows.select("source", "number", shape.alias("value")).write.partitionBy("source", "number").text(root)
    return io.read_collection(spark, root, keys=("features", "data")).select("repo_url", "chunk")


@register("first_source", with_views(["v_readme_samples"]) + "SELECT repo_url, owner, repo FROM v_readme_samples")
def q_first_source(spark, sf):
    """No table and no clean file: the raw collection is read."""
    raw = source_plans._write_collection(spark, sf)
    return io.first_available(spark, [("table", "no_such_store"), ("parquet", scratch(spark, "none")), ("json", raw)]).select("repo_url", "owner", "repo")


@register("write_counts", with_views(["v_readme_samples"]) + """
SELECT count(*) AS rows, CAST(sum(length(readme)) AS BIGINT) AS readme_chars, count(*) AS stored, count(DISTINCT source) AS folders FROM v_readme_samples""")
def q_write_counts(spark, sf):
    """K2: a partitioned dataset sink; the counts are gathered while it is written."""
    path = scratch(spark, "dataset")
    counts = io.write_with_counts(_samples(spark, sf).select("repo_url", "readme", "source"), path, fmt="json", partition_by=["source"], metrics={"readme_chars": F.sum(F.length("readme"))})
    stored = spark.read.schema("repo_url string, readme string, source string").json(path)
    return stored.agg(F.lit(counts["rows"]).cast("long").alias("rows"), F.lit(counts["readme_chars"]).cast("long").alias("readme_chars"), F.count("*").alias("stored"), F.count_distinct("source").alias("folders"))


@register("url_list", with_views(["v_readme_samples"]) + "SELECT repo_url AS url FROM v_readme_samples WHERE stars >= 100")
def q_url_list(spark, sf):
    """K4: one URL per line."""
    path = scratch(spark, "urls")
    io.write_url_list(_samples(spark, sf).filter(F.col("stars") >= 100).select(F.col("repo_url").alias("url")), path)
    return spark.read.text(path).select(F.col("value").alias("url"))


@register("dry_run", with_views(["v_readme_samples"]) + "SELECT count(*) AS would_write FROM v_readme_samples WHERE length(readme) >= 500")
def q_dry_run(spark, sf):
    """K6: what a write would store, without writing."""
    return spark.createDataFrame([(io.dry_run(_samples(spark, sf).filter(F.length("readme") >= 500)),)], "would_write long")


@register("publish_requests", "SELECT event_id AS request_id, user_id AS repo_id, event_type AS kind, ts FROM events")
def q_publish(spark, sf):
    """K8: rows published as JSON messages to a folder, as a consumer reads them."""
    path = scratch(spark, "published")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("request_id"), F.col("user_id").alias("repo_id"), F.col("event_type").alias("kind"), F.date_format("ts", JSON_OPTIONS["timestampNTZFormat"]).alias("ts"))
    io.publish(rows, path=path)
    return spark.read.text(path).select(F.from_json("value", REQUEST_SCHEMA, JSON_OPTIONS).alias("m")).select("m.*")


@register("export_sft", with_views(["v_sft_samples"]) + """
SELECT instruction, output, project_type FROM v_sft_samples WHERE project_type = 'api' AND output IS NOT NULL""")
def q_export_sft(spark, sf):
    """K9: the instruction rows that a filter document asks for, exported and read again."""
    path = scratch(spark, "export")
    rows = fixture(spark, sf, "v_sft_samples").select("instruction", "output", "project_type")
    io.write_dataset(find(rows, {"project_type": "api", "output": {"$ne": None}}), path)
    return spark.read.schema(rows.schema).json(path)


@register("structure_hint", with_views(["v_sft_samples"]) + f"SELECT conv_id, turn, instruction || '{structure_suffix()}' AS prompt FROM v_sft_samples")
def q_structure_hint(spark, sf):
    """Generation prompts with the section hint."""
    return fixture(spark, sf, "v_sft_samples").select("conv_id", "turn", F.concat("instruction", F.lit(structure_suffix())).alias("prompt"))


@register("source_links", f"SELECT * FROM ({ORACLE['md_links']}) WHERE source IN ('list-a', 'list-c')")
def q_source_links(spark, sf):
    """links of some sources only; the restriction comes before the parsing."""
    lines = fixture(spark, sf, "v_md_lines")
    return lk.md_links(lines, sources=["list-a", "list-c"]).select(*[c.strip() for c in links_plans.LINK_COLS.split(",")])


@register("language_gate", f"""
SELECT repo_id, project_language, project_language = 'python' AS allowed,
       CASE WHEN project_language <> 'python' THEN 'only python projects are supported, found: ' || project_language END AS message FROM ({ORACLE['project_language']})""")
def q_language_gate(spark, sf):
    """F16: which repositories may go on to the action."""
    return rp.language_gate(rp.project_language(fixture(spark, sf, "v_repo_files")))


@register("first_chunks", with_views(["v_readme_samples"]) + "SELECT repo_url, length(readme) AS n FROM v_readme_samples ORDER BY repo_url LIMIT 25")
def q_first_chunks(spark, sf):
    """The first rows by an explicit order, for a trial run."""
    return ordered_limit(_samples(spark, sf).select("repo_url", F.length("readme").alias("n")), 25, order=["repo_url"])
