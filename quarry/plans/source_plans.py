"""Registered queries: readers and sinks (S1, S2, S7-S10, K1) and the request stream.

Queries whose input is a file layout (JSON envelopes, a repository folder, a
message folder) first have Spark write that layout from the driver tables into a
fresh folder under the session's checkpoint directory, then read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import repos as rp
from quarry.operators.collect import split_by_length
from quarry.operators.pages import page_index
from quarry.operators.sketches import sketch_anti_join
from quarry.plans.repo_plans import LANG_CASE, PF, TYPE_AGG, TYPE_CASE, lang_agg
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.session import materialize, stage_path
from quarry.sources import io
from quarry.sources.deltas import CountedTable
from quarry.sources.fixtures import fixture
from quarry.sources.tables import table
from quarry.sources.snapshots import Snapshots, drop_invalid_cached, load_prior
from quarry.streaming.requests import JSON_OPTIONS, answers, start_requests


def scratch(spark: SparkSession, name: str) -> str:
    return stage_path(spark, name, "quarry-scratch")


#: A written array file holds about so many bytes of READMEs, whatever its source's size.
FILE_BYTES = 4 << 20


def _file_numbers(s: DataFrame, column: str, least: int = 1) -> DataFrame:
    """``column``: each sample's file within its source, by hash; a source has files by its total size."""
    files = F.ceil(F.sum(F.coalesce(F.octet_length("readme"), F.lit(0)) + 256) / FILE_BYTES)
    totals = s.groupBy(F.col("source").alias("_source")).agg(F.greatest(files, F.lit(least)).alias("_files"))
    return s.join(totals, F.col("source").eqNullSafe(F.col("_source"))) \
        .withColumn(column, F.pmod(F.xxhash64("source", "doc_id"), F.col("_files"))).drop("_source", "_files")


def _write_collection(spark, sf) -> str:
    s = _file_numbers(fixture(spark, sf, "v_readme_samples").select(
        "repo_url", "owner", "repo", "name", "description", "language", F.col("stars").cast("long").alias("stars"),
        "readme", "source", "doc_id"), "bucket", least=4)
    root = scratch(spark, "collection")
    sample = F.struct(*[c for c in s.columns if c not in ("bucket", "doc_id")])
    # two of four files are envelopes, the others arrays; each (source, bucket) is one row, so one single-line file
    texts = s.groupBy("source", "bucket").agg(F.collect_list(sample).alias("training_data"))
    envelope = F.to_json(F.struct(F.struct(F.col("source").alias("list")).alias("metadata"), "training_data"))
    texts.select("source", "bucket", F.when(F.col("bucket") % 4 < 2, envelope).otherwise(F.to_json("training_data")).alias("value")) \
        .write.partitionBy("source", "bucket").text(root)
    return root


@register("scan_collection", with_views(["v_readme_samples"]) + """
SELECT repo_url, owner, repo, name, description, language, CAST(stars AS BIGINT) AS stars, readme, source FROM v_readme_samples""")
def q_scan_collection(spark, sf):
    """Envelope files and top-level-array files read by one reader, each by as many tasks as it has splits."""
    return io.read_collection(spark, _write_collection(spark, sf)).select("repo_url", "owner", "repo", "name", "description", "language", "stars", "readme", "source")


@register("scan_samples", with_views(["v_readme_samples"]) + "SELECT repo_url, owner, repo, readme FROM v_readme_samples")
def q_scan_samples(spark, sf):
    """A directory of one-sample files plus an unreadable file (skipped)."""
    s = fixture(spark, sf, "v_readme_samples").select("repo_url", "owner", "repo", "readme", "doc_id", "source", "language")
    root = scratch(spark, "samples")
    js = F.to_json(F.struct("repo_url", "owner", "repo", "readme"))
    # German documents of the first source get a file each; the rest array files per source
    single = F.coalesce((F.col("language") == "de") & (F.col("source") == "src0"), F.lit(False))
    one = s.filter(single).select(F.col("doc_id").cast("string").alias("file"), F.lit(0).cast("long").alias("number"), js.alias("value"))
    arr = _file_numbers(s.filter(~single), "number").groupBy(F.col("source").alias("file"), "number").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(js), ","), F.lit("]")).alias("value"))
    bad = spark.createDataFrame([("bad", 0, "{not json")], "file string, number long, value string")
    one.unionByName(arr).unionByName(bad).write.partitionBy("file", "number").text(root)
    return io.read_collection(spark, root).select("repo_url", "owner", "repo", "readme")


@register("scan_repo_files", """
SELECT 'source=' || coalesce(source, '__HIVE_DEFAULT_PARTITION__') AS repo_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents""")
def q_scan_repo_files(spark, sf):
    """Every file under a folder tree (one folder per source) read by the binary-file source, line by line."""
    root = scratch(spark, "repos")
    table(spark, sf, "documents").select("source", "text").write.partitionBy("source").text(root)
    files = io.scan_repo_files(spark, root)
    text = F.substring(F.col("content"), F.lit(1), F.length("content") - 1)     # a text ends with a line break in its file
    return files.filter(F.col("length") > 0).select("repo_id", F.explode(F.split(text, "\n")).alias("line"))


TREE_CTE = ("pt", """SELECT repo_id, path, NOT (contains(path, '.git') OR contains(path, 'node_modules') OR contains(path, '__pycache__')
        OR contains(path, '.venv') OR contains(path, 'venv') OR contains(path, '.pytest_cache') OR contains(path, '.mypy_cache')) AS keep
        FROM v_repo_files""")


def _tree_responses(spark, sf):
    f = fixture(spark, sf, "v_repo_files")
    item = F.struct("path", F.lit("blob").alias("type"))
    # repositories with a src/ folder answer on 'main'; the others only on 'master' (root files only)
    main = f.groupBy("repo_id").agg(F.to_json(F.struct(F.collect_list(item).alias("tree"))).alias("body"),
                                    F.bool_or(F.col("path").startswith("src/")).alias("_src")) \
        .select("repo_id", F.lit("main").alias("branch"), F.when(F.col("_src"), 200).otherwise(404).alias("status"), "body")
    master = f.filter(~F.col("path").contains("/")).groupBy("repo_id").agg(
        F.to_json(F.struct(F.collect_list(item).alias("tree"))).alias("body")) \
        .select("repo_id", F.lit("master").alias("branch"), F.lit(200).alias("status"), "body")
    return main.unionByName(master)


@register("file_tree", with_views(["v_repo_files"], [TREE_CTE]) + """
SELECT r.repo_id, coalesce(array_to_string(list_sort(list(p.path) FILTER (WHERE p.keep AND (r.has_src OR NOT contains(p.path, '/')))), '|'), '') AS file_tree
FROM (SELECT repo_id, bool_or(starts_with(path, 'src/')) AS has_src FROM v_repo_files GROUP BY repo_id) r
LEFT JOIN pt p ON p.repo_id = r.repo_id GROUP BY r.repo_id, r.has_src""")
def q_file_tree(spark, sf):
    t = io.file_tree(_tree_responses(spark, sf))
    return t.select("repo_id", F.array_join("file_tree", "|").alias("file_tree"))


@register("repo_info", with_views(["v_search_items"]) + """
SELECT url, language, CASE WHEN language IS NULL THEN 0 ELSE stars END AS stars, coalesce(description, '') AS description,
       array_to_string(topics, '|') AS topics FROM v_search_items""")
def q_repo_info(spark, sf):
    s = fixture(spark, sf, "v_search_items")
    # answers for repositories of unknown language carry no star count (the key is absent)
    body = F.to_json(F.struct("language", F.when(F.col("language").isNotNull(), F.col("stars")).alias("stargazers_count"),
                              "description", "topics", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at")))
    r = io.repo_info(s.select("url", body.alias("body")))
    return r.select("url", "language", F.col("stars").cast("int").alias("stars"), "description",
                    F.array_join("topics", "|").alias("topics"))


def _rank_in_query(s: DataFrame) -> DataFrame:
    """``_r``: each row's place in its query by (stars descending, url), from 0. Rows are dealt by ranges of that order
    and written, so that a range keeps its rows; a place is the place within the range after the rows of earlier ranges."""
    s = materialize(s.repartitionByRange("query_no", F.col("stars").desc(), "url").withColumn("_range", F.spark_partition_id()), "search-ranges")
    earlier = Window.partitionBy("query_no").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = s.groupBy("query_no", "_range").agg(F.count("*").alias("_n")) \
        .select(F.col("query_no").alias("_query"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))    # a row a range and query
    within = Window.partitionBy("_range", "query_no").orderBy(F.col("stars").desc(), "url")
    return s.withColumn("_r", F.row_number().over(within)) \
        .join(before, F.col("query_no").eqNullSafe(F.col("_query")) & (F.col("_range") == F.col("_of"))) \
        .withColumn("_r", F.col("_r") - 1 + F.col("_before")).drop("_query", "_of", "_before", "_range")


@register("search_items", with_views(["v_search_items"]) + """
SELECT query_no, CAST((rank - 1) // 100 AS BIGINT) AS page, CAST((rank - 1) % 100 AS INT) AS item_no, url, owner, name,
       CAST(stars AS BIGINT) AS stars, language, coalesce(description, '') AS description, array_to_string(topics, '|') AS topics
FROM (SELECT *, row_number() OVER (PARTITION BY query_no ORDER BY stars DESC, url) AS rank FROM v_search_items)""")
def q_search_items(spark, sf):
    s = fixture(spark, sf, "v_search_items")
    s = _rank_in_query(s).withColumn("page", (F.col("_r") / 100).cast("long"))
    item = F.struct(F.col("_r").alias("_r"), F.col("url").alias("html_url"), "name", F.struct(F.col("owner").alias("login")).alias("owner"),
                    F.col("stars").alias("stargazers_count"), "language", "description", "topics",
                    F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"))
    pages = s.groupBy("query_no", "page").agg(F.array_sort(F.collect_list(item)).alias("_items")) \
        .select("query_no", "page", F.to_json(F.struct(F.transform("_items", lambda x: x.dropFields("_r")).alias("items"))).alias("body"))
    out = io.search_items(pages)
    return out.select("query_no", "page", F.col("item_no").cast("int").alias("item_no"), "url", "owner", "name", "stars", "language",
                      "description", F.array_join("topics", "|").alias("topics"))


@register("append_new", with_views(["v_readme_samples"]) + "SELECT repo_url FROM v_readme_samples WHERE NOT (length(readme) >= 500)")
def q_append_new(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    stored = s.filter(F.length("readme") >= 500)
    return io.append_new(s, stored, key="repo_url").select("repo_url")


@register("sketch_anti_join", with_views(["v_readme_samples"]) + "SELECT repo_url, stars FROM v_readme_samples WHERE NOT (length(readme) >= 500)")
def q_sketch_anti_join(spark, sf):
    """Samples that the store does not hold; only those that its sketch may hold are joined with it."""
    s = fixture(spark, sf, "v_readme_samples")
    return sketch_anti_join(s.select("repo_url", "stars"), s.filter(F.length("readme") >= 500), key="repo_url")


STREAM_SQL = with_views(["v_repo_files"], [PF, ("summ", f"""SELECT repo_id, {TYPE_CASE} AS project_type, {LANG_CASE} AS project_language,
        file_count FROM (SELECT repo_id, {TYPE_AGG}, {lang_agg(False)}, count(*) AS file_count FROM pf GROUP BY repo_id)""")]) + """
SELECT e.event_id AS request_id, e.user_id AS repo_id, e.event_type AS kind, e.ts,
       CASE WHEN s.project_type IS NOT NULL THEN printf('Generate documentation for repository %d (%s, %s, %d files).',
            e.user_id, s.project_type, s.project_language, s.file_count) END AS prompt,
       CASE WHEN s.project_type IS NULL THEN 'unknown repository' ELSE 'ready' END AS status
FROM events e LEFT JOIN summ s ON s.repo_id = e.user_id"""


@register("stream_requests", STREAM_SQL)
def q_stream_requests(spark, sf):
    """Events as JSON messages -> file stream -> repository summaries -> idempotent sink."""
    src, sink, ckpt = scratch(spark, "requests"), scratch(spark, "answers"), scratch(spark, "ckpt")
    ev = table(spark, sf, "events")
    ev.select(F.to_json(F.struct(F.col("event_id").alias("request_id"), F.col("user_id").alias("repo_id"),
                                 F.col("event_type").alias("kind"), "ts"), JSON_OPTIONS).alias("value")).write.text(src)
    summaries = rp.repo_summary(fixture(spark, sf, "v_repo_files"))
    q = start_requests(spark, src, summaries, sink=sink, checkpoint=ckpt)
    q.awaitTermination()
    return answers(spark, sink)


@register("load_prior", with_views(["v_readme_samples"]) + """
SELECT repo_url, stars, CASE WHEN length(readme) >= 500 THEN 'succeeded' ELSE 'failed' END AS part FROM v_readme_samples""")
def q_load_prior(spark, sf):
    """A collection run committed as one snapshot of two tables, and loaded again as the prior run."""
    ok, failed = split_by_length(fixture(spark, sf, "v_readme_samples").select("repo_url", "stars", "readme"))
    runs = Snapshots(spark, scratch(spark, "runs"))
    runs.commit({"succeeded": ok, "failed": failed})
    ok, failed = load_prior(runs)
    return ok.select("repo_url", "stars", F.lit("succeeded").alias("part")).unionByName(failed.select("repo_url", "stars", F.lit("failed").alias("part")))


@register("drop_invalid_cached", with_views(["v_readme_samples"]) + """
SELECT repo_url, 'now' AS at FROM v_readme_samples WHERE length(readme) >= 500 AND stars >= 100
UNION ALL SELECT repo_url, 'before' FROM v_readme_samples WHERE length(readme) >= 500""")
def q_drop_invalid_cached(spark, sf):
    """Cached repositories with too few stars go in a new snapshot; the one before stays readable under its backup's name."""
    samples = fixture(spark, sf, "v_readme_samples").select("repo_url", "stars", "readme")
    runs = Snapshots(spark, scratch(spark, "runs"))
    number = runs.commit({"succeeded": samples.filter(F.length("readme") >= 500)})
    drop_invalid_cached(runs, samples.filter(F.col("stars") >= 100))
    now, before = runs.read("succeeded"), runs.read("succeeded", f"before-{number + 1}")
    return now.select("repo_url", F.lit("now").alias("at")).unionByName(before.select("repo_url", F.lit("before").alias("at")))


@register("sample_pages", with_views(["v_readme_samples"]) + """
SELECT repo_url, stars, CAST((r - 1) // 50 AS BIGINT) AS page, CAST((r - 1) % 50 AS INT) AS place
FROM (SELECT repo_url, stars, row_number() OVER (ORDER BY stars DESC NULLS LAST, repo_url) AS r FROM v_readme_samples)""")
def q_sample_pages(spark, sf):
    """Every page of the samples, most stars first, through the index of ranges."""
    samples = fixture(spark, sf, "v_readme_samples").select("repo_url", "stars")
    return page_index(samples, [("stars", True), ("repo_url", False)]).numbered(50)


@register("report_deltas", with_views(["v_readme_samples"]) + """
SELECT language, source, count(*) AS n FROM v_readme_samples WHERE stars >= 100 GROUP BY language, source""")
def q_report_deltas(spark, sf):
    """A10: a report carried over an append and a removal by the parts that changed."""
    s = fixture(spark, sf, "v_readme_samples").select("repo_url", "language", "source", "stars")
    kept = CountedTable(spark, scratch(spark, "counted"), s.schema, ["language", "source"])
    first = kept.append(s.filter(F.col("stars") < 500))
    report = kept.report(first)
    kept.append(s.filter("stars >= 500 OR stars IS NULL"))
    kept.remove(s.filter("stars < 100 OR stars IS NULL"), "repo_url")
    return kept.updated(report, first)
