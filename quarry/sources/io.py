"""Readers and writers for the reference's on-disk shapes.

Readers (S1-S3, S7-S10, S12) return lazy DataFrames with fixed schemas; writers
(K1-K6, K9) never overwrite in place: every run writes a new path or appends
only rows whose key is new.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import path_excluded

from quarry._workers import ship_by_value
from quarry.sources.jsonarrays import json_records

ship_by_value(__name__)

SAMPLE_FIELDS = [
    T.StructField("repo_url", T.StringType()), T.StructField("owner", T.StringType()),
    T.StructField("repo", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("project_type", T.StringType()),
    T.StructField("language", T.StringType()), T.StructField("stars", T.LongType()),
    T.StructField("readme", T.StringType()), T.StructField("readme_length", T.LongType()),
    T.StructField("file_tree", T.ArrayType(T.StringType())), T.StructField("file_count", T.LongType()),
    T.StructField("source", T.StringType()),
    # SFT / chunk shapes share the reader; ``input`` stays raw JSON text (string or object)
    T.StructField("chunk", T.StringType()), T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()), T.StructField("content", T.StringType()),
    T.StructField("output", T.StringType()),
]
SAMPLE_SCHEMA = T.StructType(SAMPLE_FIELDS)
ENVELOPE_KEYS = ("training_data", "samples", "features", "data")


def read_collection(spark: SparkSession, path: str, *, keys=ENVELOPE_KEYS) -> DataFrame:
    """JSON files holding a top-level array of samples, an envelope whose
    ``training_data`` / ``samples`` / ``features`` / ``data`` array holds them, or a single
    sample object. A directory is read as a whole. Large files are read by many tasks (``jsonarrays``).

    Files that end inside a value give nothing (``read_collection_broken`` lists them); nor do records that are no object or hold
    none of a sample's fields for a syntax error. A record with one mistyped field (e.g. "stars": "12") keeps its others, as an untyped reader would."""
    schema = T.StructType([*SAMPLE_FIELDS, T.StructField("_corrupt_record", T.StringType())])
    records, _ = json_records(spark, path, tuple(keys))
    rows = records.select(F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("s")).filter(F.col("s").isNotNull()).select("s.*")
    any_field = F.coalesce(*[F.col(c).cast("string") for c in ("repo_url", "readme", "chunk", "instruction", "content", "output")]).isNotNull()
    return rows.filter(F.col("_corrupt_record").isNull() | any_field).drop("_corrupt_record")


def read_collection_broken(spark: SparkSession, path: str, *, keys=ENVELOPE_KEYS) -> DataFrame:
    """The files (``file``) that ``read_collection`` takes nothing from because they end inside a value."""
    return json_records(spark, path, tuple(keys))[1]


def scan_repo_files(spark: SparkSession, root: str, *, depth: int = 1) -> DataFrame:
    """Every file under ``root/<repo>/...`` as ``(repo_id, path, content, length)``;
    ``path`` is relative to the repository folder (``depth`` = folder levels naming the repo);
    the content of a file that isn't UTF-8 is null."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", r"^[a-z]+:", ""), "^/*\\Q" + base.lstrip("/") + "\\E/", "")
    parts = F.split(rel, "/", -1)
    return raw.select(F.array_join(F.slice(parts, 1, depth), "/").alias("repo_id"),
                      F.array_join(F.slice(parts, F.lit(depth + 1), F.size(parts)), "/").alias("path"),
                      F.try_validate_utf8(F.col("content").cast("string")).alias("content"), F.col("length"))


TREE_SCHEMA = "struct<tree: array<struct<path: string, type: string>>>"


def file_tree(responses: DataFrame, *, key: str = "repo_id", by_segment: bool = False) -> DataFrame:
    """Landed git-tree answers ``(key, branch, status, body)`` -> sorted blob paths
    without excluded paths; the ``main`` answer if it was found, else ``master``, else []."""
    ok = responses.filter(F.col("status") == 200).withColumn(
        "_rank", F.when(F.col("branch") == "main", 0).when(F.col("branch") == "master", 1))
    ok = ok.filter(F.col("_rank").isNotNull())
    best = ok.groupBy(key).agg(F.min_by("body", "_rank").alias("body"))
    items = F.from_json("body", TREE_SCHEMA)["tree"]
    blobs = F.filter(items, lambda x: (x["type"] == "blob") & ~path_excluded(x["path"], by_segment))
    keys = responses.select(key).distinct()
    out = keys.join(best, key, "left")
    return out.select(key, F.coalesce(F.array_sort(F.transform(blobs, lambda x: x["path"])),
                                      F.array().cast("array<string>")).alias("file_tree"))


INFO_SCHEMA = ("struct<language: string, stargazers_count: bigint, description: string, topics: array<string>, "
               "created_at: string, updated_at: string>")


def repo_info(responses: DataFrame, *, body: str = "body") -> DataFrame:
    """Repository-info JSON projected with defaults for missing keys (stars 0, topics [],
    description ''); a key present with ``null`` stays null, as with ``dict.get``."""
    j = F.from_json(F.col(body), INFO_SCHEMA)
    keys = F.coalesce(F.json_object_keys(F.col(body)), F.array().cast("array<string>"))

    def get(field, value, default):
        # a missing key takes the default; a key present with null stays null
        return F.when(F.array_contains(keys, field), value).otherwise(default)

    return responses.select("*", j.alias("_j")).select(
        *[c for c in responses.columns if c != body],
        F.col("_j.language").alias("language"),
        get("stargazers_count", F.col("_j.stargazers_count"), F.lit(0).cast("bigint")).alias("stars"),
        get("description", F.col("_j.description"), F.lit("")).alias("description"),
        get("topics", F.col("_j.topics"), F.array().cast("array<string>")).alias("topics"),
        F.col("_j.created_at").alias("created_at"), F.col("_j.updated_at").alias("updated_at"))


SEARCH_SCHEMA = ("struct<items: array<struct<html_url: string, name: string, owner: struct<login: string>, "
                 "stargazers_count: bigint, language: string, description: string, topics: array<string>, "
                 "updated_at: string>>>")


def search_items(pages: DataFrame, *, body: str = "body", keep=("query_no", "page")) -> DataFrame:
    """Search-result pages -> one row per item (url, owner, name, stars, language, description, topics)."""
    it = pages.select(*keep, F.posexplode(F.from_json(F.col(body), SEARCH_SCHEMA)["items"]).alias("item_no", "i"))
    return it.select(*keep, "item_no", F.col("i.html_url").alias("url"), F.col("i.owner.login").alias("owner"),
                     F.col("i.name").alias("name"), F.col("i.stargazers_count").alias("stars"),
                     F.col("i.language").alias("language"), F.coalesce(F.col("i.description"), F.lit("")).alias("description"),
                     F.coalesce(F.col("i.topics"), F.array().cast("array<string>")).alias("topics"),
                     F.to_timestamp(F.col("i.updated_at")).alias("updated_at"))


def append_new(new: DataFrame, existing: DataFrame | None, *, key: str = "repo_url", order=None) -> DataFrame:
    """K1 (idempotent form): rows of ``new`` whose key is not stored yet, one a key: the first by
    ``order`` (columns), or by a hash of the row."""
    from quarry.operators.core import keep_first

    new = keep_first(new, key=key, order=order or [F.xxhash64(*new.columns)])
    if existing is None:
        return new
    return new.join(existing.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def stored_at(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """What a sink holds, or None before its first write; any other failure to read is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_to(df: DataFrame, path: str, *, key: str | None = "repo_url", fmt: str = "parquet", order=None) -> int:
    """K1 sink: append (one row for each new key when ``key`` is given); returns how many rows were written."""
    rows = append_new(df, stored_at(df.sparkSession, path, fmt), key=key, order=order) if key else df
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt).save(path)
    return seen.get["rows"]


def write_dataset(df: DataFrame, path: str, *, fmt: str = "json", partition_by=None) -> None:
    """K2/K3/K9: write a dataset (JSON lines or Parquet); ``partition_by`` gives one folder per value."""
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_url_list(df: DataFrame, path: str, *, url: str = "url") -> None:
    """K4: one URL per line."""
    df.select(url).write.mode("errorifexists").text(path)


def backup_path(base: str) -> str:
    """K5: a fresh versioned path for a snapshot (never overwrite in place)."""
    return f"{base.rstrip('/')}/backup-{uuid.uuid4().hex[:12]}"


def dry_run(df: DataFrame) -> int:
    """K6: the number of rows a write would produce."""
    return df.count()


def first_available(spark: SparkSession, candidates) -> DataFrame:
    """The first source that exists, e.g. ``[("table", name), ("json", clean_path), ("json", raw_path)]``.

    Existence is tested by creating the (lazy) DataFrame: a missing table or path
    raises at analysis time and the next candidate is tried.
    """
    from pyspark.errors import AnalysisException

    errors = []
    for kind, where in candidates:
        try:
            if kind == "table":
                return spark.table(where)
            if kind == "parquet":
                return spark.read.parquet(where)
            return read_collection(spark, where)
        except AnalysisException as e:  # not there: try the next source
            errors.append(f"{kind}:{where}: {str(e).splitlines()[0]}")
    raise FileNotFoundError("no readable source: " + "; ".join(errors))


def write_with_counts(df: DataFrame, path: str, *, fmt: str = "json", partition_by=None,
                      metrics: dict | None = None) -> dict:
    """K2: write a dataset and return its counts gathered while writing (``observe``),
    e.g. ``{"rows": n}`` plus any extra named aggregate — no second pass over the data."""
    from pyspark.sql import Observation

    obs = Observation("quarry_write")
    aggs = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in (metrics or {}).items()]
    write_dataset(df.observe(obs, *aggs), path, fmt=fmt, partition_by=partition_by)
    return dict(obs.get)


def publish(df: DataFrame, *, path: str | None = None, kafka: dict | None = None, key: str | None = None) -> None:
    """K8: publish rows as JSON messages — to a Kafka topic (``kafka`` holds the writer
    options, e.g. bootstrap servers and topic) or, without a broker, to a folder of JSON lines."""
    cols = [c for c in df.columns]
    msg = df.select(*([F.col(key).cast("string").alias("key")] if key else []),
                    F.to_json(F.struct(*cols)).alias("value"))
    if kafka:
        w = msg.write.format("kafka")
        for k, v in kafka.items():
            w = w.option(k, v)
        w.save()
    else:
        msg.select("value").write.mode("errorifexists").text(path)
