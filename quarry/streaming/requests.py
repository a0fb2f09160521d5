"""Request stream (X1, X2): JSON request messages -> parse -> one message for each id -> stream-static join
with repository summaries -> prompt text -> answers, a folder for each micro-batch.

Which ids were seen is kept in the stream's state and expires ``remember`` after a message arrived, so a
micro-batch costs the same however much was answered before. A micro-batch that is run again writes its own folder
again. A flow whose offsets were lost is a new flow: it leaves out what older flows have answered at its start.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize
from quarry.sources.io import stored_at

REQUEST_SCHEMA = "request_id long, repo_id long, kind string, ts timestamp_ntz"
# message timestamps (wall-clock, no zone) keep microseconds; Spark's default JSON format stops at milliseconds
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_requests(spark: SparkSession, path: str | None = None, *, fmt: str = "text",
                  max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Streaming source of JSON messages in a ``value`` column: a folder of JSON lines
    (``fmt='text'``) or a durable queue such as ``fmt='kafka'`` (``options`` carries the
    broker and topic settings and its ``maxOffsetsPerTrigger``)."""
    r = spark.readStream.format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    raw = r.load(path) if path else r.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_requests(messages: DataFrame) -> DataFrame:
    """``value`` and the message's fields; a message that isn't a request has a null ``request_id``."""
    return messages.select("value", F.from_json(F.col("value"), REQUEST_SCHEMA, JSON_OPTIONS).alias("m")).select("value", "m.*")


def enrich_requests(requests: DataFrame, summaries: DataFrame, prompts: DataFrame | None = None) -> DataFrame:
    """Stream-static left join on the repository id; unknown repositories are answered with a
    status. With ``prompts(repo_id, prompt)`` (the P19 README prompts) the request carries that
    prompt; otherwise a short prompt built from the repository summary."""
    s = summaries.select("repo_id", "project_type", "project_language", "file_count")
    j = requests.join(s, "repo_id", "left")
    prompt = F.when(F.col("project_type").isNotNull(), F.format_string(
        "Generate documentation for repository %d (%s, %s, %d files).", F.col("repo_id"), F.col("project_type"),
        F.col("project_language"), F.col("file_count")))
    if prompts is not None:
        j = j.join(prompts.select("repo_id", F.col("prompt").alias("_p19")), "repo_id", "left")
        prompt = F.when(F.col("project_type").isNotNull(), F.coalesce(F.col("_p19"), prompt))
    return j.select("request_id", "repo_id", "kind", "ts", prompt.alias("prompt"),
                    F.when(prompt.isNull(), F.lit("unknown repository")).otherwise(F.lit("ready")).alias("status"))


ANSWER = ["request_id", "repo_id", "kind", "ts", "prompt", "status"]


def answers(spark: SparkSession, sink: str) -> DataFrame:
    """What the flows into ``sink`` have answered."""
    return spark.read.parquet(sink).select(*ANSWER)


def _flow_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives as long as the checkpoint does."""
    path = f"{checkpoint.rstrip('/')}/flow-id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    # starts with a letter that no number starts with: it becomes a folder's partition value, whose type Spark infers
    spark.createDataFrame([(f"r{uuid.uuid4().hex[:12]}",)], "value string").write.text(path)
    return spark.read.text(path).first()[0]


def once_each(messages: DataFrame, remember: str = "7 days") -> DataFrame:
    """Parsed messages without those whose ``request_id`` arrived before, within ``remember``; what is no request is always kept.

    The watermark runs on the time of arrival, so a message with an old timestamp is not late.
    """
    parsed = parse_requests(messages).withColumn("arrived", F.current_timestamp())
    key = F.coalesce(F.concat(F.lit("id "), F.col("request_id").cast("string")), F.expr("uuid()"))
    return parsed.withColumn("key", key).withWatermark("arrived", remember).dropDuplicatesWithinWatermark(["key"]).drop("key", "arrived")


def start_requests(spark: SparkSession, source: str | None, summaries: DataFrame, *, sink: str, checkpoint: str,
                   available_now: bool = True, prompts: DataFrame | None = None, fmt: str = "text",
                   max_files_per_trigger: int | None = None, options: dict | None = None, dead_letters: str | None = None,
                   remember: str = "7 days"):
    """Start the flow; returns the ``StreamingQuery``.

    ``fmt`` and ``options`` choose the source (a folder or a queue); ``max_files_per_trigger``, or the queue's own
    option, bounds a micro-batch. Messages that are no requests go to ``dead_letters`` as they came, by default to
    ``<sink>-rejected``. ``summaries`` and ``prompts`` are taken as they are at the start.
    """
    flow, rejected = _flow_id(spark, checkpoint), dead_letters or f"{sink.rstrip('/')}-rejected"
    summaries = materialize(summaries, "request-summaries")
    prompts = None if prompts is None else materialize(prompts, "request-prompts")
    stored = stored_at(spark, sink)
    older = None if stored is None else materialize(stored.where(F.col("flow").cast("string") != flow).select("request_id"), "answered")
    if older is not None and older.isEmpty():
        older = None

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                                             # one micro-batch, written to two folders
        new = batch.filter("request_id IS NOT NULL").drop("value")
        if older is not None:
            new = new.join(older, "request_id", "left_anti")
        where = f"flow={flow}/batch={batch_id}"
        enrich_requests(new, summaries, prompts).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/{where}")
        batch.filter("request_id IS NULL").select("value").write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/{where}")
        batch.unpersist()

    messages = read_requests(spark, source, fmt=fmt, max_files_per_trigger=max_files_per_trigger, options=options)
    w = once_each(messages, remember).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
