"""Plan-shape checks: the scale properties the operators are designed for."""

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, key):
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_before_shuffle(spark):
    p = plan(spark, "dedup_links")
    assert "Partial" in p and "Final" in p
    # the partial limit sits below (after, in the printed tree) the exchange on the key
    assert p.rfind("Partial") > p.find("Exchange hashpartitioning(key")


def test_repo_summary_is_hash_aggregated(spark):
    p = plan(spark, "repo_summary")
    assert "HashAggregate(keys=[repo_id" in p
    # string-valued max_by (sort aggregation) only runs on the key-file candidates
    assert p.count("SortAggregate") <= 2


def test_sft_samples_do_not_shuffle_documents(spark):
    p = plan(spark, "sft_samples")
    doc_scan = [line for line in p.splitlines() if "FileScan parquet" in line and "documents" in line]
    assert doc_scan
    # batching is arithmetic on the dense chunk ordinal: no window (and no shuffle by repository)
    assert "Window [" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "approx_tokens")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_vector_search_has_no_nested_loop(spark):
    p = plan(spark, "vector_topk")
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "MapInPandas" in p or "MapInArrow" in p


def test_chunk_features_folds_once(spark):
    from quarry.operators import chunks as ch
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("text", "readme")
    plan = ch.chunk_features(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("aggregate(") == 1


def test_exact_split_has_no_full_row_shuffle(spark):
    from quarry.operators.core import exact_hash_split
    df = spark.range(1000).withColumn("wide", F.repeat(F.lit("x"), 100))
    plan = exact_hash_split(df, key="id").select("wide", "is_train")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert all("_p" in line for line in exchanges) and plan.count("Range (") == 0
