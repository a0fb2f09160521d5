"""The corpus pipeline: stages that each take documents and hand documents on; the last one packs them.

Every stage's rows are written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import stage
from quarry.llm.linededup import with_lines_removed
from quarry.llm.ngramjoin import keep_one
from quarry.llm.packing import pack
from quarry.llm.quality import keep_good
from quarry.llm.queries import BYTE_BPE
from quarry.llm.toxicity import drop_toxic, train
from quarry.sources.tables import table

#: No SQL states the learned filter, the similarity joins or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold, by a model learned from the labels of these documents."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_lines_removed(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, BYTE_BPE)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard_join", ngram_jaccard_join), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
