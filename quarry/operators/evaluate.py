"""Evaluation (E1): score (query, output, context) rows with metrics and average them.

The default metrics are lexical and run in Catalyst (token-set overlaps);
an injected scorer ``score(queries, outputs, contexts) -> dict[metric, list]``
runs in Arrow batches. A metric the scorer does not return counts as 0.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry._workers import ship_by_value

ship_by_value(__name__)

DEFAULT_METRICS = ("relevance_score", "hallucination_score")


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[\s\p{P}]+", -1), lambda t: t != ""))


def lexical_scores(query: Column, output: Column, context: Column) -> list[Column]:
    """relevance = share of query tokens found in the output; hallucination = share of
    output tokens absent from the context (0 without context)."""
    q, o, c = _tokens(query), _tokens(output), _tokens(context)
    rel = F.when(F.size(q) > 0, F.size(F.array_intersect(q, o)) / F.size(q)).otherwise(F.lit(0.0))
    hal = F.when((F.size(o) > 0) & (F.size(c) > 0), F.size(F.array_except(o, c)) / F.size(o)).otherwise(F.lit(0.0))
    return [F.round(rel, 6).alias("relevance_score"), F.round(hal, 6).alias("hallucination_score")]


def eval_batch(tasks: DataFrame, *, scorer: Callable | None = None, metrics=DEFAULT_METRICS, key: str = "task_id"):
    """``(scores per task, one-row averages)``."""
    if scorer is None:
        scored = tasks.select(key, *lexical_scores(F.col("query"), F.col("output"), F.col("context")))
    else:
        ktype = tasks.schema[key].dataType.simpleString()

        def run(batches):
            for pdf in batches:
                res = scorer(list(pdf["query"]), list(pdf["output"]), list(pdf["context"])) if len(pdf) else {}
                out = pd.DataFrame({key: pdf[key]})
                for m in metrics:
                    out[m] = [float(x or 0.0) for x in res.get(m, [0.0] * len(pdf))]
                yield out
        scored = tasks.select(key, "query", "output", "context").mapInPandas(
            run, f"{key} {ktype}, " + ", ".join(f"{m} double" for m in metrics))
    avg = scored.agg(F.count(F.lit(1)).alias("tasks"), *[F.round(F.avg(m), 6).alias(f"avg_{m}") for m in metrics])
    return scored, avg
