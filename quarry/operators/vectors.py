"""Vector retrieval: cosine top-k (V1/J10), multi-query retrieval with keep-first
de-duplication (V3/D3), rerank by parsed indices (V4/T9), query-expansion parsing
(T10), upsert (K7), scroll (S14), chunk embedding (V6).

Exact top-k never materialises query x point pairs: the query matrix is
size-checked and broadcast, every point partition scores an Arrow batch with one
matrix product and keeps only its own top-k per query, and a final
``row_number() <= k`` (partial/final ``WindowGroupLimit``) merges those.
Query sets above the broadcast budget meet the points in a grid of cells.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import ustrip

from quarry.operators.core import keep_first

from quarry._workers import ship_by_value

ship_by_value(__name__)

DEFAULT_BROADCAST_BYTES = 256 << 20


SCORE_BUDGET = 1 << 25          # doubles per score block (256 MB): bounds memory for any query count


def _topk_partition_fn(qids: np.ndarray, qmat: np.ndarray, k: int, score_budget: int = SCORE_BUDGET):
    qn = np.linalg.norm(qmat, axis=1)
    live = np.nonzero(qn > 0)[0]                       # zero queries never match
    qunit = qmat[live] / qn[live][:, None]
    qids = qids[live]

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0 or len(qids) == 0:
                continue
            ids = pdf["id"].to_numpy()
            pm = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]])
            pn = np.linalg.norm(pm, axis=1)
            keep = pn > 0
            if not keep.any():
                continue
            ids, punit = ids[keep], pm[keep] / pn[keep][:, None]
            n = len(ids)
            kk = min(k, n)
            step = max(1, score_budget // n)
            for q0 in range(0, len(qids), step):
                scores = punit @ qunit[q0:q0 + step].T     # (points, query chunk)
                if kk < n:
                    # k-th best per query; every point scoring at least that is kept (ties resolved by id later)
                    thr = np.partition(scores, n - kk, axis=0)[n - kk]
                    pi, qi = np.nonzero(scores >= thr[None, :])
                else:
                    pi, qi = np.nonzero(np.ones_like(scores, dtype=bool))
                yield pd.DataFrame({"query_id": qids[q0:q0 + step][qi], "id": ids[pi], "score": scores[pi, qi]})
    return run


def _matrix(rows) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r["query_id"] for r in rows]), np.array([np.asarray(r["embedding"], dtype=np.float64) for r in rows])


CELL_POINTS = 65_536


def _topk_cells(pts: DataFrame, q: DataFrame, blocks: int, k: int, score_budget: int, kind: str) -> DataFrame:
    """Query sets beyond the broadcast budget: blocks of queries meet chunks of points in a grid of cells."""
    chunks = 1 + pts.count() // CELL_POINTS
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    qtype = q.schema["query_id"].dataType
    left = pts.select(F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), each(blocks).alias("block"),
                      F.lit(None).cast(qtype).alias("query_id"), "id", F.lit(False).alias("asks"), "embedding")
    right = q.select(each(chunks).alias("chunk"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
                     "query_id", F.lit(None).cast("long").alias("id"), F.lit(True).alias("asks"), "embedding")

    def meet(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell["asks"].to_numpy(dtype=bool)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        points = cell[~asks].astype({"id": "int64"})
        scored = list(_topk_partition_fn(*_matrix(cell[asks].to_dict("records")), k, score_budget)([points]))
        return pd.concat(scored) if scored else pd.DataFrame({"query_id": [], "id": [], "score": []})

    return left.unionByName(right).groupBy("chunk", "block").applyInPandas(meet, kind)


def vector_topk(points: DataFrame, queries: DataFrame, *, k: int = 5, where: Column | None = None,
                query_id: str = "query_id", vector: str = "embedding",
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, score_budget: int = SCORE_BUDGET) -> DataFrame:
    """V1: for every query the ``k`` points with the highest cosine similarity
    (ties by smaller id); ``where`` is a payload filter applied at the scan.

    Returns ``(query_id, rank, id, score)``; zero vectors never match.
    """
    spark: SparkSession = points.sparkSession
    if where is not None:
        points = points.filter(where)
    pts = points.select(F.col("id").cast("long").alias("id"), F.col(vector).alias("embedding"))
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("embedding"))
    qtype = q.schema["query_id"].dataType.simpleString()
    kind = f"query_id {qtype}, id long, score double"
    stats = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d")).first()
    nq, dim = stats["n"], (stats["d"] or 0)
    if not nq:
        return spark.createDataFrame([], f"query_id {qtype}, rank int, id long, score double")
    per_block = max(1, int(max_broadcast_bytes // max(1, 8 * max(dim, 1))))
    if nq <= per_block:                                                # the query matrix fits: points stay where they are
        cand = pts.mapInPandas(_topk_partition_fn(*_matrix(q.collect()), k, score_budget), kind)
    else:
        cand = _topk_cells(pts, q, -(-nq // per_block), k, score_budget, kind)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "id", "score")


def multi_query_topk(points: DataFrame, queries: DataFrame, *, k: int = 10, where: Column | None = None,
                     final_k: int | None = None) -> DataFrame:
    """V3 + D3: ``queries(question_id, query_no, embedding)``; each expanded query gets
    ``k // n + 1`` hits (n = queries of its question), hits are concatenated in query order
    and de-duplicated by point id keeping the first; not re-sorted (may exceed ``k``)
    unless ``final_k`` is set."""
    n = queries.groupBy("question_id").agg(F.count(F.lit(1)).alias("_n"))
    per = queries.join(n, "question_id").withColumn("_lim", (F.lit(k) / F.col("_n")).cast("int") + 1)
    kmax = k + 1
    q = per.withColumn("query_id", F.concat_ws("#", F.col("question_id").cast("string"), F.col("query_no").cast("string")))
    hits = vector_topk(points, q.select("query_id", "embedding"), k=kmax, where=where)
    hits = hits.join(q.select("query_id", "question_id", "query_no", "_lim"), "query_id") \
        .filter(F.col("rank") <= F.col("_lim")).select("question_id", "query_no", "rank", "id", "score")
    out = keep_first(hits, key=["question_id", "id"], order=["query_no", "rank"])
    w = Window.partitionBy("question_id").orderBy("query_no", "rank")
    out = out.withColumn("hit_no", F.row_number().over(w))
    return out.filter(F.col("hit_no") <= final_k) if final_k else out


def parse_indices(answer: Column, n_passages: Column) -> Column:
    """Every integer in the answer minus one, kept when inside ``[0, n)`` (repeats allowed)."""
    nums = F.transform(F.regexp_extract_all(answer, F.lit(r"\d+"), 0), lambda x: x.try_cast("long") - 1)
    return F.filter(nums, lambda i: i.isNotNull() & (i >= 0) & (i < n_passages))


def rerank(hits: DataFrame, points: DataFrame, answers: DataFrame | None = None, *, keep_top_k: int = 5,
           key: str = "question_id") -> DataFrame:
    """V4: passages = hit contents in hit order (empty content dropped); the ranker's answer
    gives 1-based passage numbers; the first ``keep_top_k`` valid ones are kept. No
    answer for a question (failed call) -> the original order."""
    pas = hits.join(points.select("id", "content"), "id").filter(F.col("content").isNotNull() & (F.col("content") != ""))
    w = Window.partitionBy(key).orderBy("hit_no")
    pas = pas.withColumn("passage_no", F.row_number().over(w) - 1)
    if answers is None:
        return pas.filter(F.col("passage_no") < keep_top_k).select(
            key, F.col("passage_no").alias("out_no"), "passage_no", "id", "content")
    npas = pas.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    idx = answers.join(npas, key).select(key, F.posexplode(F.slice(parse_indices(F.col("answer"), F.col("_n")), 1, keep_top_k))
                                         .alias("out_no", "passage_no"))
    chosen = idx.join(pas, [key, "passage_no"]).select(key, "out_no", "passage_no", "id", "content")
    # only questions without an answer (a failed ranker call) fall back to the original order;
    # an answer without a usable passage number keeps nothing, as in the reference
    fallback = pas.join(answers.select(key).distinct(), key, "left_anti").filter(F.col("passage_no") < keep_top_k) \
        .select(key, F.col("passage_no").alias("out_no"), "passage_no", "id", "content")
    return chosen.unionByName(fallback)


def expand_parse(query: Column, response: Column, n: int = 3) -> Column:
    """Response lines, stripped, non-empty; original query prepended when absent; cut to ``n``.
    A null response (failed call) gives ``[query]``."""
    lines = F.filter(F.transform(F.split(response, "\n", -1), lambda l: ustrip(l)),
                     lambda l: l != "")
    with_q = F.when(F.array_contains(lines, query), lines).otherwise(F.concat(F.array(query), lines))
    return F.when(response.isNull(), F.array(query)).otherwise(F.slice(with_q, 1, n))


def upsert(current: DataFrame, *batches: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """K7: insert-or-replace by id; a later batch wins, within a batch the largest ``order`` (without
    one, ids have to be unique within a batch)."""
    u = current.withColumn("_batch", F.lit(0))
    for i, b in enumerate(batches, 1):
        u = u.unionByName(b.withColumn("_batch", F.lit(i)), allowMissingColumns=True)
    last = [F.col("_batch").desc()] + ([F.col(order).desc()] if order else [])
    return keep_first(u, key=key, order=last).drop("_batch")


def scroll(points: DataFrame, *, limit: int = 10, offset: int | None = None) -> DataFrame:
    """The next ``limit`` points in id order starting at ``offset``."""
    p = points if offset is None else points.filter(F.col("id") >= offset)
    return p.orderBy("id").limit(limit)


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Default offline encoder: signed feature hashing of lower-cased word tokens, L2-normalised."""
    import re
    import zlib

    tok = re.compile(r"\w+", re.UNICODE)

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in tok.findall((t or "").lower()):
                h = zlib.crc32(w.encode("utf-8"))
                out[i, h % dim] += 1.0 if (h >> 16) & 1 else -1.0
            n = np.linalg.norm(out[i])
            if n > 0:
                out[i] /= n
        return out
    return encode


def embed_chunks(chunks: DataFrame, *, text: str = "chunk", id_col: str = "id",
                 encoder: Callable[[list[str]], np.ndarray] | None = None, keep=()) -> DataFrame:
    """V6: ``(id, embedding, content, keep...)`` with an injected batch encoder (Arrow batches)."""
    enc = encoder or hashing_encoder()
    keep = list(keep)
    src = chunks.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("content"), *keep)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep)

    def run(batches):
        for pdf in batches:
            vecs = enc(list(pdf["content"])) if len(pdf) else np.zeros((0, 1))
            out = pdf[["id", "content"] + keep].copy()
            out["embedding"] = [np.asarray(v, dtype=np.float32).tolist() for v in vecs]
            yield out

    schema = "id long, content string" + (f", {fields}" if fields else "") + ", embedding array<float>"
    return src.mapInPandas(run, schema)
