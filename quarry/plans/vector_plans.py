"""Registered queries: vector retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import vectors as vx
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture
from quarry.sources.tables import table


def centroids(points: DataFrame, group, *, where=None) -> DataFrame:
    """Mean vector per group (Spark-derived query set; one row per group, dim values each)."""
    p = points if where is None else points.filter(where)
    ex = p.select(*group, F.posexplode("embedding").alias("pos", "v"))
    m = ex.groupBy(*group, "pos").agg(F.avg(F.col("v").cast("double")).alias("a"))
    return m.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("pos", "a"))).alias("_s")) \
        .select(*group, F.transform("_s", lambda x: x["a"]).alias("embedding"))


CEN_CTES = [
    ("ex", "SELECT label, id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM v_points"),
    ("cen", """SELECT label AS query_id, list(a ORDER BY pos) AS q FROM (
        SELECT label, pos, avg(CAST(v AS DOUBLE)) AS a FROM ex GROUP BY label, pos) GROUP BY label"""),
    ("pts", "SELECT id, CAST(embedding AS DOUBLE[]) AS e, content FROM v_points WHERE list_sum(list_transform(embedding, lambda x: x * x)) > 0"),
]


def topk_sql(qsrc, k, where="TRUE"):
    return f"""SELECT query_id, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM (
  SELECT c.query_id, p.id, list_cosine_similarity(p.e, c.q) AS score,
         row_number() OVER (PARTITION BY c.query_id ORDER BY list_cosine_similarity(p.e, c.q) DESC, p.id) AS rank
  FROM {qsrc} c, pts p WHERE {where}) WHERE rank <= {k}"""


def _points(spark, sf):
    return fixture(spark, sf, "v_points")


def _round(df):
    return df.withColumn("score", F.round("score", 6))


@register("vector_topk", with_views(["v_points"], CEN_CTES) + topk_sql("cen", 5))
def q_vector_topk(spark, sf):
    pts = _points(spark, sf)
    q = centroids(pts, ["label"]).withColumnRenamed("label", "query_id")
    return _round(vx.vector_topk(pts, q, k=5))


@register("vector_topk_where", with_views(["v_points"], CEN_CTES) + topk_sql("cen", 5, "p.content <> ''"))
def q_vector_topk_where(spark, sf):
    pts = _points(spark, sf)
    q = centroids(pts, ["label"]).withColumnRenamed("label", "query_id")
    return _round(vx.vector_topk(pts, q, k=5, where=F.col("content") != ""))


# expanded queries per question (= label): overall centroid, centroid of even ids, of odd ids
MQ_CTES = CEN_CTES + [
    ("half", "SELECT id, CASE WHEN embedding[1] >= 0 THEN 1 ELSE 2 END AS half FROM v_points"),
    ("cen2", """SELECT label AS question_id, half AS query_no, list(a ORDER BY pos) AS q FROM (
        SELECT ex.label, h.half, ex.pos, avg(CAST(ex.v AS DOUBLE)) AS a FROM ex JOIN half h ON h.id = ex.id
        GROUP BY ex.label, h.half, ex.pos) GROUP BY label, half"""),
    ("qs", "SELECT query_id AS question_id, 0 AS query_no, q FROM cen UNION ALL SELECT question_id, query_no, q FROM cen2"),
    ("hits", """SELECT question_id, query_no, rank, id, score FROM (
        SELECT c.question_id, c.query_no, p.id, list_cosine_similarity(p.e, c.q) AS score,
               row_number() OVER (PARTITION BY c.question_id, c.query_no ORDER BY list_cosine_similarity(p.e, c.q) DESC, p.id) AS rank
        FROM qs c, pts p) WHERE rank <= 10 // 3 + 1"""),
    ("dedup", """SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY query_no, rank) AS hit_no FROM (
        SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY question_id, id ORDER BY query_no, rank) = 1)"""),
]


def _queries(spark, sf):
    pts = _points(spark, sf)
    c0 = centroids(pts, ["label"]).select(F.col("label").alias("question_id"), F.lit(0).alias("query_no"), "embedding")
    # expanded queries: the label's points split by the sign of their first component
    half = F.when(F.element_at("embedding", 1) >= 0, 1).otherwise(2).cast("int")
    c12 = centroids(pts.withColumn("_par", half), ["label", "_par"]) \
        .select(F.col("label").alias("question_id"), F.col("_par").alias("query_no"), "embedding")
    return c0.unionByName(c12)


def _hits(spark, sf):
    return vx.multi_query_topk(_points(spark, sf), _queries(spark, sf), k=10)


@register("multi_query_topk", with_views(["v_points"], MQ_CTES) +
          "SELECT question_id, CAST(hit_no AS INT) AS hit_no, CAST(query_no AS INT) AS query_no, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM dedup")
def q_multi_query_topk(spark, sf):
    h = _hits(spark, sf)
    return _round(h.select("question_id", "hit_no", "query_no", "rank", "id", "score"))


RR_CTES = MQ_CTES + [
    ("pas", """SELECT d.question_id, d.hit_no, d.id, p.content, row_number() OVER (PARTITION BY d.question_id ORDER BY d.hit_no) - 1 AS passage_no
               FROM dedup d JOIN pts p ON p.id = d.id WHERE p.content IS NOT NULL AND p.content <> ''"""),
]


@register("rerank", with_views(["v_points"], RR_CTES) +
          "SELECT question_id, CAST(passage_no AS INT) AS out_no, CAST(passage_no AS INT) AS passage_no, id, content FROM pas WHERE passage_no < 5")
def q_rerank(spark, sf):
    pts = _points(spark, sf)
    return vx.rerank(_hits(spark, sf), pts, None, keep_top_k=5).select(
        "question_id", F.col("out_no").cast("int").alias("out_no"), F.col("passage_no").cast("int").alias("passage_no"), "id", "content")


@register("retrieve_rerank", with_views(["v_points"], RR_CTES + [
    ("ans", "SELECT DISTINCT question_id, (question_id + 1) || ', ' || (question_id + 2) || ', 99' AS answer FROM pas"),
    ("npas", "SELECT question_id, count(*) AS n FROM pas GROUP BY question_id"),
    ("idx", """SELECT question_id, unnest(ix) AS passage_no, CAST(generate_subscripts(ix, 1) - 1 AS INT) AS out_no FROM (
        SELECT a.question_id, list_filter(list_transform(regexp_extract_all(a.answer, '\\d+'), lambda x: CAST(x AS BIGINT) - 1),
                                           lambda i: i >= 0 AND i < n.n)[1:5] AS ix
        FROM ans a JOIN npas n ON n.question_id = a.question_id)"""),
]) + """
SELECT i.question_id, i.out_no, CAST(i.passage_no AS INT) AS passage_no, p.id, p.content FROM idx i JOIN pas p ON p.question_id = i.question_id AND p.passage_no = i.passage_no
UNION ALL
SELECT question_id, CAST(passage_no AS INT), CAST(passage_no AS INT), id, content FROM pas WHERE passage_no < 5 AND question_id NOT IN (SELECT question_id FROM ans)""")
def q_retrieve_rerank(spark, sf):
    """V5: expanded-query retrieval -> dedup -> rerank with the ranker's answers."""
    pts = _points(spark, sf)
    hits = _hits(spark, sf)
    qids = hits.select("question_id").distinct()
    answers = qids.select("question_id", F.concat_ws(", ", (F.col("question_id") + 1).cast("string"),
                                                     (F.col("question_id") + 2).cast("string"), F.lit("99")).alias("answer"))
    r = vx.rerank(hits, pts, answers, keep_top_k=5)
    return r.select("question_id", F.col("out_no").cast("int").alias("out_no"), F.col("passage_no").cast("int").alias("passage_no"),
                    "id", "content")


@register("parse_indices", """
SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(url, '\\d+'), lambda x: CAST(x AS BIGINT) - 1),
                                            lambda i: i >= 0 AND i < 10), ',') AS indices FROM pages""")
def q_parse_indices(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.array_join(vx.parse_indices(F.col("url"), F.lit(10)).cast("array<string>"), ",").alias("indices"))


@register("expand_parse", """
SELECT conv_id, turn, array_to_string(CASE WHEN response IS NULL THEN [query] ELSE
   (CASE WHEN list_contains(l, query) THEN l ELSE list_concat([query], l) END)[1:3] END, ' | ') AS queries
FROM (SELECT conv_id, turn, query, response,
        list_filter(list_transform(string_split(response, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS l
      FROM (SELECT conv_id, turn, role, text AS query, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS response FROM conversations)
      WHERE role = 'user')""")
def q_expand_parse(spark, sf):
    from pyspark.sql import Window
    c = table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("response", F.lead("text").over(w)).filter(F.col("role") == "user")
    return c.select("conv_id", "turn", F.array_join(vx.expand_parse(F.col("text"), F.col("response"), 3), " | ").alias("queries"))


@register("vector_upsert", with_views(["v_points"]) + """
SELECT id, label, content FROM v_points WHERE label <> 0
UNION ALL SELECT id, label, 'updated ' || id FROM v_points WHERE label = 0""")
def q_vector_upsert(spark, sf):
    pts = _points(spark, sf).select("id", "label", "content", "embedding")
    batch = pts.filter(F.col("label") == 0).withColumn("content", F.concat(F.lit("updated "), F.col("id").cast("string")))
    return vx.upsert(pts, batch).select("id", "label", "content")


@register("vector_scroll", with_views(["v_points"]) + "SELECT id, label, content FROM v_points WHERE id >= 100 ORDER BY id LIMIT 10")
def q_vector_scroll(spark, sf):
    return vx.scroll(_points(spark, sf).select("id", "label", "content"), limit=10, offset=100)


@register("dedup_hits", with_views(["v_points"], MQ_CTES) + "SELECT question_id, id, CAST(query_no AS INT) AS query_no, CAST(rank AS INT) AS rank FROM dedup")
def q_dedup_hits(spark, sf):
    return _hits(spark, sf).select("question_id", "id", "query_no", "rank")


@register("embed_chunks")
def q_embed_chunks(spark, sf):
    """V6: sentence chunks of every document embedded by the offline encoder, then upserted (K7)."""
    from quarry.operators import chunks as ch
    docs = table(spark, sf, "documents")
    c = ch.chunk_sentences(docs, "text", keep=["doc_id"]).withColumn("id", F.xxhash64("doc_id", "chunk_no"))
    emb = vx.embed_chunks(c, text="chunk", id_col="id", keep=["doc_id"])
    return vx.upsert(emb.select("id", "doc_id", "content", "embedding"))
