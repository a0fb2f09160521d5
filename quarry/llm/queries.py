"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import ann, lm, toxicity
from quarry.llm.bpe import encode_decode_digests
from quarry.llm.linededup import dedup_lines
from quarry.llm.ngramjoin import similar_documents
from quarry.llm.packing import pack
from quarry.llm.prefixtrie import prefix_trie
from quarry.llm.quality import quality_rules
from quarry.llm.repeats import repeats_removed
from quarry.llm.tokenfiles import read_token_files, write_token_files
from quarry.llm.urlfilter import url_filter
from quarry.llm.veccodes import vector_codes
from quarry.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode_digests(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op5_url_filter"] = """
WITH r AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m"""


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(*write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(table(spark, sf_dir, "documents"))


ORACLE["op11_substring_dedup"] = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT r, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS k FROM t),
s AS (SELECT r, doc_id, word, k, CASE WHEN count(*) OVER g = 50 THEN string_agg(word, ' ') OVER g END AS win FROM w WINDOW g AS (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
f AS (SELECT win, min(doc_id) AS first_doc FROM s WHERE win IS NOT NULL GROUP BY win),
d AS (SELECT s.r, s.word, s.k, max(CASE WHEN f.first_doc < s.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY s.r ORDER BY s.k ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM s LEFT JOIN f ON f.win = s.win),
k AS (SELECT r, count(*) AS n_words, sum(gone) AS n_removed, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY k) AS kept FROM d GROUP BY r)
SELECT t.doc_id, coalesce(k.n_words, 0) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM t LEFT JOIN k USING (r)"""


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _lloyd_round(n: int) -> str:
    """Assignment a<n> of the parts to codebook b<n>, and the next codebook."""
    return f"""
d{n} AS (SELECT p.part, p.vec_id, p.label, p.x, b.idx, list_dot_product(p.x, p.x) + list_dot_product(b.e, b.e) - 2 * list_dot_product(p.x, b.e) AS d FROM p JOIN b{n} b ON b.part = p.part),
a{n} AS (SELECT part, vec_id, any_value(label) AS label, any_value(x) AS x, CAST(min(d) AS BIGINT) AS d, CAST(min(d * 256 + idx) AS BIGINT) % 256 AS idx FROM d{n} GROUP BY part, vec_id),
u{n} AS (SELECT part, idx, pos, floor(sum(v) / count(*)) AS m FROM (SELECT part, idx, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{n}) GROUP BY part, idx, pos),
b{n + 1} AS (SELECT b.part, b.idx, coalesce(l.e, b.e) AS e FROM b{n} b LEFT JOIN (SELECT part, idx, list(m ORDER BY pos) AS e FROM u{n} GROUP BY part, idx) l ON l.part = b.part AND l.idx = b.idx),"""


ORACLE["op12_vector_codes"] = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, e[part * (len(e) // 4) + 1 : (part + 1) * (len(e) // 4)] AS x FROM v, range(4) AS r(part)),
b0 AS (SELECT part, idx, x AS e FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS idx FROM p) WHERE idx < 256),
{"".join(_lloyd_round(n) for n in range(5))}
h AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, idx, pos)) AS digest FROM (SELECT part, idx, unnest(e) AS c, generate_subscripts(e, 1) AS pos FROM b4)),
c AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', idx), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT digest FROM h) AS codebooks_sha256 FROM c"""


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: crc32 of the decimal id bit by bit: each byte joins at the first of its eight steps.
ORACLE["op13_conversation_trie"] = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS k FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten([[ascii(b)::UBIGINT, 0, 0, 0, 0, 0, 0, 0] FOR b IN string_split(CAST(conv_id AS VARCHAR), '')])),
             lambda a, e: xor(xor(a, e) >> 1, CASE WHEN xor(a, e) & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)), 4294967295::UBIGINT) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT i.conv_id, 0 AS part, t.k, t.role, t.text FROM i JOIN t ON t.conv_id = i.conv_id - ((i.conv_id % 5) + 5) % 5 AND t.k < i.h
      UNION ALL SELECT t.conv_id, 1, t.k, t.role, t.text FROM t JOIN i USING (conv_id) WHERE t.k >= i.h),
p AS (SELECT conv_id, row_number() OVER w AS d, list({'r': role, 't': text}) OVER w AS seq, text FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, k)
      UNION ALL SELECT conv_id, 0, [], '' FROM i),
l AS (SELECT conv_id, max(d) AS len FROM p GROUP BY conv_id),
n AS (SELECT seq, d, min(p.conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(text)) END AS own,
             sha256(coalesce(string_agg(CASE WHEN d = len THEN CAST(p.conv_id AS VARCHAR) END, ',' ORDER BY p.conv_id), '')) AS ends_sha256 FROM p JOIN l USING (conv_id) GROUP BY seq, d),
k AS (SELECT seq[1 : d - 1] AS seq, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.seq = n.seq),
s AS (SELECT p.seq, p.d, sum(m.own) AS saved_tokens, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.seq, p.d)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, CASE WHEN m.d > 0 THEN u.conv_id END AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.d = m.d AND s.seq = m.seq LEFT JOIN n u ON u.d = m.d - 1 AND u.seq = m.seq[1 : m.d - 1]"""
