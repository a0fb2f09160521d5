"""Registered queries: marker blocks and document merges."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import blocks as bk
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture

# DuckDB's RE2 has no back-references; fixture blocks are well formed, so the end tag name is not re-checked.
PAT = "(?s)<!--\\s*DOC_(AUTO|MANUAL):(\\w+)\\s+v(\\d+)\\s*-->(.*?)<!--\\s*DOC_(AUTO|MANUAL)_END:\\w+\\s*-->"
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
PARSED = ("p", f"""SELECT doc_id, existing, block_name, new_content,
    regexp_extract_all(existing, '{PAT}', 1) AS modes, regexp_extract_all(existing, '{PAT}', 2) AS names,
    regexp_extract_all(existing, '{PAT}', 3) AS versions, regexp_extract_all(existing, '{PAT}', 4) AS contents,
    regexp_extract_all(existing, '{PAT}', 0) AS fulls, regexp_split_to_array(existing, '{PAT}') AS segs
  FROM v_marked_docs""")


def tag(mode, name, version, content):
    return (f"'<!-- DOC_{mode}:' || {name} || ' v' || CAST({version} AS VARCHAR) || ' -->' || chr(10) || {content} || chr(10) "
            f"|| '<!-- DOC_{mode}_END:' || {name} || ' -->'")


S_NEW, S_OLD = STRIP.format(x="new_content"), STRIP.format(x="contents[i]")
RENDER = (f"CASE WHEN modes[i] = 'AUTO' AND names[i] = block_name THEN "
          f"(CASE WHEN {S_NEW} <> {S_OLD} THEN {tag('MANUAL', 'names[i]', 'CAST(versions[i] AS INT)', S_OLD)} "
          f"ELSE {tag('AUTO', 'names[i]', 'CAST(versions[i] AS INT) + 1', 'new_content')} END) ELSE fulls[i] END")


@register("marker_blocks", with_views(["v_marked_docs"], [PARSED]) + f"""
SELECT doc_id, CAST(i - 1 AS INT) AS block_no, modes[i] AS mode, names[i] AS name, CAST(versions[i] AS INT) AS version,
       {STRIP.format(x='contents[i]')} AS content
FROM (SELECT *, unnest(range(1, len(modes) + 1)) AS i FROM p)""")
def q_marker_blocks(spark, sf):
    d = fixture(spark, sf, "v_marked_docs")
    return d.select("doc_id", F.posexplode(bk.parse_blocks(F.col("existing"))).alias("block_no", "b")).select(
        "doc_id", F.col("block_no").cast("int").alias("block_no"), "b.mode", "b.name", "b.version", "b.content")


@register("merge_two_mode", with_views(["v_marked_docs"], [PARSED]) + f"""
SELECT doc_id, CASE WHEN len(modes) = 0 THEN
    regexp_replace(existing, '\\s+$', '') || chr(10) || chr(10) || {tag('AUTO', 'block_name', '1', 'new_content')} || chr(10) || chr(10)
  ELSE array_to_string([segs[i] || {RENDER} FOR i IN range(1, len(modes) + 1)], '') || segs[len(segs)]
       || CASE WHEN NOT list_contains(names, block_name) THEN chr(10) || {tag('AUTO', 'block_name', '1', 'new_content')} ELSE '' END
  END AS merged
FROM p""")
def q_merge_two_mode(spark, sf):
    d = fixture(spark, sf, "v_marked_docs").withColumn(
        "new_blocks", F.array(F.struct(F.col("block_name").alias("name"), F.col("new_content").alias("content"))))
    return bk.merge_blocks(d).select("doc_id", "merged")


@register("merge_three_mode")
def q_merge_three_mode(spark, sf):
    d = fixture(spark, sf, "v_marked_docs").withColumn(
        "new_blocks", F.array(F.struct(F.col("block_name").alias("name"), F.col("new_content").alias("content"))))
    return bk.merge_blocks(d, policy="three_mode").select("doc_id", "merged")


@register("merge_blocks", with_views(["v_marked_docs"], [PARSED]) + f"""
SELECT doc_id, CASE WHEN len(modes) = 0 THEN
    regexp_replace(existing, '\\s+$', '') || chr(10) || chr(10) || {tag('AUTO', 'block_name', '1', 'new_content')} || chr(10) || chr(10)
      || {tag('AUTO', "'notes'", '1', 'existing')} || chr(10) || chr(10)
  ELSE array_to_string([segs[i] || {RENDER} FOR i IN range(1, len(modes) + 1)], '') || segs[len(segs)]
       || CASE WHEN NOT list_contains(names, block_name) THEN chr(10) || {tag('AUTO', 'block_name', '1', 'new_content')} ELSE '' END
       || chr(10) || {tag('AUTO', "'notes'", '1', 'existing')}
  END AS merged
FROM p""")
def q_merge_blocks(spark, sf):
    """New blocks from a long table (one row per doc and block), looked up by name."""
    d = fixture(spark, sf, "v_marked_docs")
    new = d.select("doc_id", F.lit(0).alias("block_no"), "block_name", "new_content").unionByName(
        d.select("doc_id", F.lit(1).alias("block_no"), F.lit("notes").alias("block_name"), F.col("existing").alias("new_content")))
    docs = d.select("doc_id", "existing")
    return bk.merge_blocks(docs, new).select("doc_id", "merged")


@register("api_headings", with_views(["v_api_docs"]) + """
SELECT doc_id, turn, array_to_string(list_sort(list_distinct(regexp_extract_all(content, '###\\s+([\\w\\.]+)\\([^)]*\\)', 1))), ',') AS apis,
       array_to_string(regexp_extract_all(content, '(?s)```python\\n(.*?)\\n```', 1), ' | ') AS examples
FROM v_api_docs""")
def q_api_headings(spark, sf):
    d = fixture(spark, sf, "v_api_docs")
    return d.select("doc_id", "turn", F.array_join(F.array_sort(bk.api_headings(F.col("content"))), ",").alias("apis"),
                    F.array_join(bk.code_examples(F.col("content")), " | ").alias("examples"))


@register("merge_incremental")
def q_merge_incremental(spark, sf):
    """M3: each turn's API page merged into the previous turn's (user) page."""
    d = fixture(spark, sf, "v_api_docs")
    w = Window.partitionBy("doc_id").orderBy("turn")
    d = d.withColumn("new", F.lead("content").over(w)).filter(F.col("new").isNotNull())
    return d.select("doc_id", "turn", bk.incremental_merge(F.col("content"), F.col("new")).alias("merged"))
