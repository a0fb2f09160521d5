"""Registered queries: instruction-tuning dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import chunks as ch
from quarry.operators import repos as rp
from quarry.operators import sft
from quarry.operators.core import exact_hash_split
from quarry.plans.registry import register
from quarry.plans.sqlkit import sentence_chunk_ctes, with_views
from quarry.sources.fixtures import fixture


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# chunk items: README samples with their trees, sentence-chunked (T4)
CHUNK_CTES = [("s", """SELECT r.repo_url, r.readme, coalesce(t.file_tree, []::VARCHAR[]) AS file_tree, r.language AS project_type
                      FROM v_readme_samples r LEFT JOIN v_repo_trees t ON t.repo_id = r.files_repo_id""")] \
    + sentence_chunk_ctes("s", "repo_url", "readme") + [
    ("items", """SELECT o.id AS repo_url, o.chunk_no, o.chunk, s.file_tree, coalesce(nullif(s.project_type, ''), 'unknown') AS project_type,
                 CAST((row_number() OVER (PARTITION BY o.id ORDER BY o.chunk_no) - 1) // 3 AS BIGINT) AS batch_no,
                 CAST((row_number() OVER (PARTITION BY o.id ORDER BY o.chunk_no) - 1) % 3 AS INT) AS item_no
                 FROM t3_out o JOIN s ON s.repo_url = o.id"""),
    ("item_text", """SELECT *, '[Item ' || (item_no + 1) || ']' || chr(10) || 'Chunk preview:' || chr(10) ||
          CASE WHEN length(chunk) <= 500 THEN chunk ELSE regexp_replace(substring(chunk, 1, 497), '\\s+$', '') || '...' END
          || chr(10) || chr(10) || 'File tree (first 30): ' || array_to_string(file_tree[1:30], ', ')
          || CASE WHEN len(file_tree) > 30 THEN ', ...' ELSE '' END AS txt FROM items"""),
]
CHUNK_VIEWS = ["v_readme_samples", "v_repo_trees"]
HEAD_A, HEAD_B = sft.PROMPT_HEAD.split("{n}")
HEAD_B = HEAD_B.replace("{hint}", sft.STRUCTURE_HINT)
FB = lit(sft.FALLBACK_INSTRUCTION)


def _chunks(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    t = fixture(spark, sf, "v_repo_trees")
    s = s.join(t, s.files_repo_id == t.repo_id, "left").select(
        "repo_url", "readme", F.coalesce("file_tree", F.array().cast("array<string>")).alias("file_tree"),
        F.col("language").alias("project_type"))
    return ch.chunk_features(s).select("repo_url", "chunk_no", "n_chunks", "chunk", "file_tree", "project_type")


def _items(spark, sf):
    b = sft.batches(_chunks(spark, sf), size=3, within="repo_url", order=["chunk_no"], dense_ordinal="chunk_no")
    return b.withColumn("item_text", sft.prompt_item(F.col("chunk"), F.col("file_tree"), F.col("item_no")))


@register("batches", with_views(CHUNK_VIEWS, CHUNK_CTES, recursive=True) +
          "SELECT repo_url, chunk_no, batch_no, item_no FROM items")
def q_batches(spark, sf):
    return sft.batches(_chunks(spark, sf), dense_ordinal="chunk_no").select("repo_url", "chunk_no", "batch_no", "item_no")


@register("prompt_items", with_views(CHUNK_VIEWS, CHUNK_CTES, recursive=True) +
          "SELECT repo_url, chunk_no, txt AS item_text FROM item_text")
def q_prompt_items(spark, sf):
    return _items(spark, sf).select("repo_url", "chunk_no", "item_text")


@register("batch_prompts", with_views(CHUNK_VIEWS, CHUNK_CTES, recursive=True) + f"""
SELECT repo_url, batch_no, CAST(count(*) AS INT) AS n_items,
       {lit(HEAD_A)} || count(*) || {lit(HEAD_B)} || string_agg(txt, {lit(sft.ITEM_SEPARATOR)} ORDER BY item_no) AS prompt
FROM item_text GROUP BY repo_url, batch_no""")
def q_batch_prompts(spark, sf):
    return sft.batch_prompts(_items(spark, sf))


def parse_sql(ans: str, n: str) -> str:
    span = f"regexp_extract({ans}, '\\[[\\s\\S]*\\]', 0)"
    arr = f"(CASE WHEN {span} <> '' AND json_valid({span}) THEN from_json({span}, '[\"VARCHAR\"]') END)"
    return (f"CASE WHEN {arr} IS NULL THEN [{FB} FOR x IN range({n})] "
            f"ELSE list_concat({arr}, [{FB} FOR x IN range(greatest({n} - len({arr}), 0))])[1:{n}] END")


@register("parse_instructions", with_views(["v_answers"]) + f"""
SELECT batch_no, CAST(len(p) AS INT) AS n_instructions, array_to_string(p, ' | ') AS instructions
FROM (SELECT batch_no, {parse_sql('answer', 'n')} AS p FROM v_answers)""")
def q_parse_instructions(spark, sf):
    a = fixture(spark, sf, "v_answers")
    p = sft.parse_instructions(F.col("answer"), F.col("n"))
    return a.select("batch_no", F.size(p).alias("n_instructions"), F.array_join(p, " | ").alias("instructions"))


SFT_CTES = CHUNK_CTES + [
    ("nitems", "SELECT repo_url, batch_no, count(*) AS n_items FROM items GROUP BY repo_url, batch_no"),
    ("parsed", f"""SELECT repo_url, batch_no, unnest(p) AS instruction, CAST(generate_subscripts(p, 1) - 1 AS INT) AS item_no FROM (
        SELECT n.repo_url, n.batch_no, {parse_sql('a.answer', 'n.n_items')} AS p
        FROM nitems n LEFT JOIN v_answers a ON a.batch_no = n.batch_no)"""),
    ("samples", """SELECT i.repo_url, i.chunk_no, i.batch_no, i.item_no, p.instruction, i.file_tree, i.project_type, i.chunk AS content
        FROM items i LEFT JOIN parsed p ON p.repo_url = i.repo_url AND p.batch_no = i.batch_no AND p.item_no = i.item_no"""),
]
SFT_VIEWS = CHUNK_VIEWS + ["v_answers"]


def _samples(spark, sf):
    # landed model output keyed by batch number (the same answer table for every repository)
    ans = fixture(spark, sf, "v_answers").select("batch_no", "answer")
    return sft.build_sft_samples(_chunks(spark, sf), ans)


@register("sft_samples", with_views(SFT_VIEWS, SFT_CTES, recursive=True) + """
SELECT repo_url, chunk_no, batch_no, item_no, instruction, project_type, CAST(len(file_tree) AS INT) AS file_count, content FROM samples""")
def q_sft_samples(spark, sf):
    s = _samples(spark, sf)
    return s.select("repo_url", "chunk_no", "batch_no", "item_no", "instruction", F.col("input.project_type").alias("project_type"),
                    F.size("input.file_tree").alias("file_count"), "content")


@register("train_val_split", with_views(SFT_VIEWS, SFT_CTES, recursive=True) + """
SELECT repo_url, chunk_no, row_number() OVER (ORDER BY md5(repo_url || '#' || chunk_no || '42'), repo_url || '#' || chunk_no)
       <= CASE WHEN count(*) OVER () < 10 THEN count(*) OVER () ELSE floor(count(*) OVER () * CAST(0.9 AS DOUBLE)) END AS is_train
FROM samples""")
def q_train_val_split(spark, sf):
    s = _samples(spark, sf)
    key = F.concat_ws("#", "repo_url", F.col("chunk_no").cast("string"))
    return exact_hash_split(s, key=key, fraction=0.9, seed=42).select("repo_url", "chunk_no", "is_train")


ALPACA_A = sft.ALPACA_WITH_INPUT.split("{instruction}")[0]
ALPACA_B = sft.ALPACA_NO_INPUT.split("{instruction}")[0]
NL = "chr(10)"


def alpaca_sql(instr, inp_txt, resp, eos="</s>"):
    return (f"CASE WHEN {inp_txt} <> '' THEN {lit(ALPACA_A)} || {instr} || {NL} || {NL} || '### Input:' || {NL} || {inp_txt} "
            f"|| {NL} || {NL} || '### Response:' || {NL} || {resp} ELSE {lit(ALPACA_B)} || {instr} || {NL} || {NL} "
            f"|| '### Response:' || {NL} || {resp} END || {lit(eos)}")


RESP = "CASE WHEN output IS NOT NULL AND regexp_replace(output, '^\\s+|\\s+$', '', 'g') <> '' THEN output ELSE content END"
PT_TXT = """CASE WHEN project_type IS NOT NULL AND project_type <> '' THEN 'Project type: ' || project_type
                 WHEN project_type IS NULL THEN '{"project_type": null}' ELSE '{"project_type": ""}' END"""


@register("alpaca_text", with_views(["v_sft_samples"]) +
          f"SELECT conv_id, turn, {alpaca_sql('instruction', PT_TXT, RESP)} AS text FROM v_sft_samples")
def q_alpaca_text(spark, sf):
    s = fixture(spark, sf, "v_sft_samples").withColumn("input", F.struct(F.col("project_type").alias("project_type")))
    return sft.alpaca_text(s, has_file_tree=False).select("conv_id", "turn", "text")


TREE_TXT = ("(CASE WHEN file_tree IS NOT NULL THEN 'File structure:' || chr(10) || array_to_string(file_tree[1:200], chr(10)) END)")
CUSTOM_TXT = (f"concat_ws(chr(10) || chr(10), {TREE_TXT}, CASE WHEN project_type IS NOT NULL AND project_type <> '' "
              "THEN 'Project type: ' || project_type END)")
MERGE_CTES = SFT_CTES + [
    ("merged", """SELECT 'custom' AS origin, repo_url || '#' || chunk_no AS key, instruction, CAST(NULL AS VARCHAR) AS output, content, file_tree, project_type, CAST(NULL AS VARCHAR) AS input_text FROM samples
        UNION ALL
        SELECT 'public', conv_id || '#' || turn, instruction, output, content, CAST(NULL AS VARCHAR[]), CAST(NULL AS VARCHAR), '' FROM
          (SELECT * FROM v_sft_samples ORDER BY conv_id, turn LIMIT 10000)"""),
    ("texts", f"""SELECT origin, key, {alpaca_sql('instruction', "CASE WHEN origin = 'custom' THEN " + CUSTOM_TXT + " ELSE '' END", RESP)} AS text FROM merged"""),
]


def _merged(spark, sf):
    custom = _samples(spark, sf).select(F.lit("custom").alias("origin"),
                                        F.concat_ws("#", "repo_url", F.col("chunk_no").cast("string")).alias("key"),
                                        "instruction", "input", "content")
    pub = fixture(spark, sf, "v_sft_samples").select(
        F.lit("public").alias("origin"), F.concat_ws("#", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
        "instruction", "output", "content", F.lit("").alias("input_text"), "conv_id", "turn")
    return sft.merge_public(custom, pub, size=10000, order=("conv_id", "turn")).drop("conv_id", "turn")


@register("merge_public", with_views(SFT_VIEWS + ["v_sft_samples"], MERGE_CTES, recursive=True) + """
SELECT origin, key, instruction, output, content, project_type, CAST(len(file_tree) AS INT) AS file_count FROM merged""")
def q_merge_public(spark, sf):
    m = _merged(spark, sf)
    return m.select("origin", "key", "instruction", "output", "content", F.col("input.project_type").alias("project_type"),
                    F.size("input.file_tree").alias("file_count"))


def _texts(spark, sf):
    return sft.alpaca_text(_merged(spark, sf), input_text_col="input_text")


@register("training_text", with_views(SFT_VIEWS + ["v_sft_samples"], MERGE_CTES, recursive=True) + """
SELECT origin, key, text, row_number() OVER (ORDER BY md5(key || '7'), key)
       > CASE WHEN count(*) OVER () < 10 THEN count(*) OVER () ELSE floor(count(*) OVER () * CAST(0.95 AS DOUBLE)) END AS is_eval
FROM texts""")
def q_training_text(spark, sf):
    t = _texts(spark, sf)
    s = exact_hash_split(t, key="key", fraction=0.95, seed=7, flag="_train")
    return s.select("origin", "key", "text", (~F.col("_train")).alias("is_eval"))


@register("eval_split", with_views(SFT_VIEWS + ["v_sft_samples"], MERGE_CTES, recursive=True) + """
SELECT is_eval, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT row_number() OVER (ORDER BY md5(key || '7'), key)
       > CASE WHEN count(*) OVER () < 10 THEN count(*) OVER () ELSE floor(count(*) OVER () * CAST(0.95 AS DOUBLE)) END AS is_eval
  FROM texts) GROUP BY is_eval""")
def q_eval_split(spark, sf):
    t = _texts(spark, sf)
    s = exact_hash_split(t, key="key", fraction=0.95, seed=7, flag="_train")
    return s.groupBy((~F.col("_train")).alias("is_eval")).agg(F.count(F.lit(1)).alias("n"))


HEAD_SQL = """CASE WHEN nl >= 2 THEN head || chr(10) || '... (truncated, showing first 2 lines)' ELSE head END"""


@register("file_head", with_views(["v_repo_files"]) + f"""
SELECT repo_id, path, {HEAD_SQL} AS head FROM (
  SELECT repo_id, path, nl, CASE WHEN nl <= 2 THEN content ELSE array_to_string(string_split(content, chr(10))[1:2], chr(10)) || chr(10) END AS head
  FROM (SELECT repo_id, path, content, len(string_split(content, chr(10))) - CASE WHEN ends_with(content, chr(10)) OR content = '' THEN 1 ELSE 0 END AS nl
        FROM v_repo_files))""")
def q_file_head(spark, sf):
    f = fixture(spark, sf, "v_repo_files")
    return f.select("repo_id", "path", sft.file_head(F.col("content"), 2).alias("head"))


@register("code_context", with_views(CHUNK_VIEWS, [
    ("pf", """SELECT repo_id, file_no, path, content, lower(string_split(path, '/')[-1]) AS lname FROM v_repo_files"""),
    ("cands", "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c.lower()}')" for i, c in enumerate(rp.KEY_FILE_CANDIDATES)) + ") t(k_no, lk)"),
    ("kf", """SELECT pf.repo_id, c.k_no, arg_max(pf.path, pf.file_no) AS path FROM pf JOIN cands c ON pf.lname = c.lk GROUP BY pf.repo_id, c.k_no"""),
    ("heads", f"""SELECT DISTINCT kf.repo_id, kf.path, {HEAD_SQL.replace('2', '50')} AS head FROM kf JOIN (
        SELECT repo_id, path, nl, CASE WHEN nl <= 50 THEN content ELSE array_to_string(string_split(content, chr(10))[1:50], chr(10)) || chr(10) END AS head
        FROM (SELECT repo_id, path, content, len(string_split(content, chr(10))) - CASE WHEN ends_with(content, chr(10)) OR content = '' THEN 1 ELSE 0 END AS nl FROM v_repo_files)) h
        ON h.repo_id = kf.repo_id AND h.path = kf.path"""),
    ("ctx", "SELECT repo_id, count(*) AS n_files, string_agg(path || ':' || chr(10) || head, chr(10) || chr(10) ORDER BY path) AS context FROM heads GROUP BY repo_id"),
]) + """
SELECT r.repo_url, CAST(coalesce(c.n_files, 0) AS BIGINT) AS n_files, c.context FROM v_readme_samples r LEFT JOIN ctx c ON c.repo_id = r.files_repo_id""")
def q_code_context(spark, sf):
    """Key-file heads of each repository attached to its README sample (joined late, per repo)."""
    files = fixture(spark, sf, "v_repo_files")
    kf = rp.key_files(files).filter(F.col("key") != "package_init").select("repo_id", "path").distinct()
    heads = kf.join(files.select("repo_id", "path", "content"), ["repo_id", "path"]) \
        .select("repo_id", "path", sft.file_head(F.col("content"), 50).alias("head"))
    ctx = heads.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "head"))),
                                 lambda x: F.concat(x["path"], F.lit(":\n"), x["head"])), "\n\n").alias("context"))
    s = fixture(spark, sf, "v_readme_samples")
    out = s.join(ctx, s.files_repo_id == ctx.repo_id, "left")
    return out.select("repo_url", F.coalesce("n_files", F.lit(0)).alias("n_files"), "context")
