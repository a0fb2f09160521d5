"""Adapter views: the reference's record shapes derived from the driver tables.

Each view is plain SQL that runs unchanged on Spark and DuckDB, so the same
input feeds a Spark operator and its SQL oracle. Views are lazy: Spark folds
them into the query plan (pruning and pushdown still reach the parquet scan).
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.tables import TABLES, register_tables

VIEWS: dict[str, str] = {
    "v_md_lines": """
SELECT split_part('list-a|list-b|list-c', '|', 1 + CAST(p_partkey % 3 AS INT)) AS source,
       CAST(p_partkey % 3 AS INT) AS source_rank,
       p_partkey AS line_no,
       CASE WHEN p_partkey % 11 = 0 THEN '## ' || p_type
            WHEN p_partkey % 13 = 0 THEN 'See https://example.com/' || p_name
            ELSE '- [' || p_name || '](https://github.com/'
                 || CASE WHEN p_partkey % 4 = 0 THEN 'Org' ELSE 'org' END
                 || CAST(p_partkey % 40 AS STRING) || '/tool-' || CAST(p_partkey % 230 AS STRING)
                 || split_part('|/|#readme|?tab=x|/tree/main', '|', 1 + CAST(p_partkey % 5 AS INT))
                 || ')' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' - ' || p_name END
       END AS line
FROM part""",
    "v_fetches": """
SELECT 'https://raw.githubusercontent.com/' || d.source || '/repo' || CAST(d.doc_id AS STRING)
         || split_part('/main/README.md|/master/README.md|/main/readme.md|/master/readme.md', '|', r.rank) AS url,
       d.doc_id, r.rank,
       CASE WHEN (d.doc_id + r.rank * 3) % 7 < 2 THEN 200 ELSE 404 END AS status,
       CASE WHEN (d.doc_id + r.rank * 3) % 7 < 2 THEN d.text ELSE '' END AS body
FROM documents d
CROSS JOIN (SELECT 1 AS rank UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) r""",
    "v_readme_samples": """
SELECT 'https://github.com/' || source || '/repo' || CAST(doc_id AS STRING) AS repo_url,
       source AS owner, 'repo' || CAST(doc_id AS STRING) AS repo,
       source || '/repo' || CAST(doc_id AS STRING) AS name,
       CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'about ' || lang END AS description,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE lang END AS language,
       CAST(doc_id * 37 % 500 AS INT) AS stars,
       CASE WHEN doc_id % 50 = 7 THEN ''
            WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10))
            ELSE text END
         || CASE WHEN doc_id % 50 = 7 THEN ''
                 ELSE split_part('| web| cli| library| framework| android|', '|', 1 + CAST(doc_id % 7 AS INT)) END AS readme,
       source AS source, CAST((doc_id - doc_id % 8) / 8 AS BIGINT) AS files_repo_id, doc_id
FROM documents""",
    "v_sectioned": """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN replace(text, chr(10), chr(10) || '## ')
                    WHEN doc_id % 3 = 1 THEN replace(text, chr(10), chr(10) || '### ')
                    ELSE text END AS readme
FROM documents""",
    # One file for each order and line number: eight orders make a repository; order and line give the file its number. A file of an
    # order whose key is a document's id holds that document's text below its code.
    # each document is one file's text: that of its order's first line, or a file of its own where there is none
    "v_repo_files": """
SELECT CAST((k - k % 8) / 8 AS BIGINT) AS repo_id,
       CASE WHEN k % 8 = 0 THEN '' ELSE 'mod' || CAST(k % 8 AS STRING) || '/' END
       || split_part('|src/|src/app/|api/|services/|tests/|docs/|k8s/|cmd/|lib/core/', '|', 1 + CAST(p % 10 AS INT))
       || split_part('main.py|README.md|setup.py|utils.py|models.py|index.js|package.json|__init__.py|docker-compose.yml|server.go|go.mod|Cargo.toml|cache.py|.gitignore|infra.tf|cli.py', '|',
                     1 + CAST((k + n) % 16 AS INT)) AS path,
       CAST((k % 8) * 8 + n AS INT) AS file_no,
       replace(split_part('import flask~@app.route("/")~def home(): pass|from fastapi import APIRouter~router = APIRouter()|import sqlalchemy~engine = create_engine(url)|class User(Base):~    id = Column(int)|class OrderService:~    pass|import redis~c = redis.Redis()|import celery~q = Queue()|import mod1.src.models.py~import utils~import boto3|x = 1|from models import User~import pymongo|service handler s3|def broken(:', '|',
               1 + CAST((p + s) % 12 AS INT)), '~', chr(10))
       || CASE WHEN text IS NULL THEN '' ELSE chr(10) || text END AS content
FROM (SELECT coalesce(l_orderkey, doc_id) AS k, coalesce(l_linenumber, 0) AS n, coalesce(l_partkey, doc_id) AS p, coalesce(l_suppkey, 0) AS s, text
      FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem
            GROUP BY l_orderkey, l_linenumber) t
      FULL OUTER JOIN documents d ON d.doc_id = l_orderkey AND l_linenumber = 1) f""",
    "v_search_items": """
SELECT 'https://github.com/org' || CAST(p_partkey % 90 AS STRING) || '/' || replace(p_name, ' ', '-') || CAST(p_partkey AS STRING) AS url,
       'org' || CAST(p_partkey % 90 AS STRING) AS owner,
       CASE WHEN p_partkey % 17 = 0 THEN 'awesome-' ELSE '' END || replace(p_name, ' ', '-') AS name,
       CAST(p_partkey * 31 % 900 AS INT) AS stars,
       nullif(split_part('Python|JavaScript|Go|Java|', '|', 1 + CAST(p_partkey % 5 AS INT)), '') AS language,
       nullif(split_part('web app for teams|rest api server|a curated list|full stack shop|tutorial code|sdk for x||plain service', '|', 1 + CAST(p_partkey % 8 AS INT)), '') AS description,
       split(split_part('docker,k8s|Tutorial,web|api|library,go|web', '|', 1 + CAST(p_size % 5 AS INT)), ',') AS topics,
       CAST('2024-01-01' AS TIMESTAMP) - INTERVAL '1' DAY * CAST(p_partkey % 1500 AS INT) AS updated_at,
       CAST(p_partkey % 6 AS INT) AS query_no
FROM part""",
    # Not in FIXTURES.md: one saved search and one filter document for each supplier.
    "v_searches": """
SELECT s_suppkey AS search_id, CAST(s_suppkey * 13 % 700 AS INT) AS min_stars,
       nullif(split_part('Python|JavaScript|Go|Java|', '|', 1 + CAST(s_suppkey % 5 AS INT)), '') AS language,
       CASE WHEN s_suppkey % 3 = 0 THEN CAST('2022-01-01' AS TIMESTAMP) END AS pushed_after,
       split(CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE split_part('Widget|bolt,rest api|ring,x|gear|web app', '|', 1 + CAST(s_suppkey % 7 % 5 AS INT)) || ','
             || split_part('red|blue|hot g|SDK', '|', 1 + CAST(s_suppkey % 4 AS INT)) END, ',') AS positive,
       split(split_part('awesome|tutorial,library|shop|', '|', 1 + CAST(s_suppkey % 4 AS INT)), ',') AS negative
FROM supplier""",
    "v_filters": """
SELECT s_suppkey AS filter_id,
       '{"stars": {"$gte": ' || CAST(s_suppkey * 7 % 800 AS STRING) || ', "$lt": ' || CAST(s_suppkey * 7 % 800 + 60 AS STRING)
       || '}, "$or": [{"language": ' || CASE WHEN s_suppkey % 6 = 0 THEN 'null' ELSE '"' || split_part('Python|JavaScript|Go|Java|Rust', '|', 1 + CAST(s_suppkey % 5 AS INT)) || '"' END
       || '}, {"topics": {"$in": ["web", "k8s"]}, "description": {"$ne": null}}]}' AS document
FROM supplier""",
    "v_sft_samples": """
SELECT conv_id, turn, instruction, output, content, project_type
FROM (SELECT conv_id, turn, role, text AS instruction,
             CASE WHEN conv_id % 4 = 0 THEN NULL ELSE lead(text) OVER (PARTITION BY conv_id ORDER BY turn) END AS output,
             lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS content,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
             CASE WHEN conv_id % 9 = 0 THEN NULL ELSE 'api' END AS project_type
      FROM conversations) t
WHERE role = 'user' AND next_role = 'assistant'""",
    "v_answers": """
SELECT item_id AS batch_no, 3 AS n,
       CASE CAST(item_id % 5 AS INT)
            WHEN 0 THEN 'Sure: ["one", "two", "three"]'
            WHEN 1 THEN '["only one"]'
            WHEN 2 THEN 'no json here'
            WHEN 3 THEN '["a", "b", "c", "d"]'
            ELSE '["broken", ]x]' END AS answer
FROM benchmark""",
    "v_review_log": """
SELECT 'https://github.com/u/r' || CAST(user_id AS STRING) AS repo_url,
       CASE event_type WHEN 'purchase' THEN 'keep' WHEN 'error' THEN 'discard' ELSE 'undo' END AS decision,
       ts, event_id
FROM events""",
    "v_points": """
SELECT vec_id AS id, embedding, label,
       CASE WHEN vec_id % 10 = 0 THEN '' ELSE 'passage ' || CAST(vec_id AS STRING) END AS content
FROM embeddings""",
    "v_marked_docs": """
SELECT conv_id || '/' || turn AS doc_id,
       'intro' || chr(10) || '<!-- DOC_' || CASE WHEN conv_id % 3 = 0 THEN 'MANUAL' ELSE 'AUTO' END || ':api v'
         || CAST(1 + conv_id % 4 AS STRING) || ' -->' || chr(10) || text || chr(10) || '<!-- DOC_'
         || CASE WHEN conv_id % 3 = 0 THEN 'MANUAL' ELSE 'AUTO' END || '_END:api -->' || chr(10) || 'outro' AS existing,
       CASE WHEN conv_id % 5 = 0 THEN 'usage' ELSE 'api' END AS block_name,
       CASE WHEN conv_id % 2 = 0 THEN text ELSE 'new text' END AS new_content
FROM conversations""",
    # Not in FIXTURES.md: API reference pages for the incremental merge (T8, M3), one per conversation turn.
    "v_api_docs": """
SELECT conv_id AS doc_id, turn,
  '## Guide ' || CAST(conv_id AS STRING) || chr(10) || chr(10)
  || '### fn' || CAST(length(text) % 7 AS STRING) || '(a, b)' || chr(10) || split_part(text, '.', 1) || chr(10)
  || '### api' || CAST(turn % 3 AS STRING) || '.call(x)' || chr(10) || 'Body of turn ' || CAST(turn AS STRING) || chr(10)
  || '```python' || chr(10) || 'print(' || CAST(turn % 2 AS STRING) || ')' || chr(10) || '```' AS content
FROM conversations""",
}

# Non-portable views: written once per engine (aggregate list functions differ).
SPARK_ONLY: dict[str, str] = {
    "v_repo_trees": "SELECT repo_id, array_sort(collect_list(path)) AS file_tree FROM v_repo_files GROUP BY repo_id",
}
DUCKDB_ONLY: dict[str, str] = {
    "v_repo_trees": "SELECT repo_id, list_sort(list(path)) AS file_tree FROM v_repo_files GROUP BY repo_id",
}

DEPENDS: dict[str, tuple[str, ...]] = {"v_repo_trees": ("v_repo_files",)}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


_VIEW_LOCK = threading.Lock()


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy DataFrame of one adapter view over the tables in ``sf_dir``.

    Views are resolved while the session's temp views point at ``sf_dir``; the
    returned DataFrame is already analysed, so later re-registrations (another
    scale directory, another thread) do not change it.
    """
    with _VIEW_LOCK:
        for n in _order([name]):
            sql = SPARK_ONLY.get(n) or VIEWS[n]
            register_tables(spark, sf_dir, [t for t in TABLES if re.search(rf"\b{t}\b", sql)])
            spark.sql(sql).createOrReplaceTempView(n)
        return spark.sql(f"SELECT * FROM {name}")


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the given views (and their dependencies) for DuckDB."""
    parts = [f"{n} AS ({DUCKDB_ONLY.get(n) or VIEWS[n]})" for n in _order(names)]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
