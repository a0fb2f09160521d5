"""Helpers that build DuckDB SQL for oracles (shared CTE fragments)."""

from __future__ import annotations

from quarry.sources.fixtures import duckdb_with


def with_views(views, ctes=(), recursive: bool = False) -> str:
    """``WITH [RECURSIVE]`` clause: fixture views first, then extra ``(name, sql)`` CTEs."""
    head = duckdb_with(*views)
    parts = [head[len("WITH "):].rstrip()] if head else []
    parts += [f"{n} AS ({s})" for n, s in ctes]
    kw = "WITH RECURSIVE " if recursive else "WITH "
    if not any(parts):
        return ""
    return kw + ",\n".join(p for p in parts if p) + "\n"


def sentence_chunk_ctes(src: str, id_col: str, text_col: str, *, min_length: int = 1000,
                        max_length: int = 2000, prefix: str = "t3") -> list[tuple[str, str]]:
    """CTEs computing ``{prefix}_out(id, chunk_no, chunk)`` with the greedy sentence fold.

    RE2 has no look-behind: boundaries are first marked with chr(1), then split.
    """
    mn, mx, p = min_length, max_length, prefix
    return [
        (f"{p}_src", f"SELECT {id_col} AS id, {text_col} AS t FROM {src}"),
        (f"{p}_parts", f"""
SELECT id, p, row_number() OVER (PARTITION BY id ORDER BY ord) AS i FROM (
  SELECT id, regexp_replace(p0, '^\\s+|\\s+$', '', 'g') AS p, ord FROM (
    SELECT id, unnest(l) AS p0, generate_subscripts(l, 1) AS ord FROM (
      SELECT id, string_split(regexp_replace(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(1), 'g'),
                                             '\\n\\n+', chr(1), 'g'), chr(1)) AS l
      FROM {p}_src WHERE length(t) > {mx}))) WHERE p <> ''"""),
        (f"{p}_n", f"SELECT id, max(i) AS n FROM {p}_parts GROUP BY id"),
        (f"{p}_fold", f"""
SELECT id, 0 AS i, '' AS cur, 0 AS cur_len, 0 AS cur_n, 0 AS nemit, []::VARCHAR[] AS out FROM {p}_n
UNION ALL
SELECT id, i + 1,
       CASE WHEN fits THEN (CASE WHEN cur_n > 0 THEN cur || chr(10) || chr(10) || p ELSE p END)
            WHEN lp > {mx} THEN '' ELSE p END,
       CASE WHEN fits THEN cur_len + need WHEN lp > {mx} THEN 0 ELSE lp END,
       CASE WHEN fits THEN cur_n + 1 WHEN lp > {mx} THEN 0 ELSE 1 END,
       nemit + len(o),
       o
FROM (SELECT *, CASE WHEN fits THEN []::VARCHAR[]
                     ELSE list_concat(CASE WHEN cur_n > 0 AND length(cur) >= {mn} THEN [cur] ELSE []::VARCHAR[] END,
                                      CASE WHEN lp > {mx} THEN [substring(p, x * {mx} + 1, {mx}) FOR x IN range(0, CAST(ceil(lp / {mx}.0) AS BIGINT))]
                                           ELSE []::VARCHAR[] END) END AS o
      FROM (SELECT f.id, f.i, f.cur, f.cur_len, f.cur_n, f.nemit, q.p, length(q.p) AS lp,
                   length(q.p) + CASE WHEN f.cur_n > 0 THEN 1 ELSE 0 END AS need,
                   f.cur_len + length(q.p) + CASE WHEN f.cur_n > 0 THEN 1 ELSE 0 END <= {mx} AS fits
            FROM {p}_fold f JOIN {p}_parts q ON q.id = f.id AND q.i = f.i + 1) s0) s1"""),
        (f"{p}_emits", f"""
SELECT id, i, unnest(out) AS chunk, generate_subscripts(out, 1) AS pos FROM {p}_fold WHERE len(out) > 0
UNION ALL
SELECT f.id, f.i + 1 AS i, f.cur AS chunk, 1 AS pos FROM {p}_fold f JOIN {p}_n n ON f.id = n.id AND f.i = n.n
WHERE f.cur_n > 0 AND (length(f.cur) >= {mn} OR f.nemit = 0)"""),
        (f"{p}_out", f"""
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i, pos) - 1 AS INT) AS chunk_no, chunk FROM {p}_emits
UNION ALL
SELECT id, 0 AS chunk_no, t AS chunk FROM {p}_src WHERE t IS NOT NULL AND length(t) > 0 AND length(t) <= {mx}"""),
    ]
