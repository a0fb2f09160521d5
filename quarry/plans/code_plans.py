"""Registered queries: code-file analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import code as cd
from quarry.plans.registry import register
from quarry.plans.repo_plans import PF, TOP_OK, TYPE_AGG, TYPE_CASE, VALID_AGG, q  # noqa: F401
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture


def cascade(col, rules, default="NULL"):
    parts = []
    for label, words in rules:
        cond = " OR ".join(f"contains({col}, '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{label}'")
    d = default if default == "NULL" else f"'{default}'"
    return "CASE " + " ".join(parts) + f" ELSE {d} END"


def _files(spark, sf):
    return fixture(spark, sf, "v_repo_files")


@register("path_role", with_views(["v_repo_files"]) +
          f"SELECT repo_id, path, {cascade('lower(path)', cd.PATH_ROLE_RULES)} AS role FROM v_repo_files")
def q_path_role(spark, sf):
    return _files(spark, sf).select("repo_id", "path", cd.path_role("path").alias("role"))


IMPORT_LINES_CTE = ("il", """SELECT repo_id, path, unnest(l) AS line, CAST(generate_subscripts(l, 1) - 1 AS INT) AS line_no FROM (
  SELECT repo_id, path, list_filter(list_transform(string_split(content, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
                                   lambda x: starts_with(x, 'import ') OR starts_with(x, 'from ')) AS l FROM v_repo_files)""")


def _import_rows(spark, sf):
    f = _files(spark, sf)
    return f.select("repo_id", "path", F.posexplode(cd.import_lines("content")).alias("line_no", "line"))


@register("import_lines", with_views(["v_repo_files"], [IMPORT_LINES_CTE]) + "SELECT repo_id, path, line_no, line FROM il")
def q_import_lines(spark, sf):
    return _import_rows(spark, sf)


@register("import_role", with_views(["v_repo_files"], [IMPORT_LINES_CTE]) +
          f"SELECT repo_id, path, line_no, {cascade('lower(line)', cd.IMPORT_ROLE_RULES)} AS role FROM il")
def q_import_role(spark, sf):
    return _import_rows(spark, sf).select("repo_id", "path", "line_no", cd.import_role("line").alias("role"))


FLAG_SQL = ", ".join(
    "(" + " OR ".join(f"contains(lower(content), '{w}')" for w in words) + f") AS has_{k}"
    for k, words in cd.CODE_FLAGS.items())


@register("code_flags", with_views(["v_repo_files"]) + f"SELECT repo_id, path, {FLAG_SQL} FROM v_repo_files")
def q_code_flags(spark, sf):
    return _files(spark, sf).select("repo_id", "path", *cd.code_flags("content"))


@register("db_type", with_views(["v_repo_files"]) +
          f"SELECT repo_id, path, {cascade('lower(content)', cd.DB_TYPE_RULES, 'Database')} AS db_type FROM v_repo_files")
def q_db_type(spark, sf):
    return _files(spark, sf).select("repo_id", "path", cd.db_type("content").alias("db_type"))


def _rx(p, ic):
    return f"regexp_matches(content, '{p}'" + (", 'i')" if ic else ")")


def regex_type_sql():
    api = [_rx(p, True) for p in cd.API_PATTERNS]
    model = " OR ".join(_rx(p, False) for p in cd.MODEL_PATTERNS)
    db = [_rx(p, True) for p in cd.DB_PATTERNS]
    sv = [_rx(p, True) for p in cd.SERVICE_PATTERNS]
    cache, queue = _rx(cd.CACHE_PATTERN, True), _rx(cd.QUEUE_PATTERN, True)
    typ = (f"CASE WHEN {model} THEN 'model' WHEN {' OR '.join(api)} THEN 'api_server' WHEN {' OR '.join(db)} THEN 'database' "
           f"WHEN {' OR '.join(sv)} THEN 'service' WHEN {cache} THEN 'cache' WHEN {queue} THEN 'queue' END")
    api_ev = "CASE " + " ".join(f"WHEN {a} THEN 'Found API route pattern: {p}'" for a, p in zip(api, cd.API_PATTERNS)) + " END"
    ev = [api_ev, f"CASE WHEN {model} THEN 'Found SQLAlchemy model pattern' END"]
    ev += [f"CASE WHEN {h} THEN 'Found database pattern: {p}' END" for h, p in zip(db, cd.DB_PATTERNS)]
    ev += [f"CASE WHEN {h} THEN 'Found service pattern: {p}' END" for h, p in zip(sv, cd.SERVICE_PATTERNS)]
    ev += [f"CASE WHEN {cache} THEN 'Found cache usage' END", f"CASE WHEN {queue} THEN 'Found queue usage' END"]
    return typ, "concat_ws(' | ', " + ", ".join(ev) + ")"


RX_TYPE, RX_EV = regex_type_sql()
TYPED_CTE = ("typed", f"""SELECT * FROM (SELECT repo_id, file_no, path, {RX_TYPE} AS type, {RX_EV} AS evidence FROM v_repo_files
   WHERE ends_with(path, '.py') AND length(string_split(path, '/')[-1]) > 3) WHERE type IS NOT NULL""")


@register("file_types_regex", with_views(["v_repo_files"], [TYPED_CTE]) + "SELECT * FROM typed")
def q_file_types_regex(spark, sf):
    return cd.file_types_regex(_files(spark, sf)).withColumn("evidence", F.array_join("evidence", " | "))


COMP_CTE = ("comps", """
SELECT repo_id, component_no, name, type, layer, confidence, evidence FROM (
 SELECT repo_id, 0 AS component_no, 'API Server' AS name, 'server' AS type, 'frontend' AS layer, 1.0::DOUBLE AS confidence,
        'Found ' || n_api || ' API files with route decorators' AS evidence, n_api > 0 AS present FROM cnt
 UNION ALL SELECT repo_id, 1, 'Database', 'database', 'data', 1.0, 'Found ' || n_db || ' DB files, ' || n_model || ' model files', n_db + n_model > 0 FROM cnt
 UNION ALL SELECT repo_id, 2, 'Business Logic', 'application', 'middle', 1.0, 'Found ' || n_service || ' service files', n_service > 0 FROM cnt
 UNION ALL SELECT repo_id, 3, 'Cache', 'cache', 'data', 1.0, 'Found ' || n_cache || ' cache files', n_cache > 0 FROM cnt
 UNION ALL SELECT repo_id, 4, 'Message Queue', 'queue', 'middle', 1.0, 'Found ' || n_queue || ' queue files', n_queue > 0 FROM cnt
 UNION ALL SELECT repo_id, 5, 'Worker', 'worker', 'middle', 0.8, NULL, n_queue > 0 FROM cnt) WHERE present""")
CNT_CTE = ("cnt", """SELECT repo_id, count(*) FILTER (WHERE type = 'api_server') AS n_api, count(*) FILTER (WHERE type = 'database') AS n_db,
   count(*) FILTER (WHERE type = 'service') AS n_service, count(*) FILTER (WHERE type = 'model') AS n_model,
   count(*) FILTER (WHERE type = 'cache') AS n_cache, count(*) FILTER (WHERE type = 'queue') AS n_queue FROM typed GROUP BY repo_id""")


def _regex_arch(spark, sf):
    return cd.architecture(_files(spark, sf), mode="regex")


@register("components", with_views(["v_repo_files"], [TYPED_CTE, CNT_CTE, COMP_CTE]) + "SELECT * FROM comps")
def q_components(spark, sf):
    return _regex_arch(spark, sf)[1]


LAYERS_CTE = ("lay", """SELECT repo_id,
   coalesce(bool_or(name IN ('API Server', 'Web Server')), false) AS frontend_layer,
   coalesce(bool_or(type = 'application' OR name = 'Business Logic'), false) AS application_layer,
   coalesce(bool_or(type IN ('database', 'cache', 'storage')), false) AS data_layer,
   count(*) AS component_count FROM comps GROUP BY repo_id""")


@register("layers", with_views(["v_repo_files"], [TYPED_CTE, CNT_CTE, COMP_CTE, LAYERS_CTE]) + """
SELECT *, CAST(frontend_layer AS INT) + CAST(application_layer AS INT) + CAST(data_layer AS INT) AS layer_count FROM lay""")
def q_layers(spark, sf):
    return cd.layers(_regex_arch(spark, sf)[1])


def _component_names(comps):
    return comps.groupBy("repo_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("component_no", "name"))), lambda x: x["name"]), ", ")
        .alias("components"))


@register("architecture", with_views(["v_repo_files"], [TYPED_CTE, CNT_CTE, COMP_CTE]) + """
SELECT t.repo_id, CAST(count(*) AS BIGINT) AS typed_files,
       (SELECT string_agg(name, ', ' ORDER BY component_no) FROM comps c WHERE c.repo_id = t.repo_id) AS components
FROM typed t GROUP BY t.repo_id""")
def q_architecture(spark, sf):
    typed, comps, _ = _regex_arch(spark, sf)
    return typed.groupBy("repo_id").agg(F.count(F.lit(1)).alias("typed_files")).join(_component_names(comps), "repo_id", "left")


# Import module names parsed from import lines (regex form of the syntax-tree rule): ``import a`` -> a,
# ``from m import x`` -> m.x. Types come from the regex typing, so the check runs on SQL too.
EDGE_CTES = [
    IMPORT_LINES_CTE, TYPED_CTE,
    ("imps", """SELECT i.repo_id, t.file_no, i.line_no AS imp_no, t.type AS "from",
        CASE WHEN starts_with(i.line, 'from ') THEN regexp_extract(i.line, '^from\\s+(\\S+)\\s+import\\s+(\\S+)', 1) || '.' || regexp_extract(i.line, '^from\\s+(\\S+)\\s+import\\s+(\\S+)', 2)
             ELSE regexp_extract(i.line, '^import\\s+(\\S+)', 1) END AS import
        FROM il i JOIN typed t ON t.repo_id = i.repo_id AND t.path = i.path"""),
    ("kw", f"SELECT *, {cascade('lower(import)', cd.IMPORT_TARGET_RULES)} AS _kw FROM imps"),
    ("theta", """SELECT u.repo_id, u.import, arg_min(t.type, t.file_no) AS _theta FROM (SELECT DISTINCT repo_id, import FROM kw WHERE _kw IS NULL) u
        JOIN typed t ON t.repo_id = u.repo_id
        WHERE contains(t.path, u.import) OR contains(u.import, replace(t.path, '/', '.')) GROUP BY u.repo_id, u.import"""),
    ("ncon", """SELECT k.repo_id, count(*) AS conns FROM kw k LEFT JOIN theta th ON th.repo_id = k.repo_id AND th.import = k.import
        WHERE coalesce(k._kw, th._theta) IS NOT NULL GROUP BY k.repo_id"""),
]


def _edge_inputs(spark, sf):
    return cd.typed_with_imports(_files(spark, sf))


@register("import_edges", with_views(["v_repo_files"], EDGE_CTES) + """
SELECT k.repo_id, k.file_no, k.imp_no, k."from", coalesce(k._kw, th._theta) AS "to", 0.9::DOUBLE AS confidence
FROM kw k LEFT JOIN theta th ON th.repo_id = k.repo_id AND th.import = k.import
WHERE coalesce(k._kw, th._theta) IS NOT NULL""")
def q_import_edges(spark, sf):
    typed, imps = _edge_inputs(spark, sf)
    return cd.import_edges(typed, imps)


KF_VALUES = ", ".join(f"({i}, '{c.lower()}')" for i, c in enumerate(__import__("quarry.operators.repos", fromlist=["x"]).KEY_FILE_CANDIDATES))
PRE_CTES = [PF, *EDGE_CTES, CNT_CTE, COMP_CTE, LAYERS_CTE,
            ("kfc", f"SELECT * FROM (VALUES {KF_VALUES}) t(k_no, lk)"),
            ("entry", f"""SELECT DISTINCT pf.repo_id FROM pf JOIN kfc ON pf.lname = kfc.lk
                          WHERE pf.lname IN ({q(cd.ENTRY_POINTS)})"""),
            ("g", f"""SELECT repo_id, {VALID_AGG}, {TYPE_AGG},
                count(*) FILTER (WHERE suffix IN ({q(cd.PREFILTER_CODE_EXT)})) AS _code,
                count(DISTINCT parent) FILTER (WHERE suffix IN ({q(cd.PREFILTER_CODE_EXT)})) AS _code_dirs FROM pf GROUP BY repo_id""")]


@register("review_prefilter", with_views(["v_repo_files"], PRE_CTES) + f"""
SELECT repo_id, reason IS NULL AS ok,
       coalesce(reason, 'OK - ' || nlay || ' layers, ' || ncomp || ' components') AS reason FROM (
 SELECT g.repo_id, coalesce(l.layer_count, 0) AS nlay, coalesce(l.component_count, 0) AS ncomp, CASE
   WHEN (CASE WHEN _visible = 0 THEN 1 WHEN _pyv < 5 THEN 1 WHEN _codev / _visible < 0.25 THEN 1 WHEN NOT _struct THEN 1 END) IS NOT NULL
     THEN 'not a valid coding project'
   WHEN {TYPE_CASE} = 'library' THEN 'library project'
   WHEN {TYPE_CASE} NOT IN ('application', 'cli') AND e.repo_id IS NULL THEN 'no application entry point'
   WHEN coalesce(l.layer_count, 0) < 2 THEN 'only ' || coalesce(l.layer_count, 0) || ' layer(s)'
   WHEN coalesce(l.component_count, 0) < 3 THEN 'too few components: ' || coalesce(l.component_count, 0)
   WHEN coalesce(nc.conns, 0) = 0 AND coalesce(l.component_count, 0) < 4 THEN 'no component connections'
   WHEN _code < 10 THEN 'too few code files: ' || _code
   WHEN _code > 500 THEN 'repository too large: ' || _code
   WHEN _code_dirs < 3 THEN 'files in too few directories: ' || _code_dirs END AS reason
 FROM g LEFT JOIN (SELECT *, CAST(frontend_layer AS INT) + CAST(application_layer AS INT) + CAST(data_layer AS INT) AS layer_count FROM lay) l
   ON l.repo_id = g.repo_id LEFT JOIN entry e ON e.repo_id = g.repo_id LEFT JOIN ncon nc ON nc.repo_id = g.repo_id)""")
def q_review_prefilter(spark, sf):
    f = _files(spark, sf)
    _, comps, conns = cd.architecture(f, mode="regex")
    return cd.review_prefilter(f, comps, conns)


# ---- syntax-tree mode (Python ``ast`` in mapInPandas): rows-only checks
@register("code_facts")
def q_code_facts(spark, sf):
    return cd.code_facts(_files(spark, sf))


@register("file_types")
def q_file_types(spark, sf):
    return cd.file_types(_files(spark, sf))


@register("file_facts")
def q_file_facts(spark, sf):
    """C4: each typed file with its imports and evidence, its connections and its repository's components."""
    typed, comps, conns = cd.architecture(_files(spark, sf), mode="ast", results=True)
    n = conns.groupBy("repo_id", "file_no").agg(F.count(F.lit(1)).alias("connections"))
    return typed.join(n.hint("merge"), ["repo_id", "file_no"], "left").fillna(0, ["connections"]) \
        .join(_component_names(comps).hint("merge"), "repo_id", "left")


@register("connections_ast")
def q_connections_ast(spark, sf):
    return cd.architecture(_files(spark, sf), mode="ast")[2]


@register("connections", with_views(["v_repo_files"], EDGE_CTES) + """
SELECT k.repo_id, k."from", coalesce(k._kw, th._theta) AS "to", count(*) AS edges, 0.9::DOUBLE AS confidence
FROM kw k LEFT JOIN theta th ON th.repo_id = k.repo_id AND th.import = k.import
WHERE coalesce(k._kw, th._theta) IS NOT NULL GROUP BY 1, 2, 3""")
def q_connections(spark, sf):
    """Connections between file types per repository (duplicates counted)."""
    typed, imps = _edge_inputs(spark, sf)
    e = cd.import_edges(typed, imps)
    return e.groupBy("repo_id", "from", "to").agg(F.count(F.lit(1)).alias("edges"), F.first("confidence").alias("confidence"))
