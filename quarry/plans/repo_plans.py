"""Registered queries: repository analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import repos as rp
from quarry.plans.registry import register
from quarry.plans.sqlkit import with_views
from quarry.sources.fixtures import fixture
from quarry.sources.tables import table


def q(xs):
    return ", ".join("'" + x + "'" for x in xs)


def like_any(col, words):
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


PF = ("pf", """SELECT repo_id, file_no, path, content, string_split(path, '/')[-1] AS name,
        lower(string_split(path, '/')[-1]) AS lname, lower(path) AS lpath,
        regexp_extract(string_split(path, '/')[-1], '^.+(\\.[^.]+)$', 1) AS suffix,
        regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent,
        CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) END AS top FROM v_repo_files""")

TYPE_AGG = f"""coalesce(bool_or(lname IN ({q(rp.APP_SIGNALS)})), false) AS _app,
  coalesce(bool_or({like_any('lpath', rp.WEB_FRAMEWORKS)}), false) AS _web,
  coalesce(bool_or(lname IN ('docker-compose.yml', 'dockerfile')), false) AS _docker,
  coalesce(bool_or(lname IN ({q(rp.CLI_SIGNALS)})), false) AS _cli,
  coalesce(bool_or({like_any('lpath', rp.CLI_PATHS)}), false) AS _clipath,
  coalesce(bool_or(lname IN ({q(rp.LIBRARY_INDICATORS)})), false) AS _lib,
  coalesce(bool_or(contains(lpath, 'src/') OR contains(lpath, '/__init__.py')), false) AS _srcpkg,
  count(*) FILTER (WHERE suffix = '.py') AS _py"""
TYPE_CASE = """CASE WHEN _app OR _web OR _docker THEN 'application' WHEN _cli OR _clipath THEN 'cli'
  WHEN _lib THEN 'library' WHEN _srcpkg AND _py > 3 THEN 'library' WHEN _py > 5 THEN 'library' ELSE 'unknown' END"""


def lang_agg(legacy):
    def ind(xs):
        return [x for x in xs if x == x.lower()] if legacy else [x.lower() for x in xs]
    rust = f"lname IN ({q(ind(rp.RUST_INDICATORS))})" if ind(rp.RUST_INDICATORS) else "false"
    return f"""coalesce(bool_or(lname IN ({q(ind(rp.PYTHON_INDICATORS))})), false) AS _pyind,
  coalesce(bool_or(suffix = '.py'), false) AS _pyfile,
  coalesce(bool_or(lname IN ({q(ind(rp.NODE_INDICATORS))})), false) AS _node,
  coalesce(bool_or(lname IN ({q(ind(rp.GO_INDICATORS))})), false) AS _go,
  coalesce(bool_or({rust}), false) AS _rust"""


LANG_CASE = """CASE WHEN _pyind OR _pyfile THEN 'python' WHEN _node THEN 'nodejs' WHEN _go THEN 'go'
  WHEN _rust THEN 'rust' ELSE 'unknown' END"""


def _files(spark, sf):
    return fixture(spark, sf, "v_repo_files")


@register("project_type", with_views(["v_repo_files"], [PF]) +
          f"SELECT repo_id, {TYPE_CASE} AS project_type FROM (SELECT repo_id, {TYPE_AGG} FROM pf GROUP BY repo_id)")
def q_project_type(spark, sf):
    return rp.project_type(_files(spark, sf))


@register("project_language", with_views(["v_repo_files"], [PF]) + f"""
SELECT a.repo_id, a.project_language, b.legacy_language FROM
 (SELECT repo_id, {LANG_CASE} AS project_language FROM (SELECT repo_id, {lang_agg(False)} FROM pf GROUP BY repo_id)) a
 JOIN (SELECT repo_id, {LANG_CASE} AS legacy_language FROM (SELECT repo_id, {lang_agg(True)} FROM pf GROUP BY repo_id)) b
 ON a.repo_id = b.repo_id""")
def q_project_language(spark, sf):
    f = _files(spark, sf)
    a = rp.project_language(f)
    b = rp.project_language(f, legacy=True).withColumnRenamed("project_language", "legacy_language")
    return a.join(b, "repo_id")


KEYS_SQL_VALUES = ", ".join(f"({i}, '{c}', '{c.lower()}')" for i, c in enumerate(rp.KEY_FILE_CANDIDATES))
KF_CTES = [PF, ("cands", f"SELECT * FROM (VALUES {KEYS_SQL_VALUES}) t(k_no, k, lk)"),
           ("kf", """SELECT pf.repo_id, c.k_no, c.k AS key, arg_max(pf.path, pf.file_no) AS path FROM pf JOIN cands c ON pf.lname = c.lk
                     GROUP BY pf.repo_id, c.k_no, c.k
                     UNION ALL
                     SELECT repo_id, 99, 'package_init', arg_min(path, file_no) FROM pf
                     WHERE contains(path, '/') AND name = '__init__.py' GROUP BY repo_id""")]


@register("key_files", with_views(["v_repo_files"], KF_CTES) + "SELECT repo_id, key, path FROM kf")
def q_key_files(spark, sf):
    return rp.key_files(_files(spark, sf))


@register("repo_summary", with_views(["v_repo_files"], KF_CTES) + f"""
SELECT t.repo_id, {TYPE_CASE} AS project_type, {LANG_CASE} AS project_language,
       (SELECT string_agg(key || '=' || path, ';' ORDER BY k_no) FROM kf WHERE kf.repo_id = t.repo_id) AS key_files,
       file_count
FROM (SELECT repo_id, {TYPE_AGG}, {lang_agg(False)}, count(*) AS file_count FROM pf GROUP BY repo_id) t""")
def q_repo_summary(spark, sf):
    s = rp.repo_summary(_files(spark, sf))
    kf = F.array_join(F.transform(F.map_entries("key_files"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return s.select("repo_id", "project_type", "project_language", F.when(F.size("key_files") > 0, kf).alias("key_files"),
                    "file_count")


TOP_OK = f"(top IS NOT NULL AND NOT starts_with(top, '.') AND top NOT IN ({q(rp.IGNORED_TOP_DIRS)}))"


@register("structure_stats", with_views(["v_repo_files"], [PF]) + f"""
SELECT repo_id, array_to_string(list_sort(list(DISTINCT top) FILTER (WHERE {TOP_OK})), '|') AS top_level_dirs,
  coalesce(bool_or({TOP_OK} AND top IN ({q(rp.FRONTEND_DIRS)})), false) AS has_frontend,
  coalesce(bool_or({TOP_OK} AND top IN ({q(rp.BACKEND_DIRS)})), false) AS has_backend,
  coalesce(bool_or({TOP_OK} AND top IN ({q(rp.SERVER_DIRS)})), false) AS has_server,
  coalesce(bool_or({TOP_OK} AND contains(lower(top), 'api')), false) AS has_api,
  coalesce(bool_or({TOP_OK} AND top IN ({q(rp.DATABASE_DIRS)})), false) AS has_database,
  coalesce(bool_or(path IN ('docker-compose.yml', 'Dockerfile') OR starts_with(path, 'docker-compose.yml/') OR starts_with(path, 'Dockerfile/')), false) AS has_docker,
  coalesce(bool_or(path IN ('k8s', 'helm') OR starts_with(path, 'k8s/') OR starts_with(path, 'helm/')), false) AS has_k8s,
  count(*) FILTER (WHERE suffix IN ({q(rp.REVIEW_CODE_EXT)})) AS code_file_count,
  count(DISTINCT parent) FILTER (WHERE suffix IN ({q(rp.REVIEW_CODE_EXT)})) AS code_dirs
FROM pf GROUP BY repo_id""")
def q_structure_stats(spark, sf):
    s = rp.structure_stats(_files(spark, sf))
    return s.withColumn("top_level_dirs", F.array_join("top_level_dirs", "|"))


def root(d):
    return f"(path = '{d}' OR starts_with(path, '{d}/'))"


MULTI = "(" + " OR ".join(root(d) for d in rp.MULTI_MODULE_DIRS) + ")"
TF = "regexp_matches(path, '(^|/)[^/]*\\.tf(/|$)')"


@register("structure_flags", with_views(["v_repo_files"], [PF]) + f"""
SELECT *, compose OR k8s OR terraform OR multi_module AS has_structure FROM (
SELECT repo_id, coalesce(bool_or({root('docker-compose.yml')} OR {root('docker-compose.yaml')}), false) AS compose,
  coalesce(bool_or({root('k8s')} OR {root('helm')}), false) AS k8s,
  coalesce(bool_or({root('terraform')} OR {TF}), false) AS terraform,
  coalesce(bool_or({MULTI}), false) AS multi_module
FROM pf GROUP BY repo_id)""")
def q_structure_flags(spark, sf):
    return rp.structure_flags(_files(spark, sf))


VALID_AGG = f"""count(*) FILTER (WHERE NOT starts_with(name, '.')) AS _visible,
  count(*) FILTER (WHERE NOT starts_with(name, '.') AND suffix = '.py') AS _pyv,
  count(*) FILTER (WHERE NOT starts_with(name, '.') AND suffix IN ({q(rp.VALIDATOR_CODE_EXT)})) AS _codev,
  coalesce(bool_or(NOT starts_with(name, '.') AND ((contains(lpath, '/') AND contains(lpath, 'src/'))
                    OR lname IN ({q(rp.STRUCTURE_NAMES)}))), false) AS _struct"""
INFO_CTE = ("info", "SELECT s_suppkey AS repo_id, lower(s_name) AS _iname, '' AS _idesc, true AS _has_info FROM supplier")
INAME = "coalesce(i._iname, '')"
VALID_REASON = f"""CASE WHEN {like_any(INAME, rp.VALIDATOR_NAME_KEYWORDS)} THEN 'name keyword'
  WHEN _visible = 0 THEN 'no files' WHEN _pyv < 5 THEN 'too few python files'
  WHEN _codev / _visible < 0.25 THEN 'low code ratio' WHEN NOT _struct THEN 'no project structure' END"""


def _info(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("repo_id"), F.col("s_name").alias("name"))


@register("valid_projects", with_views(["v_repo_files"], [PF, INFO_CTE]) + f"""
SELECT repo_id, reason IS NULL AS is_valid, coalesce(reason, 'valid') AS reason FROM (
  SELECT g.repo_id, {VALID_REASON} AS reason
  FROM (SELECT repo_id, {VALID_AGG} FROM pf GROUP BY repo_id) g LEFT JOIN info i ON i.repo_id = g.repo_id)""")
def q_valid_projects(spark, sf):
    return rp.valid_projects(_files(spark, sf), _info(spark, sf))


WELL_CODE = f"suffix IN ({q(rp.WELL_CODE_EXT)})"
STRUCT_ANY = (f"({root('docker-compose.yml')} OR {root('docker-compose.yaml')} OR {root('k8s')} OR {root('helm')} "
              f"OR {root('terraform')} OR {TF} OR {MULTI})")


@register("well_structured", with_views(["v_repo_files"], [PF, INFO_CTE, (
    "first10", f"""SELECT repo_id, bool_or(contains(lname, 'main')) AS _main_in_first FROM (
        SELECT repo_id, lname FROM pf WHERE {WELL_CODE} QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY file_no) <= 10)
        GROUP BY repo_id""")]) + f"""
SELECT repo_id, reason IS NULL AS ok, coalesce(reason, 'ok') AS reason FROM (
 SELECT g.repo_id, CASE
   WHEN coalesce(i._has_info AND ({like_any('i._iname', list(dict.fromkeys(rp.FINDER_KEYWORDS)))}), false) THEN 'metadata keyword'
   WHEN ({VALID_REASON}) IS NOT NULL THEN 'invalid project: ' || ({VALID_REASON})
   WHEN NOT _structure THEN 'no structure indicators' WHEN _code < 5 THEN 'too few code files'
   WHEN _code_dirs < 2 THEN 'code in one directory' WHEN _tops < 2 THEN 'too few top-level directories'
   WHEN NOT (_root_main OR coalesce(f._main_in_first, false)) THEN 'no main file' END AS reason
 FROM (SELECT repo_id, {VALID_AGG}, coalesce(bool_or({STRUCT_ANY}), false) AS _structure,
         count(*) FILTER (WHERE {WELL_CODE}) AS _code, count(DISTINCT parent) FILTER (WHERE {WELL_CODE}) AS _code_dirs,
         count(DISTINCT top) FILTER (WHERE {TOP_OK}) AS _tops,
         coalesce(bool_or(path IN ({q(rp.MAIN_FILES)})), false) AS _root_main
       FROM pf GROUP BY repo_id) g
 LEFT JOIN info i ON i.repo_id = g.repo_id LEFT JOIN first10 f ON f.repo_id = g.repo_id)""")
def q_well_structured(spark, sf):
    return rp.well_structured(_files(spark, sf), _info(spark, sf))


@register("exclude_repos", with_views(["v_search_items"]) + f"""
SELECT url, owner, name FROM v_search_items WHERE NOT (
  {like_any("lower(coalesce(name, ''))", list(dict.fromkeys(rp.FINDER_KEYWORDS)))}
  OR {like_any("lower(coalesce(description, ''))", list(dict.fromkeys(rp.FINDER_KEYWORDS)))}
  OR contains(lower(coalesce(owner, '')), 'awesome') OR contains(lower(coalesce(name, '')), 'awesome'))""")
def q_exclude_repos(spark, sf):
    return rp.exclude_repos(fixture(spark, sf, "v_search_items")).select("url", "owner", "name")
