"""Repository-level analysis over ``repo_files(repo_id, file_no, path, content)``.

Every operator here is one ``groupBy(repo_id)`` whose aggregates are
``bool_or`` / ``count_if`` / ``max_by`` — all with partial (map-side)
aggregation, so a repository holding a third of all files is still reduced
per task before the shuffle. No file list is collected into one row except
where the output itself is a list (top-level directories, key files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (project detection).
APP_SIGNALS = ["main.py", "app.py", "manage.py", "wsgi.py", "asgi.py", "application.py", "server.py"]
WEB_FRAMEWORKS = ["flask", "django", "fastapi", "tornado", "bottle"]
CLI_SIGNALS = ["cli.py", "cli", "command.py", "commands.py", "__main__.py"]
CLI_PATHS = ["cli/", "commands/", "cmd/"]
LIBRARY_INDICATORS = ["pyproject.toml", "setup.py", "setup.cfg", "poetry.lock"]
PYTHON_INDICATORS = ["pyproject.toml", "setup.py", "setup.cfg", "requirements.txt", "Pipfile", "poetry.lock"]
NODE_INDICATORS = ["package.json", "package-lock.json", "yarn.lock", "pnpm-lock.yaml"]
GO_INDICATORS = ["go.mod", "go.sum", "Gopkg.toml", "Gopkg.lock"]
RUST_INDICATORS = ["Cargo.toml", "Cargo.lock"]
KEY_FILE_CANDIDATES = ["README.md", "readme.md", "README.rst", "pyproject.toml", "setup.py", "setup.cfg",
                       "requirements.txt", "Pipfile", "Pipfile.lock", "environment.yml", "main.py", "app.py",
                       "manage.py"]
# Fixed values (project validation).
VALIDATOR_KEYWORDS = ["awesome", "list", "books", "resources", "curated", "collection", "learning", "tutorial",
                      "course", "education"]
VALIDATOR_NAME_KEYWORDS = ["awesome", "list", "books", "resources", "curated"]
VALIDATOR_CODE_EXT = [".py", ".js", ".java", ".go", ".rs", ".cpp", ".c", ".ts", ".tsx"]
STRUCTURE_NAMES = ["__init__.py", "setup.py", "pyproject.toml", "requirements.txt"]
# Fixed values (structure indicators and well-structured test).
MULTI_MODULE_DIRS = ["services", "apps", "packages", "cmd", "modules", "microservices"]
WELL_CODE_EXT = [".py", ".js", ".java", ".go", ".ts", ".tsx"]
MAIN_FILES = ["main.py", "app.py", "server.py", "index.js", "main.go", "Application.java"]
IGNORED_TOP_DIRS = ["node_modules", "__pycache__", ".git", "venv", "env"]
# Fixed values (review structure flags).
REVIEW_CODE_EXT = [".py", ".js", ".java", ".go", ".ts", ".tsx", ".jsx"]
FRONTEND_DIRS = ["frontend", "client", "web", "ui"]
BACKEND_DIRS = ["backend", "server", "api", "services"]
SERVER_DIRS = ["server", "api"]
#: Line ends as patterns see them: a dot does not match them, and the end may stand before one.
LINE_ENDS = ["\n", "\r", "\u0085", "\u2028", "\u2029"]
DATABASE_DIRS = ["db", "database", "models", "migrations"]


def _lits(xs):
    return [F.lit(x) for x in xs]


def with_path_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``name`` (basename), ``lname``, ``lpath``, ``suffix`` (pathlib rule),
    ``parent`` ('' at root) and ``top`` (first directory, null at root)."""
    p = F.col(path)
    name = F.substring_index(p, "/", -1)
    # from the last dot, where something stands before and behind it; the pattern says the same, but only names that hold a line end need it
    last = F.substring_index(name, ".", -1)
    plain = F.when((last != "") & (F.length(last) + 1 < F.length(name)), F.concat(F.lit("."), last)).otherwise(F.when(name.isNotNull(), ""))
    suffix = F.when(_contains_any(name, LINE_ENDS), F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)).otherwise(plain)
    return files.withColumn("name", name) \
        .withColumn("lname", F.lower(name)) \
        .withColumn("lpath", F.lower(p)) \
        .withColumn("suffix", suffix) \
        .withColumn("parent", F.regexp_extract(p, r"^(.*)/[^/]*$", 1)) \
        .withColumn("top", F.when(p.contains("/"), F.split(p, "/", 2)[0]))


def _any(cond: Column) -> Column:
    return F.coalesce(F.bool_or(cond), F.lit(False))


def _contains_any(c: Column, words) -> Column:
    out = None
    for w in words:
        t = c.contains(w)
        out = t if out is None else out | t
    return out


def project_type_aggs() -> list[Column]:
    """A1 aggregate columns (combined with others in one ``groupBy``)."""
    n, p = F.col("lname"), F.col("lpath")
    return [
        _any(n.isin(APP_SIGNALS)).alias("_app"),
        _any(_contains_any(p, WEB_FRAMEWORKS)).alias("_web"),
        _any(n.isin("docker-compose.yml", "dockerfile")).alias("_docker"),
        _any(n.isin(CLI_SIGNALS)).alias("_cli"),
        _any(_contains_any(p, CLI_PATHS)).alias("_clipath"),
        _any(n.isin(LIBRARY_INDICATORS)).alias("_lib"),
        _any(p.contains("src/") | p.contains("/__init__.py")).alias("_srcpkg"),
        F.count_if(F.col("suffix") == ".py").alias("_py"),
    ]


def project_type_expr() -> Column:
    return (F.when(F.col("_app") | F.col("_web") | F.col("_docker"), "application")
            .when(F.col("_cli") | F.col("_clipath"), "cli")
            .when(F.col("_lib"), "library")
            .when(F.col("_srcpkg") & (F.col("_py") > 3), "library")
            .when(F.col("_py") > 5, "library")
            .otherwise("unknown"))


def project_language_aggs(legacy: bool = False) -> list[Column]:
    """A2 aggregates. The reference lower-cases file names but not some indicators,
    so ``Pipfile``, ``Gopkg.*`` and ``Cargo.*`` never match (``legacy=True``)."""
    def ind(xs):
        return [x for x in xs if x == x.lower()] if legacy else [x.lower() for x in xs]
    n = F.col("lname")
    return [
        _any(n.isin(ind(PYTHON_INDICATORS))).alias("_pyind"),
        _any(F.col("suffix") == ".py").alias("_pyfile"),
        _any(n.isin(ind(NODE_INDICATORS))).alias("_node"),
        _any(n.isin(ind(GO_INDICATORS))).alias("_go"),
        _any(n.isin(ind(RUST_INDICATORS)) if ind(RUST_INDICATORS) else F.lit(False)).alias("_rust"),
    ]


def project_language_expr() -> Column:
    return (F.when(F.col("_pyind") | F.col("_pyfile"), "python")
            .when(F.col("_node"), "nodejs").when(F.col("_go"), "go").when(F.col("_rust"), "rust")
            .otherwise("unknown"))


def project_type(files: DataFrame) -> DataFrame:
    """A1: ``(repo_id, project_type)`` by the ordered file-name rules."""
    g = with_path_parts(files).groupBy("repo_id").agg(*project_type_aggs())
    return g.select("repo_id", project_type_expr().alias("project_type"))


def project_language(files: DataFrame, *, legacy: bool = False) -> DataFrame:
    """A2: ``(repo_id, project_language)``."""
    g = with_path_parts(files).groupBy("repo_id").agg(*project_language_aggs(legacy))
    return g.select("repo_id", project_language_expr().alias("project_language"))


def key_file_aggs() -> list[Column]:
    """A3: per candidate the path of the *last* file (by ``file_no``) with that lower
    basename, plus ``package_init`` = first nested ``__init__.py``."""
    out = []
    for i, c in enumerate(KEY_FILE_CANDIDATES):
        hit = F.col("lname") == c.lower()
        out.append(F.max_by(F.when(hit, F.col("path")), F.when(hit, F.col("file_no"))).alias(f"_kf{i}"))
    nested_init = F.col("path").contains("/") & (F.col("name") == "__init__.py")
    out.append(F.min_by(F.when(nested_init, F.col("path")), F.when(nested_init, F.col("file_no"))).alias("_kfinit"))
    return out


def key_files_expr() -> Column:
    """``array<struct<key,path>>`` in candidate order (present ones only)."""
    entries = [F.struct(F.lit(c).alias("key"), F.col(f"_kf{i}").alias("path")) for i, c in enumerate(KEY_FILE_CANDIDATES)]
    entries.append(F.struct(F.lit("package_init").alias("key"), F.col("_kfinit").alias("path")))
    return F.filter(F.array(*entries), lambda e: e["path"].isNotNull())


def _key_file_table(files: DataFrame) -> DataFrame:
    """A3 aggregation over the few files that can be key files (candidate names or a nested
    ``__init__.py``): filtering first keeps the string-valued ``max_by`` off the full file list."""
    f = with_path_parts(files)
    cand = F.col("lname").isin([c.lower() for c in KEY_FILE_CANDIDATES]) | \
        (F.col("path").contains("/") & (F.col("name") == "__init__.py"))
    return f.filter(cand).groupBy("repo_id").agg(*key_file_aggs())


def key_files(files: DataFrame) -> DataFrame:
    """A3 as rows ``(repo_id, key, path)``."""
    return _key_file_table(files).select("repo_id", F.inline(key_files_expr()))


def repo_summary(files: DataFrame, *, legacy_language: bool = False) -> DataFrame:
    """A4: type, language, key files and file count per repository.

    The flags and counts are one hash aggregation (boolean/long buffers only);
    key files come from a second aggregation over candidate-named files and are
    joined on the repository id.
    """
    g = with_path_parts(files).groupBy("repo_id").agg(
        *project_type_aggs(), *project_language_aggs(legacy_language), F.count(F.lit(1)).alias("file_count"))
    g = g.join(_key_file_table(files).hint("merge"), "repo_id", "left")
    kf = key_files_expr()
    return g.select("repo_id", project_type_expr().alias("project_type"),
                    project_language_expr().alias("project_language"),
                    F.map_from_entries(kf).alias("key_files"), "file_count")


def structure_stats(files: DataFrame) -> DataFrame:
    """A5: layer/structure flags, top-level directories and code counts per repo."""
    f = with_path_parts(files)
    top_ok = F.col("top").isNotNull() & ~F.col("top").startswith(".") & ~F.col("top").isin(IGNORED_TOP_DIRS)
    top = F.when(top_ok, F.col("top"))
    code = F.col("suffix").isin(REVIEW_CODE_EXT)
    p = F.col("path")
    g = f.groupBy("repo_id").agg(
        F.array_sort(F.collect_set(top)).alias("top_level_dirs"),
        _any(top_ok & F.col("top").isin(FRONTEND_DIRS)).alias("has_frontend"),
        _any(top_ok & F.col("top").isin(BACKEND_DIRS)).alias("has_backend"),
        _any(top_ok & F.col("top").isin(SERVER_DIRS)).alias("has_server"),
        _any(top_ok & F.lower(F.col("top")).contains("api")).alias("has_api"),
        _any(top_ok & F.col("top").isin(DATABASE_DIRS)).alias("has_database"),
        _any(p.isin("docker-compose.yml", "Dockerfile") | p.startswith("docker-compose.yml/")
             | p.startswith("Dockerfile/")).alias("has_docker"),
        _any(p.isin("k8s", "helm") | p.startswith("k8s/") | p.startswith("helm/")).alias("has_k8s"),
        F.count_if(code).alias("code_file_count"),
        F.count_distinct(F.when(code, F.col("parent"))).alias("code_dirs"),
    )
    return g


def structure_flags(files: DataFrame) -> DataFrame:
    """root-level structure indicators (compose file, k8s/helm, terraform or any
    ``*.tf``, multi-module directories)."""
    f = with_path_parts(files)
    p = F.col("path")

    def root(x):
        return (p == x) | p.startswith(x + "/")

    multi = None
    for d in MULTI_MODULE_DIRS:
        multi = root(d) if multi is None else multi | root(d)
    g = f.groupBy("repo_id").agg(
        _any(root("docker-compose.yml") | root("docker-compose.yaml")).alias("compose"),
        _any(root("k8s") | root("helm")).alias("k8s"),
        _any(root("terraform") | p.rlike(r"(^|/)[^/]*\.tf(/|$)")).alias("terraform"),
        _any(multi).alias("multi_module"))
    return g.withColumn("has_structure", F.col("compose") | F.col("k8s") | F.col("terraform") | F.col("multi_module"))


def _info_columns(info: DataFrame | None) -> DataFrame | None:
    if info is None:
        return None
    cols = set(info.columns)
    return info.select(
        "repo_id",
        F.lower(F.coalesce(F.col("name"), F.lit(""))).alias("_iname") if "name" in cols else F.lit("").alias("_iname"),
        F.lower(F.coalesce(F.col("description"), F.lit(""))).alias("_idesc") if "description" in cols else F.lit("").alias("_idesc"),
        F.coalesce(F.col("topics"), F.array().cast("array<string>")).alias("_itopics") if "topics" in cols
        else F.array().cast("array<string>").alias("_itopics"),
        (F.col("has_info") if "has_info" in cols else F.lit(True)).alias("_has_info"),
        F.lower(F.coalesce(F.col("owner"), F.lit(""))).alias("_iowner") if "owner" in cols else F.lit("").alias("_iowner"),
    )


def validity_aggs(min_py_files: int = 5, min_code_ratio: float = 0.25) -> list[Column]:
    visible = ~F.col("name").startswith(".")
    return [
        F.count_if(visible).alias("_visible"),
        F.count_if(visible & (F.col("suffix") == ".py")).alias("_pyv"),
        F.count_if(visible & F.col("suffix").isin(VALIDATOR_CODE_EXT)).alias("_codev"),
        _any(visible & ((F.col("lpath").contains("/") & F.col("lpath").contains("src/"))
                        | F.col("lname").isin(STRUCTURE_NAMES))).alias("_struct"),
    ]


def validity_reason(min_py_files: int = 5, min_code_ratio: float = 0.25, with_info: bool = False) -> Column:
    """F8 reason cascade (null = valid)."""
    kw = VALIDATOR_KEYWORDS
    desc_hit = _contains_any(F.col("_idesc"), kw) if with_info else F.lit(False)
    topic_hit = F.exists(F.col("_itopics"), lambda t: F.lower(t).isin(kw)) if with_info else F.lit(False)
    has_info = F.coalesce(F.col("_has_info"), F.lit(False)) if with_info else F.lit(False)
    name_hit = F.coalesce(_contains_any(F.col("_iname"), VALIDATOR_NAME_KEYWORDS), F.lit(False)) if with_info else F.lit(False)
    return (F.when(has_info & desc_hit, "description keyword")
            .when(has_info & topic_hit, "topic keyword")
            .when(name_hit, "name keyword")
            .when(F.col("_visible") == 0, "no files")
            .when(F.col("_pyv") < min_py_files, "too few python files")
            .when(F.col("_codev") / F.col("_visible") < min_code_ratio, "low code ratio")
            .when(~F.col("_struct"), "no project structure"))


def valid_projects(files: DataFrame, info: DataFrame | None = None, *, min_py_files: int = 5,
                   min_code_ratio: float = 0.25) -> DataFrame:
    """F8: ``(repo_id, is_valid, reason)``; ``info(repo_id, name, description, topics)``
    adds the keyword rules (joined after the per-repo aggregation: one row per repo)."""
    g = with_path_parts(files).groupBy("repo_id").agg(*validity_aggs(min_py_files, min_code_ratio))
    inf = _info_columns(info)
    if inf is not None:
        g = g.join(inf, "repo_id", "left")
    reason = validity_reason(min_py_files, min_code_ratio, with_info=inf is not None)
    return g.select("repo_id", reason.isNull().alias("is_valid"), F.coalesce(reason, F.lit("valid")).alias("reason"))


# Finder exclusion keywords (the reference lists 'awesome-list' twice).
FINDER_KEYWORDS = ["awesome", "awesome-list", "awesome-list", "list", "curated", "collection", "resources",
                   "tutorial", "tutorials", "course", "courses", "learning", "learn", "education", "educational",
                   "example", "examples", "demo", "demos", "boilerplate", "template", "templates", "starter",
                   "starters", "scaffold", "scaffolding", "sample", "samples", "playground", "practice"]


def exclude_flag(name: Column, description: Column, owner: Column, keywords=FINDER_KEYWORDS) -> Column:
    """keyword in lower name or description, or 'awesome' in owner/name."""
    n = F.lower(F.coalesce(name, F.lit("")))
    d = F.lower(F.coalesce(description, F.lit("")))
    o = F.lower(F.coalesce(owner, F.lit("")))
    kws = list(dict.fromkeys(keywords))
    return _contains_any(n, kws) | _contains_any(d, kws) | o.contains("awesome") | n.contains("awesome")


def exclude_repos(df: DataFrame, *, keywords=FINDER_KEYWORDS) -> DataFrame:
    """drop repos whose metadata marks them as lists, tutorials, templates..."""
    return df.filter(~exclude_flag(F.col("name"), F.col("description"), F.col("owner"), keywords))


def well_structured(files: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """F3 (when info) -> F8 -> F9 -> >=5 code files in >=2 dirs -> >=2 top dirs ->
    a main file at the root or 'main' in one of the first 10 code files (by ``file_no``).
    Returns ``(repo_id, ok, reason)``."""
    f = with_path_parts(files)
    code = F.col("suffix").isin(WELL_CODE_EXT)
    top_ok = F.col("top").isNotNull() & ~F.col("top").startswith(".") & ~F.col("top").isin(IGNORED_TOP_DIRS)
    p = F.col("path")
    multi = None
    for d in MULTI_MODULE_DIRS:
        t = (p == d) | p.startswith(d + "/")
        multi = t if multi is None else multi | t
    structure = ((p == "docker-compose.yml") | p.startswith("docker-compose.yml/") | (p == "docker-compose.yaml")
                 | p.startswith("docker-compose.yaml/") | (p == "k8s") | p.startswith("k8s/") | (p == "helm")
                 | p.startswith("helm/") | (p == "terraform") | p.startswith("terraform/")
                 | p.rlike(r"(^|/)[^/]*\.tf(/|$)") | multi)
    g = f.groupBy("repo_id").agg(
        *validity_aggs(),
        _any(structure).alias("_structure"),
        F.count_if(code).alias("_code"),
        F.count_distinct(F.when(code, F.col("parent"))).alias("_code_dirs"),
        F.count_distinct(F.when(top_ok, F.col("top"))).alias("_tops"),
        _any(p.isin(MAIN_FILES)).alias("_root_main"),
    )
    # 'main' in one of the first ten code files: a per-repo top-10 (WindowGroupLimit keeps
    # at most ten rows per repo and task before the shuffle), never the whole file list.
    from quarry.operators.core import quota_per_group
    first10 = quota_per_group(f.filter(code).select("repo_id", "file_no", "lname"), group="repo_id",
                              quota=10, order=["file_no"]) \
        .groupBy("repo_id").agg(_any(F.col("lname").contains("main")).alias("_main_in_first"))
    g = g.join(first10, "repo_id", "left")
    inf = _info_columns(info)
    if inf is not None:
        g = g.join(inf, "repo_id", "left")
        excluded = F.coalesce(F.col("_has_info") & exclude_flag(F.col("_iname"), F.col("_idesc"), F.col("_iowner")),
                              F.lit(False))
    else:
        excluded = F.lit(False)
    main_in_first = F.coalesce(F.col("_main_in_first"), F.lit(False))
    v = validity_reason(with_info=inf is not None)
    reason = (F.when(excluded, "metadata keyword")
              .when(v.isNotNull(), F.concat(F.lit("invalid project: "), v))
              .when(~F.col("_structure"), "no structure indicators")
              .when(F.col("_code") < 5, "too few code files")
              .when(F.col("_code_dirs") < 2, "code in one directory")
              .when(F.col("_tops") < 2, "too few top-level directories")
              .when(~(F.col("_root_main") | main_in_first), "no main file"))
    return g.select("repo_id", reason.isNull().alias("ok"), F.coalesce(reason, F.lit("ok")).alias("reason"))


def language_gate(projects: DataFrame, supported=("python",), *, language: str = "project_language") -> DataFrame:
    """F16: ``allowed`` and, where it is not, a ``message`` for each project: only some languages may go on to an action."""
    known = F.coalesce(F.col(language), F.lit("unknown"))
    return projects.withColumn("allowed", known.isin(list(supported))).withColumn(
        "message", F.when(~F.col("allowed"), F.concat(F.lit(f"only {', '.join(supported)} projects are supported, found: "), known)))
