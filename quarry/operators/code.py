"""Code-file analysis: path/import/content classifiers (P10-P14), syntax-tree facts
(C1, the one Python step: stdlib ``ast`` inside ``mapInArrow``), file typing (C2, C3),
import edges (J6), components / connections (A6, A7), layers (A8), review
pre-filter (F11).

Only parsing runs in Python; typing, joins and aggregation are Catalyst plans.
"""

from __future__ import annotations

import ast

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import ustrip

from quarry.functions.text import contains_any, first_match

from quarry._workers import ship_by_value

ship_by_value(__name__)

# ------------------------------------------------------------------ P10-P14 (fixed values)
PATH_ROLE_RULES = [
    ("API Server", ["route", "api", "endpoint"]),
    ("Business Logic", ["service", "business", "logic"]),
    ("Database", ["model", "db", "database"]),
    ("Cache", ["cache", "redis"]),
    ("Worker", ["queue", "worker"]),
]
IMPORT_ROLE_RULES = [
    ("API Server", ["flask", "fastapi"]),
    ("Database", ["sqlalchemy", "psycopg2", "mysql"]),
    ("Cache", ["redis"]),
    ("Queue", ["rabbitmq", "celery", "pika"]),
]
CODE_FLAGS = {
    "web_api": ["from flask", "import flask", "flask(", "from fastapi", "import fastapi", "fastapi("],
    "database": ["sqlalchemy", "psycopg2", "mysql", "mongodb", "pymongo", "database", "db"],
    "cache": ["redis", "cache", "memcached"],
    "queue": ["rabbitmq", "celery", "queue", "pika"],
    "storage": ["s3", "boto3", "storage", "minio"],
    "web_framework": ["django", "tornado", "bottle", "cherrypy"],
    "business_logic": ["service", "business", "logic", "handler", "processor"],
}
DB_TYPE_RULES = [
    ("MongoDB", ["mongodb", "pymongo"]),
    ("PostgreSQL", ["postgresql", "psycopg2"]),
    ("MySQL", ["mysql"]),
    ("SQLite", ["sqlite"]),
]


def path_role(path) -> Column:
    """P10: role from the lower-cased path (null when no rule matches)."""
    return first_match(F.lower(F.col(path) if isinstance(path, str) else path), PATH_ROLE_RULES)


def import_role(line) -> Column:
    """Role of an import line."""
    return first_match(F.lower(F.col(line) if isinstance(line, str) else line), IMPORT_ROLE_RULES)


def code_flags(content) -> list[Column]:
    """Seven keyword flags over the lower-cased code text."""
    low = F.lower(F.col(content) if isinstance(content, str) else content)
    return [contains_any(low, words).alias(f"has_{k}") for k, words in CODE_FLAGS.items()]


def db_type(content) -> Column:
    """Database product named in the code, else 'Database'."""
    return first_match(F.lower(F.col(content) if isinstance(content, str) else content), DB_TYPE_RULES, "Database")


def import_lines(content) -> Column:
    """Stripped lines starting with ``import `` or ``from ``."""
    c = F.col(content) if isinstance(content, str) else content
    lines = F.transform(F.split(c, "\n", -1), lambda l: ustrip(l))
    return F.filter(lines, lambda l: l.startswith("import ") | l.startswith("from "))


# ------------------------------------------------------------------ C3 regex typing (fixed values)
API_PATTERNS = [r"@app\.route\s*\(", r"@router\.(get|post|put|delete)\s*\(", r"@.*\.route\s*\(",
                r"Blueprint\s*\(", r"APIRouter\s*\("]
MODEL_PATTERNS = [r"class\s+\w+.*\(.*Base.*\)", r"class\s+\w+.*\(.*db\.Model.*\)", r"Column\s*\("]
DB_PATTERNS = [r"create_engine\s*\(", r"connect\s*\(", r"sessionmaker\s*\(", r"engine\.connect\s*\("]
SERVICE_PATTERNS = [r"class\s+\w+Service", r"def\s+\w+_service\s*\(", r"class\s+\w+.*Service.*:"]
CACHE_PATTERN = r"redis\.|cache\.|Cache\("
QUEUE_PATTERN = r"celery\.|rabbitmq|pika\.|Queue\("


def _rx(c: Column, pattern: str, ignore_case: bool) -> Column:
    return c.rlike(("(?iU)" if ignore_case else "(?U)") + pattern)


# What a text must contain (lower-cased) for a pattern to be tried; without s and k, which fold from other letters, too.
GUARDS = {API_PATTERNS[0]: ["app.route"], API_PATTERNS[1]: ["router."], API_PATTERNS[2]: [".route"], API_PATTERNS[3]: ["blueprint"], API_PATTERNS[4]: ["apirouter"],
          DB_PATTERNS[0]: ["create_engine"], DB_PATTERNS[1]: ["connect"], DB_PATTERNS[2]: ["ionma"], DB_PATTERNS[3]: ["engine.connect"],
          SERVICE_PATTERNS[0]: ["ervice"], SERVICE_PATTERNS[1]: ["ervice"], SERVICE_PATTERNS[2]: ["ervice"],
          CACHE_PATTERN: ["redi", "cache"], QUEUE_PATTERN: ["celery", "rabbitmq", "pi", "queue"]}


def _as_read(content) -> Column:
    """Text-mode reading: universal newlines."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(c.contains("\r"), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def _hits(c: Column, low: Column) -> Column:
    """Which patterns a text holds, as a struct: api0.., model, db0.., sv0.., cache, queue; ``low`` is the text in lower case."""
    def hit(p):
        return contains_any(low, GUARDS[p]) & _rx(c, p, True)

    model = c.contains("class") & (_rx(c, MODEL_PATTERNS[0], False) | _rx(c, MODEL_PATTERNS[1], False)) | c.contains("Column") & _rx(c, MODEL_PATTERNS[2], False)
    named = [(f"api{i}", hit(p)) for i, p in enumerate(API_PATTERNS)] + [("model", model)] + [(f"db{i}", hit(p)) for i, p in enumerate(DB_PATTERNS)] \
        + [(f"sv{i}", hit(p)) for i, p in enumerate(SERVICE_PATTERNS)] + [("cache", hit(CACHE_PATTERN)), ("queue", hit(QUEUE_PATTERN))]
    return F.struct(*[F.coalesce(h, F.lit(False)).alias(n) for n, h in named])


def _regex_type(hits: Column) -> Column:
    """struct(type, evidence) from the hits.

    api (first pattern) -> model overrides -> database / service / cache / queue
    only while unset; evidence lists every pattern family that matched.
    """
    api, db, sv = ([hits[f"{k}{i}"] for i in range(len(ps))] for k, ps in (("api", API_PATTERNS), ("db", DB_PATTERNS), ("sv", SERVICE_PATTERNS)))

    def any_of(hs):
        out = hs[0]
        for h in hs[1:]:
            out = out | h
        return out

    api_ev = F.when(api[0], F.lit(f"Found API route pattern: {API_PATTERNS[0]}"))
    for p, h in zip(API_PATTERNS[1:], api[1:]):
        api_ev = api_ev.when(h, F.lit(f"Found API route pattern: {p}"))
    typ = (F.when(hits["model"], "model").when(any_of(api), "api_server").when(any_of(db), "database")
           .when(any_of(sv), "service").when(hits["cache"], "cache").when(hits["queue"], "queue"))
    ev = [api_ev, F.when(hits["model"], F.lit("Found SQLAlchemy model pattern"))]
    ev += [F.when(h, F.lit(f"Found database pattern: {p}")) for p, h in zip(DB_PATTERNS, db)]
    ev += [F.when(h, F.lit(f"Found service pattern: {p}")) for p, h in zip(SERVICE_PATTERNS, sv)]
    ev += [F.when(hits["cache"], F.lit("Found cache usage")), F.when(hits["queue"], F.lit("Found queue usage"))]
    return F.struct(typ.alias("type"), F.array_compact(F.array(*ev)).alias("evidence"))


def regex_type(content) -> Column:
    """C3 of one text column."""
    return _regex_type(_hits(_as_read(content), F.lower(_as_read(content))))


def _py_files(files: DataFrame) -> DataFrame:
    return files.filter(F.col("path").endswith(".py") & (F.length(F.element_at(F.split("path", "/", -1), -1)) > 3))


def regex_typed(files: DataFrame, *more: Column) -> DataFrame:
    """``(repo_id, file_no, path, _rx, *more)`` of ``.py`` files; ``_rx`` is C3's struct, its type null where nothing matched.

    The hits come out of a generator, which the optimizer does not look through, so each pattern runs once a file. A generator
    evaluates what its patterns share once for each of them, so the text and its lower case are columns below it.
    """
    read = _py_files(files).select("repo_id", "file_no", "path", *more, _as_read("content").alias("_text")).withColumn("_low", F.lower("_text"))
    hit = read.withColumn("_h", F.explode(F.array(_hits(F.col("_text"), F.col("_low")))))
    return hit.withColumn("_rx", _regex_type(F.col("_h"))).drop("_h", "_text", "_low")


def file_types_regex(files: DataFrame) -> DataFrame:
    """C3 over ``.py`` files: ``(repo_id, file_no, path, type, evidence)`` for typed files."""
    return regex_typed(files).select("repo_id", "file_no", "path", "_rx.type", "_rx.evidence").filter(F.col("type").isNotNull())


def typed_with_imports(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C3 with the imports of the typed files' import lines: ``(typed, imports)`` for ``import_edges``.

    One scan of the files; what it yields, without contents, is written once and read by everything that follows.
    """
    from quarry.session import materialize

    seen = regex_typed(files, import_lines("content").alias("lines")).filter(F.col("_rx.type").isNotNull())
    seen = materialize(seen.select("repo_id", "file_no", "path", "_rx.type", "_rx.evidence", F.lit(True).alias("parsed"), "lines"), "typed-lines")
    return seen.drop("lines"), _named_imports(seen.select("repo_id", "file_no", F.posexplode("lines").alias("imp_no", "line")))


# ------------------------------------------------------------------ C1 syntax-tree facts
FACT_SCHEMA = "repo_id long, file_no int, path string, seq int, kind string, value string, owner string"


# How a node is named; other nodes are written back as source.
NODE_NAMES = {
    ast.Name: lambda n: n.id,
    ast.Attribute: lambda n: node_name(n.value) + "." + n.attr,
    ast.Call: lambda n: node_name(n.func),
}


def node_name(node: ast.AST) -> str:
    return NODE_NAMES.get(type(node), ast.unparse)(node)


def _class_facts(node: ast.ClassDef):
    yield from (("base", node_name(b), node.name) for b in node.bases)
    yield from (("class_assign", node_name(t), node.name) for item in node.body if type(item) is ast.Assign for t in item.targets)


# What each kind of node tells: (kind, value, owner).
NODE_FACTS = {
    ast.Import: lambda n: (("import", a.name, None) for a in n.names),
    ast.ImportFrom: lambda n: (("import", (n.module or "") + "." + a.name, None) for a in n.names),
    ast.FunctionDef: lambda n: (("decorator", node_name(d), n.name) for d in n.decorator_list),
    ast.ClassDef: _class_facts,
    ast.Call: lambda n: (("call", node_name(n), None), ("call_or_attr", node_name(n), None)),
    ast.Attribute: lambda n: (("call_or_attr", node_name(n), None),),
}


def _facts_of(content: str):
    """Facts of one file in breadth-first order; ``None`` if it doesn't parse."""
    try:
        tree = ast.parse(content)
    except (SyntaxError, ValueError, RecursionError, MemoryError):      # MemoryError: nesting too deep for the parser
        return None
    facts = []
    for node in ast.walk(tree):
        tell = NODE_FACTS.get(type(node))
        if tell:
            facts.extend(tell(node))
    return facts


FACT_ROWS = 20_000                                     # a batch that a task hands on holds about so many facts


def _facts_batches(batches):
    """Arrow batches of facts; the columns behind ``content`` go with each file's first row."""
    for batch in batches:
        files, given, more = [c.to_pylist() for c in batch.columns], list(batch.schema)[:3], list(batch.schema)[4:]
        text = given[2].type
        schema = pa.schema([*given, ("seq", pa.int32()), ("kind", text), ("value", text), ("owner", text), *more])
        blank, rows = (None,) * len(more), []
        for rid, fno, path, content, *rest in zip(*files):
            facts = _facts_of(content or "")
            rows.append((rid, fno, path, 0, "syntax_error" if facts is None else "parsed", None, None, *rest))
            rows += [(rid, fno, path, i + 1, k, v, o, *blank) for i, (k, v, o) in enumerate(facts or [])]
            if len(rows) >= FACT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def code_facts(files: DataFrame) -> DataFrame:
    """One row per syntax-tree fact of every ``.py`` file (``seq`` = walk order);
    a ``parsed`` or ``syntax_error`` marker row has ``seq = 0``."""
    return _py_files(files).select(F.col("repo_id").cast("long"), F.col("file_no").cast("int"), "path", "content") \
        .mapInArrow(_facts_batches, FACT_SCHEMA)


def typing_facts(files: DataFrame, *, evidence: bool = False) -> DataFrame:
    """C1 in the same scan as C3: the rows of ``code_facts``; a file's marker row tells, too, what the patterns say (``_rx``, with
    ``evidence`` also theirs, ``_rx_evidence``) and whether the file mentions a Column or relationship (``_orm``)."""
    why = [F.col("_rx.evidence").alias("_rx_evidence")] if evidence else []
    orm = (F.col("content").contains("Column") | F.col("content").contains("relationship")).alias("_orm")
    seen = regex_typed(files, F.col("content"), orm)
    return seen.select(F.col("repo_id").cast("long"), F.col("file_no").cast("int"), "path", "content", F.col("_rx.type").alias("_rx"), "_orm", *why) \
        .mapInArrow(_facts_batches, FACT_SCHEMA + ", _rx string, _orm boolean" + (", _rx_evidence array<string>" if why else ""))


# AST keyword tests.
API_DECORATOR_WORDS = ["route", "get", "post", "put", "delete", "patch", "blueprint", "router", "endpoint"]
MODEL_BASE_WORDS = ["Base", "db.Model", "DeclarativeBase"]
DB_CALL_WORDS = ["create_engine", "connect", "session", "engine"]
CACHE_WORDS = ["redis", "cache", "get", "set"]
REFERENCE_RULES = {"api_decorator": API_DECORATOR_WORDS, "model_base": MODEL_BASE_WORDS,
                   "db_call": DB_CALL_WORDS, "cache": CACHE_WORDS}
# Stricter preset (not the reference's): plain ``get``/``set`` and bare ``session`` no longer type a file.
STRICT_RULES = {"api_decorator": ["route", "blueprint", "router", "endpoint", "app.get", "app.post", "app.put",
                                  "app.delete", "app.patch", "router.get", "router.post"],
                "model_base": MODEL_BASE_WORDS, "db_call": ["create_engine", "sessionmaker", "engine.connect"],
                "cache": ["redis", "cache"]}


def _typing(rules: dict | None) -> tuple[Column, Column, Column]:
    """What a fact says of its file's type, as numbers: 0 api_server or 1 model (overriding), whether it is a class-level assign,
    and 0 database or 1 cache; null where it says nothing."""
    r = rules or REFERENCE_RULES
    v, low, k = F.col("value"), F.lower(F.col("value")), F.col("kind")
    over = F.when((k == "decorator") & contains_any(low, r["api_decorator"]), 0).when((k == "base") & contains_any(v, r["model_base"]), 1)
    soft = F.when((k == "call") & contains_any(low, r["db_call"]), 0).when((k == "call_or_attr") & contains_any(low, r["cache"]), 1)
    return over, k == "class_assign", soft


def told_facts(files: DataFrame, *, rules: dict | None = None, evidence: bool = False) -> DataFrame:
    """The facts that type a file or name an import, with the files' marker rows; written once, as they are read more than once.
    With ``evidence``, all that ``file_facts`` needs."""
    from quarry.session import materialize

    over, assign, soft = _typing(rules)
    told = (F.col("seq") == 0) | (F.col("kind") == "import") | assign | over.isNotNull() | soft.isNotNull()
    facts = typing_facts(files, evidence=evidence).filter(F.coalesce(told, F.lit(False)))
    return materialize(facts if evidence else facts.drop("owner"), "code-facts")


def file_types(files: DataFrame, facts: DataFrame | None = None, *, rules: dict | None = None) -> DataFrame:
    """C2 + C4: ``(repo_id, file_no, path, type, parsed)`` for every typed ``.py`` file.

    The walk is replayed as an ordered reduction: the last overriding fact
    (API decorator, model base, class-level assign when the file mentions
    Column/relationship) wins; else the first database call; else the first
    cache-like call/attribute; else the regex typing (C3). Files whose parse
    failed use the regex typing and carry no imports. ``rules`` replaces the
    keyword lists (default: the reference's; ``STRICT_RULES`` over-matches less).
    ``facts``: those of ``told_facts``, where they are at hand.

    A file's facts are reduced to three numbers (place and type in one) where they are read; only those are shuffled.
    """
    facts = facts if facts is not None else told_facts(files, rules=rules)
    return _typed(facts, rules).select("repo_id", "file_no", "path", "type", "parsed")


def _typed(facts: DataFrame, rules: dict | None, *more: str) -> DataFrame:
    """The rows of ``file_types``, whether facts gave the type (``_by_facts``), and ``more`` of the marker rows' columns."""
    over, assign, soft = _typing(rules)
    key, at, marker = ["repo_id", "file_no"], F.col("seq").cast("long") * 2, F.col("seq") == 0
    # ``call`` precedes ``call_or_attr`` of the same node: order by (seq) is already walk order.
    said = facts.groupBy(*key).agg(
        F.max(at + over).alias("_over"), F.max(F.when(assign, at + 1)).alias("_assign"), F.min(at + soft).alias("_soft"), F.max("_orm").alias("_orm"),
        F.count_if(marker & (F.col("kind") == "parsed")).alias("_parsed"), F.count_if(marker & (F.col("kind") != "parsed")).alias("_failed"))
    rx = facts.filter(marker).select(*key, "path", "_rx", *more)
    out = rx.join(said.hint("merge"), key, "left")
    # files of one number: each is paired with each one's marker
    marks = F.concat(F.array_repeat(F.lit(True), F.col("_parsed").cast("int")), F.array_repeat(F.lit(False), F.col("_failed").cast("int")))
    out = out.withColumn("parsed", F.explode(F.coalesce(marks, F.array(F.lit(False)))))
    last = F.greatest("_over", F.when(F.col("_orm"), F.col("_assign")))
    ast_type = F.when(last.isNotNull(), F.when(last % 2 == 0, "api_server").otherwise("model")) \
        .when(F.col("_soft").isNotNull(), F.when(F.col("_soft") % 2 == 0, "database").otherwise("cache"))
    by_facts = F.when(F.col("parsed"), ast_type)
    return out.select(*key, "path", F.coalesce(by_facts, F.col("_rx")).alias("type"), "parsed", by_facts.isNotNull().alias("_by_facts"), *more) \
        .filter(F.col("type").isNotNull())


def file_facts(files: DataFrame, facts: DataFrame | None = None, *, rules: dict | None = None) -> DataFrame:
    """C4: the rows of ``file_types`` with the file's ``imports`` (none where parsing failed) and the ``evidence`` of its type, both as
    arrays in walk order; where the type comes from the patterns (C3), so does the evidence.

    ``facts``: those of ``told_facts`` with ``evidence``, where they are at hand. Files of one number are read as one, as in ``file_types``.
    """
    facts = facts if facts is not None else told_facts(files, rules=rules, evidence=True)
    over, assign, soft = _typing(rules)
    key, walk, value, owner = ["repo_id", "file_no"], ["seq", "kind", "value", "owner"], F.col("value"), F.col("owner")
    of_file = Window.partitionBy(*key)
    told = facts.filter("repo_id IS NOT NULL AND file_no IS NOT NULL").select(*key, *walk, F.max("_orm").over(of_file).alias("_orm"))
    column = assign & F.col("_orm")
    # a class-level assign counts only where the facts before it have not made the file a model
    told = told.withColumn("_sets", F.coalesce(over, F.when(column, 1))) \
        .withColumn("_before", F.last("_sets", ignorenulls=True).over(of_file.orderBy(*walk).rowsBetween(Window.unboundedPreceding, -1)))
    said = (F.when(over == 0, F.concat(F.lit("Found API decorator: "), value)).when(over == 1, F.concat(F.lit("Found model class: "), owner))
            .when(column & (F.coalesce("_before", F.lit(0)) != 1), F.concat(F.lit("Found SQLAlchemy Column in "), owner))
            .when(soft == 0, F.concat(F.lit("Found database connection: "), value)).when(soft == 1, F.concat(F.lit("Found cache usage: "), value)))

    def in_order(text):
        rows = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(*walk, text.alias("text")))))
        return F.transform(rows, lambda r: r["text"])

    lists = told.groupBy(*key).agg(in_order(F.when(F.col("kind") == "import", value)).alias("imports"), in_order(said).alias("_evidence"))
    none = F.array().cast("array<string>")
    return _typed(facts, rules, "_rx_evidence").join(lists.hint("merge"), key, "left").select(
        *key, "path", "type", "parsed", F.coalesce(F.when(F.col("parsed"), F.col("imports")), none).alias("imports"),
        F.when(F.col("_by_facts"), F.col("_evidence")).otherwise(F.col("_rx_evidence")).alias("evidence"))


# ------------------------------------------------------------------ J6 / A6 / A7 / A8
# Import-target keyword rules (first match wins).
IMPORT_TARGET_RULES = [
    ("api_server", ["flask", "fastapi", "django", "tornado"]),
    ("database", ["sqlalchemy", "psycopg2", "mysql", "pymongo"]),
    ("cache", ["redis", "cache"]),
    ("queue", ["celery", "rabbitmq", "pika"]),
]


def _grams(c: Column, k: int) -> Column:
    """Distinct substrings of length ``k`` (the whole string when shorter)."""
    n = F.length(c)
    return F.when(n <= k, F.array(c)).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(c, i, k))))


#: A repository with at most so many distinct unresolved imports tries each of them on each of its typed files, so there are at most so
#: many trials a file; with more, imports and files meet on grams.
DIRECT = 200


def _first_hit(hits: DataFrame) -> DataFrame:
    """The first file (a parsed one before one that is not) of each import, from ``(repo_id, import, _tfile, _any, _ttype)``."""
    return hits.filter(F.col("_tfile").isNotNull()).groupBy("repo_id", "import").agg(F.min(F.struct("_tfile", "_any", "_ttype")).alias("_first"))


def _gram_hits(typed: DataFrame, unresolved: DataFrame) -> DataFrame:
    """The files that an import meets, without pairing every import with every file of a repo.

    * import in path: each import joins only the files that share its rarest trigram
      (every true match contains it), then the substring test is applied;
    * dotted path in import: the import's substrings (bounded by the import's length)
      are equi-joined with dotted paths;
    * files typed without parsing have no path and match every import: a per-repo minimum.
    """
    key = ["repo_id", "import"]
    parsed = typed.filter(~F.col("_any"))
    grams = parsed.select("*", F.explode(F.array_distinct(F.concat(
        _grams(F.col("_tpath"), 1), _grams(F.col("_tpath"), 2), _grams(F.col("_tpath"), 3)))).alias("gram"))
    freq = grams.groupBy("repo_id", "gram").agg(F.count(F.lit(1)).alias("_f"))
    imp = unresolved.withColumn("_k", F.least(F.length("import"), F.lit(3)))
    ig = imp.filter(F.col("_k") > 0).select(*key, F.explode(
        F.when(F.col("_k") < 3, F.array(F.col("import"))).otherwise(_grams(F.col("import"), 3))).alias("gram"))
    best = ig.join(freq.hint("merge"), ["repo_id", "gram"]).groupBy(*key).agg(F.min_by("gram", "_f").alias("gram"))
    hit = [*key, "_tfile", "_any", "_ttype"]
    in_path = best.join(grams.hint("merge"), ["repo_id", "gram"]).filter(F.col("_tpath").contains(F.col("import"))).select(*hit)
    empty_import = imp.filter(F.col("_k") == 0).join(parsed.hint("merge"), "repo_id").select(*hit)
    # only substrings as long as some dotted path of the repository can be one
    dotted = parsed.withColumn("_sub", F.translate("_tpath", "/\\", ".."))
    lengths = dotted.groupBy("repo_id").agg(F.collect_set(F.length("_sub")).alias("_lengths"))     # at most the longest path's length
    n = F.length("import")
    subs = unresolved.join(lengths.hint("merge"), "repo_id").select(*key, F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter("_lengths", lambda k: k <= n),
        lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col("import"), i, k)))))).alias("_sub"))
    in_import = subs.join(dotted.hint("merge"), ["repo_id", "_sub"]).select(*hit)
    universal = typed.filter(F.col("_any")).groupBy("repo_id").agg(F.min(F.struct("_tfile", "_ttype")).alias("_u"))
    unnamed = unresolved.join(universal.hint("merge"), "repo_id").select(*key, "_u._tfile", F.lit(True).alias("_any"), "_u._ttype")
    return in_path.unionByName(empty_import).unionByName(in_import).unionByName(unnamed)


def _theta_targets(typed: DataFrame, unresolved: DataFrame) -> DataFrame:
    """``(repo_id, import, _theta)``: the type of the first typed file (by ``file_no``) whose path contains the import, or whose
    dotted path occurs in the import; files typed without parsing have no path and match every import. Imports without such a file are left out.

    Joins are told to merge: what stages hold is larger than their files, by which Spark would choose to broadcast it.
    """
    t = typed.select("repo_id", F.col("file_no").alias("_tfile"), (~F.col("parsed")).alias("_any"), F.col("type").alias("_ttype"), F.col("path").alias("_tpath")) \
        .filter("repo_id IS NOT NULL AND _tfile IS NOT NULL")
    sized = unresolved.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("repo_id")))
    few, many = sized.filter(F.col("_n") <= DIRECT).drop("_n"), sized.filter(F.col("_n") > DIRECT).drop("_n")
    path, name = F.col("_tpath"), F.col("import")
    hits = t.join(few.hint("merge"), "repo_id").filter(F.col("_any") | path.contains(name) | name.contains(F.translate(path, "/\\", ".."))) \
        .select("repo_id", "import", "_tfile", "_any", "_ttype")
    theirs = t.join(many.select("repo_id").distinct().hint("merge"), "repo_id", "left_semi")
    hits = hits.unionByName(_gram_hits(theirs, many))
    return _first_hit(hits).select("repo_id", "import", F.col("_first._ttype").alias("_theta"))


def import_edges(typed: DataFrame, imports: DataFrame) -> DataFrame:
    """J6 + A7: connections ``(repo_id, file_no, imp_no, from, to, confidence)``.

    ``typed(repo_id, file_no, path, type, parsed)``; ``imports(repo_id, file_no,
    imp_no, import)`` of typed files. Keyword rules first; otherwise the first
    typed file (by ``file_no``) of the same repo whose path contains the import,
    or whose dotted path occurs in it (a file typed without parsing has no path
    and matches any import). Duplicates and self edges are kept.
    """
    kw = first_match(F.lower(F.col("import")), IMPORT_TARGET_RULES)
    imp = imports.withColumn("_kw", kw).join(typed.select("repo_id", "file_no", F.col("type").alias("from")).hint("merge"), ["repo_id", "file_no"])
    unresolved = imp.filter(F.col("_kw").isNull() & F.col("import").isNotNull())
    theta = _theta_targets(typed, unresolved.select("repo_id", "import").distinct())
    found = unresolved.join(theta.hint("merge"), ["repo_id", "import"])
    columns = ["repo_id", "file_no", "imp_no", "from"]
    return imp.filter(F.col("_kw").isNotNull()).select(*columns, F.col("_kw").alias("to")).unionByName(found.select(*columns, F.col("_theta").alias("to"))) \
        .filter(F.col("to").isNotNull()).withColumn("confidence", F.lit(0.9))


def _named_imports(lines: DataFrame) -> DataFrame:
    both = r"^from\s+(\S+)\s+import\s+(\S+)"
    name = F.when(F.col("line").startswith("from "),
                  F.concat(F.regexp_extract("line", both, 1), F.lit("."), F.regexp_extract("line", both, 2))) \
        .otherwise(F.regexp_extract("line", r"^import\s+(\S+)", 1))
    return lines.select("repo_id", "file_no", "imp_no", name.alias("import"))


def line_imports(files: DataFrame, typed: DataFrame) -> DataFrame:
    """``(repo_id, file_no, imp_no, import)`` of typed files from their import lines: ``import a`` -> a,
    ``from m import x`` -> m.x."""
    return _named_imports(files.join(typed.select("repo_id", "file_no"), ["repo_id", "file_no"], "left_semi")
                          .select("repo_id", "file_no", F.posexplode(import_lines("content")).alias("imp_no", "line")))


def components(typed: DataFrame) -> DataFrame:
    """0..6 component rows per repo from counts of file types."""
    g = typed.groupBy("repo_id").agg(*[F.count_if(F.col("type") == t).alias(f"n_{t}") for t in
                                       ["api_server", "database", "service", "model", "cache", "queue"]])
    S = "struct<component_no:int,name:string,type:string,layer:string,confidence:double,evidence:string,present:boolean>"

    def comp(i, name, typ, layer, conf, evidence, present):
        return F.struct(F.lit(i).alias("component_no"), F.lit(name).alias("name"), F.lit(typ).alias("type"),
                        F.lit(layer).alias("layer"), F.lit(conf).alias("confidence"),
                        evidence.cast("string").alias("evidence"), present.alias("present"))

    n = F.col
    arr = F.array(
        comp(0, "API Server", "server", "frontend", 1.0,
             F.format_string("Found %d API files with route decorators", n("n_api_server")), n("n_api_server") > 0),
        comp(1, "Database", "database", "data", 1.0,
             F.format_string("Found %d DB files, %d model files", n("n_database"), n("n_model")),
             (n("n_database") > 0) | (n("n_model") > 0)),
        comp(2, "Business Logic", "application", "middle", 1.0,
             F.format_string("Found %d service files", n("n_service")), n("n_service") > 0),
        comp(3, "Cache", "cache", "data", 1.0, F.format_string("Found %d cache files", n("n_cache")), n("n_cache") > 0),
        comp(4, "Message Queue", "queue", "middle", 1.0, F.format_string("Found %d queue files", n("n_queue")),
             n("n_queue") > 0),
        comp(5, "Worker", "worker", "middle", 0.8, F.lit(None), n("n_queue") > 0),
    ).cast(f"array<{S}>")
    return g.select("repo_id", F.inline(F.filter(arr, lambda c: c["present"]))).drop("present")


def layers(comps: DataFrame) -> DataFrame:
    """Front (API/Web Server), application (application type or Business Logic),
    data (database/cache/storage) flags and their count, plus the component count."""
    g = comps.groupBy("repo_id").agg(
        F.coalesce(F.bool_or(F.col("name").isin("API Server", "Web Server")), F.lit(False)).alias("frontend_layer"),
        F.coalesce(F.bool_or((F.col("type") == "application") | (F.col("name") == "Business Logic")), F.lit(False)).alias("application_layer"),
        F.coalesce(F.bool_or(F.col("type").isin("database", "cache", "storage")), F.lit(False)).alias("data_layer"),
        F.count(F.lit(1)).alias("component_count"))
    return g.withColumn("layer_count", F.col("frontend_layer").cast("int") + F.col("application_layer").cast("int")
                        + F.col("data_layer").cast("int"))


def architecture(files: DataFrame, *, mode: str = "ast", rules: dict | None = None, results: bool = False):
    """(typed files, components, connections) of every repository.

    ``mode='regex'`` types files by content patterns (C3) and takes imports from import lines
    — the mode a SQL engine can reproduce; ``mode='ast'`` runs C1/C2, with ``results`` C4: typed files come with imports and evidence.
    """
    if mode == "regex":
        typed, imports = typed_with_imports(files)
        return typed, components(typed), import_edges(typed, imports)
    # stage boundary (the reference's list of file analyses): facts and typed files are
    # written once to the shared checkpoint folder, so the Python parse and the typing run
    # once however often the import-edge join reads them
    from quarry.session import materialize
    facts = told_facts(files, rules=rules, evidence=results)
    typed = materialize((file_facts if results else file_types)(files, facts, rules=rules), "typed-files")
    imps = facts.filter(F.col("kind") == "import").select("repo_id", "file_no", F.col("seq").alias("imp_no"),
                                                          F.col("value").alias("import"))
    return typed, components(typed), import_edges(typed, imps)


# ------------------------------------------------------------------ F11
# Names of entry points, and suffixes of the files that count as code.
ENTRY_POINTS = ["main.py", "app.py", "server.py", "manage.py", "wsgi.py", "asgi.py", "application.py"]
PREFILTER_CODE_EXT = [".py", ".js", ".java", ".go", ".ts", ".tsx", ".jsx"]


def review_prefilter(files: DataFrame, comps: DataFrame, conns: DataFrame) -> DataFrame:
    """``(repo_id, ok, reason)`` — the documented intent of the review pre-filter."""
    from quarry.operators import repos as rp

    f = rp.with_path_parts(files)
    code = F.col("suffix").isin(PREFILTER_CODE_EXT)
    # an entry point among the key files = a file named like a key-file candidate that is an entry point
    entry_names = sorted({c.lower() for c in rp.KEY_FILE_CANDIDATES} & set(ENTRY_POINTS))
    g = f.groupBy("repo_id").agg(
        *rp.validity_aggs(), *rp.project_type_aggs(),
        F.coalesce(F.bool_or(F.col("lname").isin(entry_names)), F.lit(False)).alias("_entry"),
        F.count_if(code).alias("_code"),
        F.count_distinct(F.when(code, F.col("parent"))).alias("_code_dirs"))
    lay = layers(comps)
    nconn = conns.groupBy("repo_id").agg(F.count(F.lit(1)).alias("_conns"))
    g = g.join(lay.hint("merge"), "repo_id", "left").join(nconn.hint("merge"), "repo_id", "left")    # a row per repository: too many to broadcast
    ptype = rp.project_type_expr()
    has_entry = F.col("_entry")
    ncomp = F.coalesce(F.col("component_count"), F.lit(0))
    nlay = F.coalesce(F.col("layer_count"), F.lit(0))
    nconns = F.coalesce(F.col("_conns"), F.lit(0))
    reason = (F.when(rp.validity_reason().isNotNull(), "not a valid coding project")
              .when(ptype == "library", "library project")
              .when(~ptype.isin("application", "cli") & ~has_entry, "no application entry point")
              .when(nlay < 2, F.format_string("only %d layer(s)", nlay))
              .when(ncomp < 3, F.format_string("too few components: %d", ncomp))
              .when((nconns == 0) & (ncomp < 4), "no component connections")
              .when(F.col("_code") < 10, F.format_string("too few code files: %d", F.col("_code")))
              .when(F.col("_code") > 500, F.format_string("repository too large: %d", F.col("_code")))
              .when(F.col("_code_dirs") < 3, F.format_string("files in too few directories: %d", F.col("_code_dirs"))))
    return g.select("repo_id", reason.isNull().alias("ok"),
                    F.coalesce(reason, F.format_string("OK - %d layers, %d components", nlay, ncomp)).alias("reason"))
