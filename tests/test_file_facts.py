import ast
import random

from quarry.operators import code as cd

SCHEMA = "repo_id long, file_no int, path string, content string"
PARTS = ["import os, a.b\n", "from m import x, y\n", "from . import z\n", "@app.route('/')\ndef home():\n    return db.get(1)\n", "class User(Base):\n    id = Column(int)\n    name = 1\n",
         "class Plain:\n    id = Column(int)\n    a = b = 2\n", "class Bare:\n    k = 3\n", "conn = psycopg2.connect('x')\n", "r = redis.Redis()\n", "x = 1\n", "class OrderService:\n    pass\n", "def broken(:\n"]


def brute_file(content):
    """(type, imports, evidence) of a file, node by node."""
    def name(n):
        return n.id if type(n) is ast.Name else f"{name(n.value)}.{n.attr}" if type(n) is ast.Attribute else name(n.func) if type(n) is ast.Call else ast.unparse(n)

    try:
        nodes = list(ast.walk(ast.parse(content)))
    except SyntaxError:
        return None
    typ, imports, evidence = None, [], []
    for n in nodes:
        if isinstance(n, ast.Import):
            imports += [a.name for a in n.names]
        elif isinstance(n, ast.ImportFrom):
            imports += [f"{n.module or ''}.{a.name}" for a in n.names]
        if isinstance(n, ast.FunctionDef):
            for d in map(name, n.decorator_list):
                if any(w in d.lower() for w in cd.API_DECORATOR_WORDS):
                    typ = "api_server"
                    evidence.append(f"Found API decorator: {d}")
        if isinstance(n, ast.ClassDef):
            for b in map(name, n.bases):
                if any(w in b for w in cd.MODEL_BASE_WORDS):
                    typ = "model"
                    evidence.append(f"Found model class: {n.name}")
            for _ in [t for i in n.body if isinstance(i, ast.Assign) for t in i.targets]:
                if ("Column" in content or "relationship" in content) and typ != "model":
                    typ = "model"
                    evidence.append(f"Found SQLAlchemy Column in {n.name}")
        if isinstance(n, ast.Call) and any(w in name(n).lower() for w in cd.DB_CALL_WORDS):
            typ = typ or "database"
            evidence.append(f"Found database connection: {name(n)}")
        if isinstance(n, (ast.Call, ast.Attribute)) and any(w in name(n).lower() for w in cd.CACHE_WORDS):
            typ = typ or "cache"
            evidence.append(f"Found cache usage: {name(n)}")
    return typ, imports, evidence


def test_file_facts_hold_imports_and_evidence(spark):
    rng = random.Random(4)
    texts = ["".join(rng.sample(PARTS[:-1], rng.randint(1, 7))) + (PARTS[-1] if rng.random() < 0.2 else "") for _ in range(150)]
    files = spark.createDataFrame([(i % 9, i, f"a/f{i}.py", t) for i, t in enumerate(texts)], SCHEMA)
    by_pattern = {r["file_no"]: (r["type"], r["evidence"]) for r in cd.file_types_regex(files).collect()}
    want = {}
    for i, t in enumerate(texts):
        typ, imports, evidence = brute_file(t) or (None, [], [])
        typ, evidence = (typ, evidence) if typ else by_pattern.get(i, (None, None))
        if typ:
            want[i] = (typ, imports, evidence)
    got = {r["file_no"]: (r["type"], r["imports"], r["evidence"]) for r in cd.file_facts(files).collect()}
    assert got == want
    assert any("Found SQLAlchemy Column in Plain" in e for _, _, e in got.values()) and any(e == ["Found service pattern: " + cd.SERVICE_PATTERNS[0], "Found service pattern: " + cd.SERVICE_PATTERNS[2]] for _, _, e in got.values())


def test_file_facts_of_null_keys_and_of_files_that_do_not_parse(spark):
    files = spark.createDataFrame([(None, 1, "a.py", "class AService:\n    pass\n"), (1, 2, "b.py", "import os\ndef broken(:\ncelery.run()\n"), (1, 3, "c.py", None)], SCHEMA)
    got = sorted((r["path"], r["type"], r["parsed"], r["imports"], len(r["evidence"])) for r in cd.file_facts(files).collect())
    assert got == [("a.py", "service", False, [], 2), ("b.py", "queue", False, [], 1)]


def test_query_gives_the_whole_file_result(spark, tmp_path, monkeypatch):
    from quarry.plans import code_plans

    files = spark.createDataFrame([(1, 1, "api.py", PARTS[1] + PARTS[3]), (1, 2, "m.py", PARTS[4]), (1, 3, "plain.py", "x = 1\n")], SCHEMA)
    monkeypatch.setattr(code_plans, "_files", lambda spark, sf: files)
    rows = {r["path"]: r.asDict() for r in code_plans.q_file_facts(spark, "").collect()}
    assert set(rows) == {"api.py", "m.py"}
    assert rows["api.py"]["imports"] == ["m.x", "m.y"] and rows["api.py"]["evidence"][0] == "Found API decorator: app.route"
    assert rows["m.py"]["evidence"] == ["Found model class: User"] and {r["components"] for r in rows.values()} == {"API Server, Database"}
