import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import quality as qu
from quarry.operators import review as rv
from quarry.operators import sft


def test_review_state_sequences(spark):
    t = dt.datetime(2024, 1, 1)
    seqs = {"a": ["keep"], "b": ["keep", "discard"], "c": ["keep", "undo"], "d": ["discard", "undo"],
            "e": ["keep", "undo", "keep"], "f": ["undo"], "g": ["discard", "keep", "maybe"]}
    rows = [(u, d, t + dt.timedelta(seconds=i), i) for u, ds in seqs.items() for i, d in enumerate(ds)]
    log = spark.createDataFrame(rows, "repo_url string, decision string, ts timestamp, event_id long")
    got = dict(map(tuple, rv.review_state(log).collect()))
    assert got == {"a": "kept", "b": "discarded", "c": "none", "d": "discarded", "e": "kept", "f": "none", "g": "kept"}


def test_validator_edges(spark):
    rows = [("x" * 19, "y" * 100, "api"), ("x" * 20, "y" * 99, "api"), ("x" * 20, "y" * 50001, None),
            ("x" * 20, "y" * 50000, "api"), (None, None, "api")]
    df = spark.createDataFrame(rows, "instruction string, output string, project_type string") \
        .withColumn("input", F.struct("project_type"))
    got = [r["errors"] for r in qu.validate_samples(df, output_from_content=False).collect()]
    assert got == [["Instruction too short: 19 < 20"], ["Output too short: 99 < 100"],
                   ["Output too long: 50001 > 50000", "'input' missing 'project_type' field"], [],
                   ["'instruction' must be a string", "'output' must be a string"]]
    missing = spark.createDataFrame([("x" * 30,)], "instruction string")
    assert qu.validate_samples(missing).first()["errors"] == ["Missing 'input' field", "Missing 'output' field"]
    summ = dict(map(tuple, qu.error_summary(qu.validate_samples(df, output_from_content=False)).collect()))
    assert summ == {"Instruction too short": 1, "Output too short": 1, "Output too long": 1, "'input'": 1,
                    "'instruction'": 1, "'output'": 1}


def test_parse_instructions(spark):
    fb = sft.FALLBACK_INSTRUCTION
    df = spark.createDataFrame([("Sure: [\"a\", \"b\"]", 3), ("none", 2), ("[\"a\",\"b\",\"c\",\"d\"]", 3), ("[1, ]x]", 1)],
                               "a string, n int")
    got = [r[0] for r in df.select(sft.parse_instructions(F.col("a"), F.col("n"))).collect()]
    assert got == [["a", "b", fb], [fb, fb], ["a", "b", "c"], [fb]]


def test_file_head(spark):
    df = spark.createDataFrame([("a\nb\nc\n",), ("a\nb",), ("a\nb\n",), ("",)], "c string")
    got = [r[0] for r in df.select(sft.file_head(F.col("c"), 2)).collect()]
    note = "\n... (truncated, showing first 2 lines)"
    assert got == ["a\nb\n" + note, "a\nb" + note, "a\nb\n" + note, ""]


def test_alpaca_text_templates(spark):
    df = spark.createDataFrame([("do it", "  ", "from content", "api")], "instruction string, output string, content string, pt string") \
        .withColumn("input", F.struct(F.array(F.lit("a.py")).alias("file_tree"), F.col("pt").alias("project_type")))
    t = sft.alpaca_text(df, eos="<E>").first()["text"]
    assert "### Input:\nFile structure:\na.py\n\nProject type: api\n\n### Response:\nfrom content<E>" in t


def test_resolve_readme_api_fallback(spark):
    import base64

    from quarry.operators import collect as co
    repos = spark.createDataFrame([("u1", "o", "a"), ("u2", "o", "b"), ("u3", "o", "c")], "repo_url string, owner string, repo string")
    fetches = spark.createDataFrame([
        ("https://raw.githubusercontent.com/o/a/master/README.md", 200, "A2"),
        ("https://raw.githubusercontent.com/o/a/main/readme.md", 200, "A3"),
        ("https://raw.githubusercontent.com/o/a/main/README.md", 404, ""),
        ("https://raw.githubusercontent.com/o/b/main/README.md", 500, "")], "url string, status int, body string")
    api = spark.createDataFrame([("u2", 200, base64.b64encode("B from api".encode()).decode()), ("u3", 404, None)],
                                "repo_url string, status int, content string")
    got = {r["repo_url"]: (r["readme"], r["rank"]) for r in co.resolve_readme(repos, fetches, api=api).collect()}
    assert got == {"u1": ("A2", 2), "u2": ("B from api", 5)}


def test_md_links_source_restriction(spark):
    from quarry.operators import links as lk
    lines = spark.createDataFrame([("a", 0, 1, "[x](https://github.com/o/r)"), ("b", 1, 1, "[y](https://github.com/o/s)")],
                                  "source string, source_rank int, line_no long, line string")
    assert [r["repo"] for r in lk.md_links(lines, sources=["b"]).collect()] == ["s"]


def test_append_and_first_available(spark, tmp_path):
    from quarry.sources import io
    path = str(tmp_path / "store")
    a = spark.createDataFrame([("u1", 1), ("u2", 2)], "repo_url string, v int")
    io.append_to(a, path)
    io.append_to(spark.createDataFrame([("u2", 9), ("u3", 3)], "repo_url string, v int"), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("u1", 1), ("u2", 2), ("u3", 3)]
    df = io.first_available(spark, [("parquet", str(tmp_path / "missing")), ("parquet", path)])
    assert df.count() == 3


def test_input_text_from_raw_json(spark):
    rows = [('{"file_tree": ["a.py", "b/c.py"], "project_type": "cli"}',), ("plain words",), ("   ",), (None,),
            ('{"project_type": "api"}',)]
    df = spark.createDataFrame(rows, "raw string")
    got = [r[0] for r in df.select(sft.input_text_any(F.col("raw"))).collect()]
    assert got == ["File structure:\na.py\nb/c.py\n\nProject type: cli", "plain words", "", "", "Project type: api"]


def test_parse_instructions_random(spark):
    import json
    import random
    import re
    rng = random.Random(3)
    fb = sft.FALLBACK_INSTRUCTION

    def brute(answer, n):
        m = re.search(r"\[[\s\S]*\]", answer)
        if not m:
            return [fb] * n
        try:
            got = json.loads(m.group(0))
        except json.JSONDecodeError:
            return [fb] * n
        got = [str(x) for x in got] if isinstance(got, list) else [str(got)]
        return (got + [fb] * n)[:n]
    answers = []
    for _ in range(200):
        items = [rng.choice(["a", "Generate x", "with, comma", 'q"t', 7, ""]) for _ in range(rng.randint(0, 5))]
        text = json.dumps(items)
        answers.append((rng.choice(["", "Sure: ", "x (", "]"]) + rng.choice([text, text[:-1], "none"]) + rng.choice(["", " ok", "]"]),
                        rng.randint(1, 4)))
    df = spark.createDataFrame(answers, "a string, n int")
    got = [r[0] for r in df.select(sft.parse_instructions(F.col("a"), F.col("n"))).collect()]
    for (a, n), g in zip(answers, got):
        assert g == brute(a, n), a


def test_long_answers_do_not_exhaust_the_stack(spark):
    import json

    from quarry.operators import sft
    long = ["x" * 1_000_000, "\\\"" * 300_000]
    rows = [(0, json.dumps(long), 2), (1, json.dumps(["a"]) + " and " + json.dumps(["b"]), 1), (2, json.dumps(["y"] * 50_000), 2), (3, "['single']", 1), (4, "[[1, 2], {\"k\": null}]", 2)]
    df = spark.createDataFrame(rows, "i int, answer string, n int")
    got = {r["i"]: r["v"] for r in df.select("i", sft.parse_instructions(F.col("answer"), F.col("n")).alias("v")).collect()}
    fb = sft.FALLBACK_INSTRUCTION
    assert got == {0: long, 1: [fb], 2: ["y", "y"], 3: [fb], 4: ["[1,2]", '{"k":null}']}
