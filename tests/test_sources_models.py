import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from quarry.operators import docs as dc
from quarry.operators import evaluate as ev
from quarry.operators import sft
from quarry.plans import source_plans
from quarry.sources import io
from quarry.sources.fixtures import fixture


def test_read_collection_shapes(spark, tmp_path):
    s1 = {"repo_url": "u1", "readme": "r1", "input": {"project_type": "cli"}}
    s2 = {"repo_url": "u2", "readme": "r2", "input": "plain"}
    (tmp_path / "env.json").write_text(json.dumps({"metadata": {}, "training_data": [s1, s2], "failed": []}))
    (tmp_path / "arr.json").write_text(json.dumps([{"repo_url": "u3"}, {"repo_url": "u4", "chunk": "c"}]))
    (tmp_path / "one.json").write_text(json.dumps({"repo_url": "u5", "content": "x"}))
    (tmp_path / "feat.json").write_text(json.dumps({"features": [{"repo_url": "u6", "chunk": "c6"}], "num_chunks": 1}))
    (tmp_path / "bad.json").write_text("{broken")
    df = io.read_collection(spark, str(tmp_path))
    got = {r["repo_url"]: r for r in df.collect()}
    assert sorted(got) == ["u1", "u2", "u3", "u4", "u5", "u6"]
    assert json.loads(got["u1"]["input"]) == {"project_type": "cli"} and got["u2"]["input"] == "plain"
    assert got["u6"]["chunk"] == "c6" and got["u5"]["content"] == "x"


def test_batch_docs_with_injected_model(spark):
    prompts = spark.createDataFrame([(1, "p1"), (2, ""), (3, "p3")], "repo_id long, prompt string")
    res = dc.batch_docs(prompts, lambda ps: [f"doc for {p}" if p else "" for p in ps])
    got = {r["repo_id"]: (r["doc"], r["error"]) for r in res.collect()}
    assert got == {1: ("doc for p1", None), 2: (None, "empty answer"), 3: ("doc for p3", None)}

    def broken(ps):
        raise RuntimeError("down")
    errs = {r["error"] for r in dc.batch_docs(prompts, broken).collect()}
    assert errs == {"model error: down"}
    assert dc.batch_counts(res).first().asDict() == {"succeeded": 2, "failed": 1}


def test_sft_samples_with_injected_completion(spark):
    chunks = spark.createDataFrame([("u", i, f"chunk {i}", ["a.py"], "cli") for i in range(5)],
                                   "repo_url string, chunk_no int, chunk string, file_tree array<string>, project_type string")

    def model(prompts):
        return ['["first", "second", "third"]' if "[Item 3]" in p else '["only"]' for p in prompts]
    out = sft.build_sft_samples(chunks, complete=model).orderBy("chunk_no").collect()
    fb = sft.FALLBACK_INSTRUCTION
    assert [r["instruction"] for r in out] == ["first", "second", "third", "only", fb]
    assert out[0]["input"]["project_type"] == "cli" and out[0]["content"] == "chunk 0"

    def failing(prompts):
        raise RuntimeError("no model")
    assert {r["instruction"] for r in sft.build_sft_samples(chunks, complete=failing).collect()} == {fb}


def test_eval_with_injected_scorer(spark):
    tasks = spark.createDataFrame([(1, "q", "o", "c"), (2, "q2", "o2", None)], "task_id long, query string, output string, context string")
    scores, avg = ev.eval_batch(tasks, scorer=lambda q, o, c: {"relevance_score": [1.0 if x == "q" else 0.5 for x in q]})
    assert sorted(map(tuple, scores.collect())) == [(1, 1.0, 0.0), (2, 0.5, 0.0)]
    assert avg.first()["avg_relevance_score"] == 0.75 and avg.first()["avg_hallucination_score"] == 0.0
    lex = ev.eval_batch(tasks)[0].orderBy("task_id").first()
    assert lex["relevance_score"] == 0.0 and lex["hallucination_score"] == 1.0


def test_write_with_counts_and_publish(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * i) for i in range(7)], "id long, s string")
    counts = io.write_with_counts(df, str(tmp_path / "out"), metrics={"chars": F.sum(F.length("s"))})
    assert counts == {"rows": 7, "chars": 21}
    assert spark.read.json(str(tmp_path / "out")).count() == 7
    io.publish(df, path=str(tmp_path / "msgs"), key="id")
    back = spark.read.text(str(tmp_path / "msgs")).select(F.from_json("value", "id long, s string").alias("m"))
    assert sorted(r["m"]["id"] for r in back.collect()) == list(range(7))


def test_read_collection_keeps_records_with_one_bad_field(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"repo_url": "u1", "stars": "many"}, {"repo_url": "u2", "stars": 3}]))
    (tmp_path / "b.json").write_text("not json at all")
    got = {r["repo_url"]: r["stars"] for r in io.read_collection(spark, str(tmp_path)).collect()}
    assert got == {"u1": None, "u2": 3}


def test_model_failure_stays_with_its_prompt(spark):
    asked = []

    def model(ps):
        asked.extend(ps)
        if "bad" in ps[0]:
            raise RuntimeError("down")
        return ["doc for " + p for p in ps]
    prompts = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}") for i in range(10)], "repo_id long, prompt string")
    got = {r["repo_id"]: (r["doc"], r["error"]) for r in dc.batch_docs(prompts, model).collect()}
    assert got[3] == (None, "model error: down") and all(got[i] == (f"doc for p{i}", None) for i in range(10) if i != 3)
    keyed = prompts.select(F.lit("u").alias("repo_url"), F.col("repo_id").alias("batch_no"), "prompt")
    answers = {r["batch_no"]: r["answer"] for r in sft.complete_prompts(keyed, model).collect()}
    assert answers[3] is None and answers[4] == "doc for p4"


def test_files_that_are_not_text_keep_their_row(spark, tmp_path):
    (tmp_path / "r.1" / "src").mkdir(parents=True)
    (tmp_path / "r.1" / "logo.png").write_bytes(b"\x89PNG\xff\xfe")
    (tmp_path / "r.1" / "src" / "a.py").write_text("x = 1\n")
    got = {r["path"]: (r["repo_id"], r["content"]) for r in io.scan_repo_files(spark, str(tmp_path)).collect()}
    assert got == {"logo.png": ("r.1", None), "src/a.py": ("r.1", "x = 1\n")}


def test_append_keeps_one_row_a_key_and_counts(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "repo_url string, n int")
    path = str(tmp_path / "sink")
    assert io.append_to(rows, path, order=["n"]) == 2
    assert io.append_to(rows.union(spark.createDataFrame([("c", 9)], "repo_url string, n int")), path) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 3), ("c", 9)]


@pytest.mark.parametrize("name", ["scan_collection", "scan_samples"])
def test_scanned_files_stay_small(spark, monkeypatch, name):
    """A source of many samples is written as many files, and every sample is read back."""
    monkeypatch.setattr(source_plans, "FILE_BYTES", 20_000, raising=False)
    written, keep = [], source_plans.scratch
    monkeypatch.setattr(source_plans, "scratch", lambda *a: written.append(keep(*a)) or written[-1])
    got = getattr(source_plans, f"q_{name}")(spark, SF01)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(written[0])
    sizes = [r.length for r in files.select("length").collect()]
    assert max(sizes) < 100_000 and sum(sizes) > 500_000
    want = fixture(spark, SF01, "v_readme_samples")
    assert sorted(map(tuple, got.select("repo_url", "readme").collect()), key=str) == sorted(map(tuple, want.select("repo_url", "readme").collect()), key=str)


def test_search_items_ranks_by_ranges(spark):
    w = Window.partitionBy("query_no").orderBy(F.col("stars").desc(), "url")
    want = fixture(spark, SF01, "v_search_items").select("query_no", (F.row_number().over(w) - 1).alias("_r"), "url")
    df = source_plans.q_search_items(spark, SF01)
    got = df.select("query_no", F.col("page") * 100 + F.col("item_no"), "url")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "row_number()" in x and "windowspecdefinition(query_no" in x]
