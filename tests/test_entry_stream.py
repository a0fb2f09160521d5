import uuid

from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.operators import links as lk
from quarry.operators import repos as rp
from quarry.session import ensure_checkpoint_dir
from quarry.streaming.requests import JSON_OPTIONS, start_requests


def test_entry_contract(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"project_type", "chunks", "repos", "chunk_chars"}
    assert df.count() >= 1
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


def test_request_stream_replay_is_idempotent(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/test-stream-{uuid.uuid4().hex[:8]}"
    src, sink = f"{base}/in", f"{base}/out"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.select(F.to_json(F.struct(F.col("event_id").alias("request_id"), F.col("user_id").alias("repo_id"),
                                 F.col("event_type").alias("kind"), "ts"), JSON_OPTIONS).alias("value")).write.text(src)
    files = spark.createDataFrame([(1, 1, "main.py", "")], "repo_id long, file_no int, path string, content string")
    summ = rp.repo_summary(files)
    start_requests(spark, src, summ, sink=sink, checkpoint=f"{base}/ck1").awaitTermination()
    # a second flow over the same messages (a replay with lost offsets) must not duplicate answers
    start_requests(spark, src, summ, sink=sink, checkpoint=f"{base}/ck2").awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == ev.count() == out.select("request_id").distinct().count()
    assert out.filter("status = 'ready'").select("repo_id").distinct().collect()[0][0] == 1


def test_md_links_from_whole_documents(spark):
    md = ("# List\n- [A](https://github.com/Org/Tool) - a tool\r\n* [B]( https://github.com/org/tool/tree/main) - dup\n"
          "[gh](https://github.com/github.com/x) [C](https://github.com/c/d#x)-- trailing [E](https://github.com/e/f)")
    docs = spark.createDataFrame([("l1", 0, md)], "source string, source_rank int, content string")
    links = lk.md_links(lk.split_lines(docs))
    got = [(r["owner"], r["repo"], r["description"], r["line_no"], r["match_no"]) for r in
           links.orderBy("line_no", "match_no").collect()]
    assert got == [("Org", "Tool", "a tool", 2, 0), ("org", "tool", "dup", 3, 0), ("c", "d", "trailing", 4, 1),
                   ("e", "f", "", 5, 0)]
    assert [r["key"] for r in lk.dedup_links(links).orderBy("key").collect()] == ["c/d", "e/f", "org/tool"]


def test_request_stream_with_readme_prompts(spark):
    from quarry.operators import docs as dc
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/test-stream-p19-{uuid.uuid4().hex[:8]}"
    msgs = spark.createDataFrame([(1, 7, "click"), (2, 8, "view")], "request_id long, repo_id long, kind string") \
        .withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz"))
    msgs.select(F.to_json(F.struct("request_id", "repo_id", "kind", "ts"), JSON_OPTIONS).alias("value")).write.text(f"{base}/in")
    files = spark.createDataFrame([(7, 1, "main.py", "print(1)\n"), (7, 2, "src/app.py", "x = 1\n")],
                                  "repo_id long, file_no int, path string, content string")
    summ = rp.repo_summary(files)
    prompts = dc.doc_prompts(files, summ)
    start_requests(spark, f"{base}/in", summ, sink=f"{base}/out", checkpoint=f"{base}/ck", prompts=prompts).awaitTermination()
    got = {r["request_id"]: (r["status"], r["prompt"]) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got[2] == ("unknown repository", None)
    assert got[1][0] == "ready" and "Project name: repo-7" in got[1][1] and "main.py" in got[1][1]


def test_entry_module_imports_without_spark():
    import subprocess
    import sys
    repo = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "print(len(E.queries()), len(E.oracle_sql()))" % repo)
    out = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    nq, no = map(int, out.stdout.split())
    assert nq >= 100 and no <= nq


def test_stream_sets_bad_messages_aside_and_repeats_once(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/test-stream-bad-{uuid.uuid4().hex[:8]}"
    good = '{"request_id": 1, "repo_id": 1, "kind": "view", "ts": "2024-01-01T00:00:00.000000"}'
    spark.createDataFrame([(good,), (good,), ("not json",), ("{}",)], "value string").coalesce(1).write.text(f"{base}/in")
    summ = rp.repo_summary(spark.createDataFrame([(1, 1, "main.py", "")], "repo_id long, file_no int, path string, content string"))
    start_requests(spark, f"{base}/in", summ, sink=f"{base}/out", checkpoint=f"{base}/ck", max_files_per_trigger=1, dead_letters=f"{base}/bad").awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 1
    assert sorted(r["value"] for r in spark.read.parquet(f"{base}/bad").collect()) == ["not json", "{}"]


def test_a_flow_is_never_named_like_a_number(spark, tmp_path, monkeypatch):
    from quarry.streaming import requests

    monkeypatch.setattr(requests.uuid, "uuid4", lambda: type("U", (), {"hex": "12345678e901" + "0" * 20}))
    flow = requests._flow_id(spark, str(tmp_path / "checkpoint"))
    spark.range(1).write.parquet(str(tmp_path / f"sink/flow={flow}"))
    assert spark.read.parquet(str(tmp_path / "sink")).first()["flow"] == flow
