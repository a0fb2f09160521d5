"""Pages through the index of ranges (S5, S6), committed snapshots (S13, K5, F13) and exactly-once requests."""

import uuid

import pytest
from pyspark.sql import functions as F

from quarry.operators import repos as rp
from quarry.operators.pages import page_index
from quarry.session import ensure_checkpoint_dir
from quarry.sources.deltas import CountedTable
from quarry.sources.snapshots import Snapshots, drop_invalid_cached, load_prior
from quarry.streaming.requests import answers, start_requests


def folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{name}-{uuid.uuid4().hex[:8]}"


def test_pages_equal_slices_of_the_sorted_table(spark):
    rows = [(None if i % 50 == 0 else i * 37 % 101, f"n{i % 400}") for i in range(1203)]
    df = spark.createDataFrame(rows, "stars int, name string").repartition(5)
    index = page_index(df, [("stars", True), ("name", False)], ranges=7)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert index.rows == len(rows) and len(index.ranges) > 3
    for number in (0, 3, 17, 24, 25):
        assert [tuple(r) for r in index.page(number, 50).collect()] == want[number * 50 : number * 50 + 50]
    assert [tuple(r) for p in index.pages(300) for r in p.collect()] == want
    seen = []
    assert index.each(500, lambda n, p: seen.append((n, p.count()))) == 3 and seen == [(0, 500), (1, 500), (2, 203)]
    numbered = index.numbered(100).collect()
    assert sorted((r.page, r.place) for r in numbered) == [(i // 100, i % 100) for i in range(len(rows))]


def test_a_page_reads_its_ranges_only(spark):
    index = page_index(spark.range(20_000).repartition(6), [("id", False)], ranges=16)
    last = index.page(1999, 10)
    assert [r.id for r in last.collect()] == list(range(19_990, 20_000))
    assert len({f.split("_range=")[1].split("/")[0] for f in last.inputFiles()}) == 1
    assert page_index(spark.range(0), [("id", False)]).page(0, 10).count() == 0


def test_snapshots_commit_as_a_whole(spark, monkeypatch):
    runs = Snapshots(spark, folder(spark, "runs"))
    assert runs.versions() == [] and load_prior(runs) == (None, None) and runs.manifest() is None
    ok, failed = spark.range(3).select(F.col("id").cast("string").alias("repo_url")), spark.range(5, 7).select(F.col("id").cast("string").alias("repo_url"))
    assert runs.commit({"succeeded": ok, "failed": failed}) == 1
    # a writer that dies before its manifest is in place, after all its data was written
    monkeypatch.setattr(runs, "_create", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        runs.commit({"succeeded": failed, "failed": ok})
    monkeypatch.undo()
    succeeded, prior_failed = load_prior(runs)
    assert runs.versions() == [1] and sorted(r[0] for r in succeeded.collect()) == ["0", "1", "2"] and prior_failed.count() == 2
    # a second writer of the same number takes the next one
    monkeypatch.setattr(runs, "versions", lambda: [])
    assert runs.commit({"succeeded": ok.limit(1)}) == 2
    monkeypatch.undo()
    assert runs.versions() == [1, 2] and runs.manifest()["tables"]["succeeded"]["rows"] == 1


def test_cleaning_makes_a_new_snapshot_and_keeps_the_old(spark):
    runs = Snapshots(spark, folder(spark, "clean"))
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "repo_url string, stars int")
    runs.commit({"succeeded": rows, "failed": rows.limit(0)})
    valid = spark.createDataFrame([("a",), ("c",), ("a",), ("z",)], "repo_url string")
    assert drop_invalid_cached(runs, valid) == 2
    assert sorted(r.repo_url for r in runs.read("succeeded").collect()) == ["a", "c"] and runs.read("failed").columns == rows.columns
    assert runs.read("succeeded", 1).count() == 3 and runs.read("succeeded", "before-2").count() == 3
    assert runs.manifest()["parent"] == 1 and runs.read("nothing") is None and runs.read("succeeded", "no tag") is None
    with pytest.raises(FileExistsError):
        runs.backup("before-2")


def message(i, ts="2024-01-01T00:00:00.000000"):
    return f'{{"request_id": {i}, "repo_id": 1, "kind": "view", "ts": "{ts}"}}'


def test_each_request_is_answered_once_over_batches_restarts_and_replays(spark):
    base = folder(spark, "once")
    summaries = rp.repo_summary(spark.createDataFrame([(1, 1, "main.py", "")], "repo_id long, file_no int, path string, content string"))

    def land(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in")

    def flow(checkpoint):
        q = start_requests(spark, f"{base}/in", summaries, sink=f"{base}/out", checkpoint=f"{base}/{checkpoint}", max_files_per_trigger=1)
        q.awaitTermination()
        return q

    land(message(1), message(2), message(1), "no json")
    land(message(2), message(3))
    first = flow("ck")
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 2
    # after a restart: a replay, a late message, a new one, the same bad message again
    land(message(1), message(4, "1999-01-01T00:00:00.000000"), message(5), "no json")
    flow("ck")
    got = answers(spark, f"{base}/out")
    assert sorted(r.request_id for r in got.collect()) == [1, 2, 3, 4, 5]
    assert [r.value for r in spark.read.parquet(f"{base}/out-rejected").collect()] == ["no json"] * 2
    # offsets are lost: another flow over the same messages answers what is new only
    land(message(6))
    flow("other")
    assert sorted(r.request_id for r in answers(spark, f"{base}/out").collect()) == [1, 2, 3, 4, 5, 6]


def test_a_batch_that_runs_again_leaves_one_copy(spark, monkeypatch):
    """The folder of a micro-batch is written anew when the batch is repeated after a failure."""
    base = folder(spark, "again")
    summaries = rp.repo_summary(spark.createDataFrame([(1, 1, "main.py", "")], "repo_id long, file_no int, path string, content string"))
    spark.createDataFrame([(message(1),), (message(2),)], "value string").coalesce(1).write.text(f"{base}/in")
    from quarry.streaming import requests as rq

    original, calls = rq.enrich_requests, []

    def fails_once(*a):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return original(*a)

    monkeypatch.setattr(rq, "enrich_requests", fails_once)
    with pytest.raises(Exception):
        start_requests(spark, f"{base}/in", summaries, sink=f"{base}/out", checkpoint=f"{base}/ck").awaitTermination()
    start_requests(spark, f"{base}/in", summaries, sink=f"{base}/out", checkpoint=f"{base}/ck").awaitTermination()
    assert sorted(r.request_id for r in answers(spark, f"{base}/out").collect()) == [1, 2]


def test_reports_from_deltas_equal_a_recount(spark):
    import random

    r = random.Random(3)
    schema = spark.createDataFrame([], "id long, kind string, lang string").schema
    table = CountedTable(spark, folder(spark, "counted"), schema, ["kind", "lang"])
    rows, report, at = [], table.report(), None
    assert report.count() == 0 and table.read().count() == 0
    for step in range(7):
        if step % 3 != 2:
            new = [(len(rows) + k + 1000 * step, r.choice(["a", "b", None]), r.choice(["x", None])) for k in range(r.randint(0, 30))]
            rows += new
            table.append(spark.createDataFrame(new, schema))
        else:
            gone = {i for i, *_ in r.sample(rows, len(rows) // 4)}
            before = table.parts()
            rows = [x for x in rows if x[0] not in gone]
            table.remove(spark.createDataFrame([(i,) for i in [*gone, -1]], "id long"), "id")
            assert len(table.parts()) == len(before)
        report = spark.createDataFrame(table.updated(report, at).collect(), report.schema)
        at = table.versions()[-1]
        want = {}
        for _, kind, lang in rows:
            want[kind, lang] = want.get((kind, lang), 0) + 1
        assert {(x.kind, x.lang): x.n for x in report.collect()} == want == {(x.kind, x.lang): x.n for x in table.report().collect()}
    parts = table.parts()
    table.remove(spark.createDataFrame([(-5,)], "id long"), "id")
    assert table.parts() == parts and table.change(at).count() == 0          # nothing held such a row
