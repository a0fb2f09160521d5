"""JSON array files read in splits, against Python's json on the whole file."""

import json
import random

import pytest

from quarry.sources import io
from quarry.sources.jsonarrays import ESCAPED, IN, OUT, Cutter, json_records, shape_of, transitions

KEYS = io.ENVELOPE_KEYS


def some_text(r):
    return "".join(r.choice(['{', '}', '[', ']', ',', ':', '"', '\\', '\\"', '\n', ' ', 'é', '😀', 'a', 'training_data', ' ']) for _ in range(r.randint(0, 12)))


def some_samples(r, n):
    return [{"repo_url": f"u{i}", "readme": some_text(r), "file_tree": [some_text(r) for _ in range(r.randint(0, 3))], "input": {"k": [some_text(r), {"x": []}]}, "stars": i} for i in range(n)]


def write(r, value):
    return json.dumps(value, indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5).encode()


def test_splits_put_one_after_the_other_end_as_the_whole():
    r = random.Random(1)
    for _ in range(200):
        data = write(r, some_samples(r, 3))[: r.choice([10**9, 10, 100, 300])]
        whole, bounds = transitions(data)[OUT], sorted({0, len(data), *(r.randint(0, len(data)) for _ in range(4))})
        state, depth = OUT, 0
        for a, b in zip(bounds[:-1], bounds[1:]):
            state, d = transitions(data[a:b])[state]
            depth += d
        assert (state, depth) == whole
    assert transitions(b'a\\"b"{')[IN] == (OUT, 1) and transitions(b'"{')[ESCAPED] == (IN, 0) and transitions(b'"{')[IN] == (OUT, 1) and transitions(b"")[ESCAPED] == (ESCAPED, 0)


@pytest.mark.parametrize("kind", ["array", "envelope", "one"])
def test_records_are_cut_alike_however_a_file_is_split(kind):
    r = random.Random(2)
    for _ in range(60):
        samples = some_samples(r, r.randint(0, 6))
        value = {"array": samples, "envelope": {"metadata": {"data": {"n": 1}, "t": some_text(r)}, "samples": samples, "after": [{"no": 1}, "x"]}, "one": samples[0] if samples else {"readme": "x"}}[kind]
        data = write(r, value)
        base, key = shape_of(data, KEYS)
        assert (base, key) == {"array": (1, None), "envelope": (2, "samples"), "one": (0, None)}[kind]
        least = data.index(b"[", data.index(b'"samples"')) + 1 if kind == "envelope" else 0      # an envelope's array begins in the first split
        bounds = sorted({0, len(data), *(r.randint(least, len(data)) for _ in range(r.randint(0, 4)))})
        state, depth, out, ended = OUT, 0, [], False
        for a, b in zip(bounds[:-1], bounds[1:]):
            cutter = Cutter(state, depth, base, key.encode() if key else None)
            got = []
            for c in range(a, b, 17):
                got += cutter.feed(data[c : min(c + 17, b)])
            if not ended:
                out += [*got, *cutter.rest()]
            ended |= cutter.closed
            state, d = transitions(data[a:b])[state]
            depth += d
        assert (state, depth) == (OUT, 0)
        records = []
        for k, text in out:
            if k in ("whole", "tail"):
                records.append(text)
            else:
                records[-1] += text
        want = {"array": samples, "envelope": samples, "one": [value]}[kind]
        assert [json.loads(x) for x in records if x.strip()] == want


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    r = random.Random(3)
    root = tmp_path_factory.mktemp("arrays")
    want, broken = [], []
    for n, value_of in enumerate([lambda s: s, lambda s: {"metadata": {"list": "x"}, "training_data": s, "samples": [{"repo_url": "second choice"}]}, lambda s: {"other": 1, "data": s}, lambda s: s[0], lambda s: []]):
        for k in range(3):
            samples = some_samples(r, 250 if n < 3 and k == 0 else 7)
            for s in samples:
                s["owner"] = f"{n}-{k}"
            value = value_of(samples)
            (root / f"f{n}-{k}.json").write_bytes(write(r, value))
            want += samples if n < 3 else [value] if n == 3 else []
    for name, raw in {"cut.json": write(r, some_samples(r, 90))[:-30], "not.json": b"{not json", "string.json": b'["open'}.items():
        (root / name).write_bytes(raw)
        broken.append(name)
    (root / "empty.json").write_bytes(b"")
    (root / "mixed.json").write_bytes(b'[1, "x", {"repo_url": "kept", "stars": "12"}, {"repo_url": bad}, null]')
    want.append({"repo_url": "kept"})
    return root, want, broken


def test_equals_json_on_whole_files(spark, folder):
    root, want, broken = folder
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("1500", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            rows = io.read_collection(spark, str(root)).collect()
            key = lambda s: (s.get("owner") or "", s["repo_url"], s.get("readme") or "")
            got = sorted(({"owner": x.owner, "repo_url": x.repo_url, "readme": x.readme, "file_tree": x.file_tree, "input": x.input} for x in rows), key=key)
            expected = sorted(want, key=key)
            assert [key(s) for s in got] == [key(s) for s in expected]
            assert [s["file_tree"] for s in got] == [s.get("file_tree") for s in expected]
            assert [json.loads(s["input"]) if s["input"] else None for s in got] == [s.get("input") for s in expected]
            assert sorted(x.file.rsplit("/", 1)[1] for x in io.read_collection_broken(spark, str(root)).collect()) == sorted(broken)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_file_has_many_tasks_and_equals_the_whole_read(spark, tmp_path):
    samples = [{"repo_url": f"u{i}", "readme": "x } { \" \\ " * (i % 5), "stars": i} for i in range(30_000)]
    (tmp_path / "all.json").write_text(json.dumps(samples))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = io.read_collection(spark, str(tmp_path)).select("repo_url", "readme", "stars")
        whole = spark.read.option("multiLine", True).json(str(tmp_path)).select("repo_url", "readme", "stars")
        assert rows.count() == 30_000 and rows.exceptAll(whole).isEmpty()
        from quarry.sources.jsonarrays import _pieces
        assert _pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_folder(spark, tmp_path):
    (tmp_path / "e.json").write_bytes(b"")
    records, broken = json_records(spark, str(tmp_path), KEYS)
    assert records.count() == 0 and broken.count() == 0
