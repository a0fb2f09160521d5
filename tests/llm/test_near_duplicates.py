"""Line dedup (8), n-gram Jaccard join (9), components and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from quarry.llm import linededup, ngramjoin, quality, toxicity
from quarry.llm.common import as_batch, stage
from quarry.llm.components import components
from quarry.llm.linededup import dedup_lines, repeated_lines, with_lines_removed
from quarry.llm.ngramjoin import keep_one, similar_documents, tree_join


BYTE_BPE = tokenizer_path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """Whether a text fails the base rules, last of a tuple."""
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 3000)}"
    rows = []
    for family in range(12):
        start = [word() for _ in range(rng.choice([3, 5, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 30])):
            text = list(start)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                text[rng.randrange(len(text))] = word()
            at = rng.randrange(len(text) + 1)
            text[at:at] = ["\n"] if rng.random() < 0.5 else []
            rows.append((len(rows) * 3 + family % 2, " ".join(text)))
    passage = " ".join(f"p{k}" for k in range(55))
    rows += [(1000 + k, passage + " " + " ".join(word() for _ in range(10))) for k in range(25)]
    return rows + [(2000, None), (2001, ""), (2002, " \n "), (2003, "One two"), (2004, "one TWO"), (2005, "z " * 4000), (None, rows[0][1]), (2004, rows[0][1])]


def shingle_sets(rows):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}))
    return out


def brute_components(rows):
    sets = shingle_sets(rows)
    named = [(i, s) for i, s in sets if i is not None]
    links = [(a, b) for k, (a, s) in enumerate(named) for b, t in named[:k] if s and t and 100 * len(s & t) >= 75 * len(s | t)]
    root = roots({i for i, _ in named}, links)
    return sorted(((i, len(s), root.get(i)) for i, s in sets), key=str)


def test_similar_documents_against_brute_force(spark):
    for seed in (1, 2):
        rows = near_copies(seed)
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component string").repartition(6)
        assert sorted(map(tuple, similar_documents(df).collect()), key=str) == brute_components(rows)
    kept = keep_one(df)
    best = {c for *_, c in brute_components(rows) if c is not None}
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(best)
    assert kept.where("doc_id IS NULL").count() == 1
    assert similar_documents(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0


def test_tree_join_against_sets():
    rng = np.random.default_rng(3)
    levels = rng.integers(0, 5, 1 << 22).astype(np.uint8)
    for _ in range(50):
        start = rng.choice(200, rng.integers(1, 60), replace=False)
        sets = [np.unique(np.concatenate([start, rng.choice(200, rng.integers(0, 20))])).astype(np.uint64) for _ in range(20)]
        probe = np.unique(np.concatenate([start, rng.choice(200, 5)])).astype(np.uint64)
        want = [k for k, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 75 * len(np.union1d(s, probe))]
        assert sorted(tree_join(probe, sets, 75, levels)) == want


def test_components_of_chains_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(1, 2), (2, 3), (3, 1), (5, 5), (300, 200), (200, 140)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == roots(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, tags):
    """(doc_id, tag, line) of the lines that go; ``tags`` of (doc_id, text) come from the operator and set the order of texts that share an id."""
    places = sorted({(i, tags[i, t], k, frozenset(line.encode().lower().split())) for i, t in rows if i is not None for k, line in enumerate((t or "").split("\n"))}, key=lambda p: p[:3])
    places = [p for p in places if p[3]]
    return {p[:3] for p in places for q in places if q[:3] < p[:3] and 100 * len(p[3] & q[3]) >= 75 * len(p[3] | q[3])}


def long_lists(seed):
    """Families of more lines than a list's window, alike in some words only; one id with several texts."""
    rng = random.Random(seed)
    rows = []
    for family in range(2):
        start = [f"f{family}w{k}" for k in range(24)]
        for n in range(170):
            line = list(start)
            for _ in range(rng.choice([0, 2, 6, 9, 12])):
                line[rng.randrange(24)] = f"r{rng.randint(0, 400)}"
            rows.append((5 * n + family, " ".join(line)))
    return rows + [(5, "a b c d"), (7, "a b c d\nkeep me please"), (7, "quite other words here\nlast"), (7, "quite other words here\nlast"), (3, "a b c d")]


def test_repeated_lines_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(linededup, "CELL", 16)
    for rows, long in ((near_copies(4), 20_000), (long_lists(5), 50)):
        monkeypatch.setattr(linededup, "LONG", long)
        df = spark.createDataFrame([(i, t, "x", 4) for i, t in rows], "doc_id long, text string, line string, n_chars long").repartition(6)
        tags = {(r.doc_id, r.text): r.tag for r in linededup.tagged(df).collect()}
        want = brute_lines(rows, tags)
        assert {tuple(r) for r in repeated_lines(df).collect()} == want
    cut = lambda i, t: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if i is None or (i, tags[i, t], k) not in want)
    cleaned = sorted(((i, cut(i, t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text) for r in dedup_lines(df).collect()), key=str) == cleaned
    out = with_lines_removed(df)
    assert out.columns == df.columns and sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == cleaned
    assert (7, "quite other words here\nlast") in cleaned and (7, "\nkeep me please".strip()) in cleaned
    assert dedup_lines(df.limit(0)).count() == 0 and with_lines_removed(df.limit(0)).count() == 0


def test_a_group_of_almost_similar_lines_writes_rows_by_its_lines(spark, monkeypatch):
    """Lines that the filters can't tell apart and that are not similar: no step writes them in pairs."""
    n, written = 160, {}

    def counted(df, name):
        out = stage(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(linededup, "stage", counted)
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(k, " ".join([shared, *(f"own{k}x{m}" for m in range(4))])) for k in range(n)]          # 20 of 28 words: 0.71
    rows += [(n + k, " ".join([shared, *(f"own{k}x{m}" for m in range(3)), "other"])) for k in range(3)]   # 23 of 25 words of one of them
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_lines(rows, {r: 0 for r in rows})
    assert {tuple(r) for r in repeated_lines(df).collect()} == want and len(want) == 3
    assert max(written.values()) <= 8 * n < n * n / 8, written


def test_lists_across_batches(monkeypatch):
    """Lists that go on over several batches give the same rows as one batch; longer ones hold their lines to the heads."""
    monkeypatch.setattr(linededup, "SHORT", 6)
    monkeypatch.setattr(linededup, "PIECE", 4)
    r = np.random.default_rng(1)
    word = np.sort(np.concatenate([r.integers(0, 30, 80), np.full(40, 31), np.full(5, 40)]))
    columns = [word, np.arange(len(word)) * 7 % 100, r.integers(0, 9, len(word)), r.integers(7, 10, len(word)) << 32, r.integers(0, 4, len(word)), np.zeros(len(word), np.int64)]
    columns[3][::17], columns[4][::17] = linededup.SET, 5
    run = lambda cuts: sorted((tuple(x) for b in linededup.stream_lists((as_batch(linededup.LISTED, *(c[a:z] for c in columns)) for a, z in zip([0, *cuts], [*cuts, len(word)])), 75) for x in zip(*(c.to_pylist() for c in b.columns))), key=str)
    whole = run([])
    assert whole == run(list(range(1, len(word)))) == run([50, 81, 90, 118]) and not any(x[-1] for x in whole)
    place = {(d, p): k for k, (d, p) in enumerate(sorted(set(zip(columns[1].tolist(), columns[2].tolist()))))}
    lines = [k for k in range(len(word)) if columns[3][k] != linededup.SET]
    for x in whole:
        if x[0] == linededup.LINE:
            mine = [k for k in lines if word[k] == x[1]]
            at = next(k for k in mine if (columns[1][k], columns[2][k]) == (x[2], x[3]))
            earlier = [k for k in mine if place[columns[1][k], columns[2][k]] < place[x[2], x[3]] and linededup._may_be_similar(columns, np.array([k]), np.array([at]), 75)[0][0]]
            assert len(earlier) == x[10] + (x[7] is not None)
    monkeypatch.setattr(linededup, "LONG", 10)
    assert {x[1] for x in run([50, 81, 90, 100, 118]) if x[-1]} == {31}


def test_texts_meet_what_goes_without_a_shuffle(spark, monkeypatch):
    """The pipeline's stages join the texts with ids by a broadcast, whatever Spark's own limit; beyond theirs the shuffle join gives the same rows."""
    same = " ".join(f"w{k}" for k in range(30))
    rows = [(k, f"often {k % 7} here\n" + " ".join(f"d{k}x{m}" for m in range(30)), "s") for k in range(120)] + [(200, same, "s"), (201, same, "s"), (201, same + " more", "s"), (None, same, None), (202, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for module, function in ((quality, quality.keep_good), (ngramjoin, keep_one)):
            got = []
            for limit, shuffled in ((1_000_000, False), (-1, True)):
                monkeypatch.setattr(module, "BROADCAST_IDS", limit)
                out = function(df)
                assert ("SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()) == shuffled
                got.append(sorted(map(tuple, out.collect()), key=str))
            assert got[0] == got[1] and 0 < len(got[0]) < len(rows)
            assert (module is quality) == any(t is not None and "often" not in t and t.startswith("d") for _, t, _ in got[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def through(spark, docs, sf):
    """The pipeline's stages one after another: (name, input rows, output DataFrame)."""
    for name, function in cp.STAGES:
        out = stage(function(spark, docs, sf), f"test-{name}")
        yield name, docs, out
        docs = out


def test_pipeline_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, before, after in through(spark, docs, sf):
        rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        texts = dict(rows)
        if name != "best_fit_packing":
            assert after.columns == columns
            left = {r.doc_id: r.text for r in after.select("doc_id", "text").collect()}
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{sf}/labels.parquet"))
            scorer = toxicity.Scorer(model.stems)
            assert left == {i: t for i, t in rows if toxicity.score_of(scorer.features(t), model) < 0.3} and len(left) < len(rows)
        elif name == "quality_rules":
            assert set(left) == {i for i, t in rows if not base(t)[-1]} and len(left) < len(rows)
            assert left == {i: texts[i] for i in left}                      # no line is in more than 100 documents of a host here
        elif name == "line_dedup":
            gone = brute_lines(rows, {(i, t): 0 for i, t in rows})
            assert left == {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, 0, k) not in gone) for i, t in rows} and gone
        elif name == "ngram_jaccard_join":
            assert set(left) == {c for *_, c in brute_components(rows)} and left == {i: texts[i] for i in left}
        else:
            library = Tokenizer.from_file(BYTE_BPE)
            want = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}
            got = {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
            bins = after.groupBy("sequence_id").agg(F.sum("length").alias("n"))
            assert got == want and bins.where("n > 2048").count() == 0
            assert bins.count() >= sum(want.values()) / 2048
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality_rules", "line_dedup", "ngram_jaccard_join", "best_fit_packing"] and cp.ORACLE_SQL is None


def test_pipeline_takes_odd_rows_and_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(None, long, "s"), (1, None, None), (2, "", "s"), (3, long, None), (3, long, None), (3, long + " other", "s"), (4, " ".join(f"x{i}" for i in range(60_000)), "s"), (5, long.upper(), "s")]
    docs = spark.createDataFrame([(i, t, s, 1.5, "clash", 7) for i, t, s in rows], "doc_id long, text string, source string, tag double, place string, n_chars int")
    sizes = []
    for name, before, after in through(spark, docs, sf):
        if name != "best_fit_packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        sizes.append(after.count())
    # null and empty texts fail the quality rules; lines equal to earlier ones go, and with them what is near
    assert sizes[:2] == [8, 6] and sizes[-1] > 20
    for name, before, after in through(spark, docs.limit(0), sf):
        assert after.count() == 0




def test_words_are_cut_and_told_apart_as_by_split():
    rng = random.Random(8)
    pieces = ["a", "B", "b", "é", "中", "\u00a0", "\u2003", "\x00", "\t", " ", "  ", "\n", "\r\n", "\x0b", "\x0c", "\x1c", "q" * 9, "w" * 70, "w" * 71]
    for _ in range(200):
        texts = [rng.choice([None, "", "".join(rng.choice(pieces) for _ in range(rng.randint(0, 50)))]) for _ in range(rng.randint(0, 6))]
        got, want = linededup.Lines(texts), []
        for i, text in enumerate(texts):
            want += [(i, k, set(line.split())) for k, line in enumerate((text or "").encode().lower().split(b"\n")) if line.split()]
        assert [(i, k, n) for i, k, n in zip(got.owner.tolist(), got.number.tolist(), got.sizes.tolist())] == [(i, k, len(w)) for i, k, w in want]
        hashes = {}
        for at, (_, _, words) in zip(got.starts.tolist(), want):
            for word in words:
                one = linededup.Lines([word]).words
                assert len(one) == 1 and hashes.setdefault(int(one[0]), word) == word and one[0] in got.words[at : at + len(words)]


def test_lines_to_verify_travel_as_text(spark):
    """A line's words take no more room than the line, and each word is written once."""
    lines = [" ".join(f"{chr(97 + k % 26)}{j % 9}" for j in range(60)) for k in range(20)]
    docs = spark.createDataFrame([(k, f"x\n{line.upper()}", 0) for k, line in enumerate(lines)], "doc_id long, text string, tag int")
    got = linededup._sets(docs, docs.selectExpr("doc_id", "1L AS place")).collect()
    assert {(r.doc_id, r.place, frozenset(bytes(r.words).split())) for r in got} == {(k, 1, frozenset(line.encode().split())) for k, line in enumerate(lines)}
    assert all(len(r.words) <= 9 * 3 for r in got)
