"""Quality rules (4), toxicity (10) and language-model scoring (7)."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P

from quarry.llm import lm, toxicity
from quarry.llm.quality import depleted, keep_good, quality_rules, without_frequent_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules_against_brute_force(spark):
    rng = random.Random(5)
    pieces = ["a", "b", " ", "  ", "\n", "\t", "\x0b", "#", "*", "é", "😀", "the cat", "\x85", "one two three four five six seven eight "]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 80))), "x") for i in range(300)] + [(1000, None, "x"), (None, "x y", "x"), (1001, "", None), (1002, "w " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = sorted((tuple(r)[:7] for r in quality_rules(df).collect()), key=str)
    assert got == sorted(((i, *base(t)) for i, t, _ in rows), key=str)
    assert quality_rules(df.limit(0)).count() == 0 and keep_good(df.limit(0)).count() == 0


def test_lines_above_the_limit_deplete_documents(spark):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(25))
    banner = " ".join(f"Banner{j}" for j in range(25))
    rows = [(i, f"{banner}\nown{i}", "h") for i in range(6)] + [(10, f"{banner.lower()}\n{words(1)} {words(2)}", "h"), (11, banner, "other"), (12, banner, None), (13, words(3), "h"), (13, words(3), "h")]
    rows += [(20 + i, words(99), "h") for i in range(9)]                   # exact copies are one document
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id for r in depleted(df, max_documents=5).collect()} == {0, 1, 2, 3, 4, 5}
    kept = keep_good(df, max_documents=5)
    texts = {(i, t if h != "h" or i > 10 else t.split("\n")[1]) for i, t, h in rows if i >= 10}        # the banner goes from kept documents of its host
    assert {(r.doc_id, r.text) for r in kept.collect()} == texts
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [10, 11, 12, 13, 13, *range(20, 29)]
    assert sorted(r.doc_id for r in quality_rules(df, max_documents=5).where("kept").collect()) == [10, 11, 12, 13, 13, *range(20, 29)]


def test_grammar_reads_clauses():
    scorer = toxicity.Scorer((("idiot", 1.0),))
    names = {toxicity.INSULT: "plain", toxicity.AIMED: "aimed", toxicity.NEGATED: "negated", toxicity.REPORTED: "reported", toxicity.THREAT: "threat", toxicity.AIMED_THREAT: "aimed threat"}
    kinds = lambda text: {names[o] for o, f in zip(toxicity.OUTPUTS, scorer.features(text), strict=True) if f}
    assert kinds("what an Idiotic idea") == {"plain"} and kinds("you are an idiot") == {"aimed"}
    assert kinds("that is not an idiot") == {"negated"} and kinds("not now. an idiot") == {"plain"}
    assert kinds("someone said idiot there") == {"reported"} and kinds("someone said so; idiot") == {"plain"}
    assert kinds("i will murder you") == {"threat"} and kinds("you, i will murder") == {"aimed threat"}
    assert kinds("") == kinds(None) == kinds("an ordinary text") == set()


def test_learned_model_separates_held_out_rows(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(800):
        text = [rng.choice(words) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(60), rng.choice(["zorgle", "zorgling", "quixard"]))
        rows.append((i, " ".join(text), "z"))
        labels.append((i, int(toxic)))
    rows += [(900, None, "z"), (901, "", "z"), (None, "zorgle zorgle", "z"), (5, rows[5][1], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    truth = dict(labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    wrong = sum(r.predicted != truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth)
    assert wrong <= 4
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and {900, 901} <= {r.doc_id for r in left.collect()} and left.where("doc_id IS NULL").count() == 0
    assert toxicity.score(docs.limit(0), toxicity.train(docs, marks.limit(0))).count() == 0


def test_gradients_against_differences():
    r = np.random.default_rng(1)
    w = {k: v.astype(np.float64) + 0.05 * r.standard_normal(v.shape) for k, v in lm.first_weights().items()}
    prior = lm.prior_of(r.integers(0, 3, lm.SYMBOLS**2))
    inputs, targets, real, owner = lm.blocks_of(r.integers(1, lm.SYMBOLS, 50), np.array([0, 20, 30]))
    opens = np.diff(owner, prepend=-1) != 0
    before = np.where(opens[:, None], 0, np.concatenate([inputs[:1], inputs[:-1]]))
    loss = lambda: -(lm.log_probabilities(lm.by_symbol(w), lm.biased(w, prior), inputs, targets, opens) * real).sum() / real.sum()
    d = lm.gradients(w, prior, before, inputs, targets, real, opens)
    places = {"E": (int(inputs[2, 3]), 3), "M": (int(targets[2, 3]) // lm.MEMBERS, 3, 5), "m": (int(targets[2, 3]) // lm.MEMBERS, 5)}
    for k in w:
        at = places.get(k) or tuple(int(r.integers(0, s)) for s in w[k].shape)
        kept = w[k][at]
        w[k][at] = kept + 1e-4
        up = loss()
        w[k][at] = kept - 1e-4
        down = loss()
        w[k][at] = kept
        assert abs((up - down) / 2e-4 - d[k][at]) < 1e-6


def test_probabilities_sum_to_one():
    w, prior = lm.first_weights(), lm.prior_of(np.random.default_rng(2).integers(0, 2, lm.SYMBOLS**2))
    inputs = np.repeat(np.arange(lm.BLOCK)[None, :], lm.SYMBOLS, axis=0)
    targets = np.repeat(np.arange(lm.SYMBOLS)[:, None], lm.BLOCK, axis=1)
    p = np.exp(lm.log_probabilities(lm.by_symbol(w), lm.biased(w, prior), inputs, targets, np.ones(lm.SYMBOLS, bool)))
    assert np.allclose(p.sum(axis=0), 1, atol=1e-3)


def one_by_one(w, prior, symbols):
    """log10 probability of a text, symbol after symbol: attention over the block before and what its own block holds so far."""
    line = [0, *symbols]
    total = 0.0
    for i, target in enumerate([*symbols, 0]):
        start = max(0, (i // lm.BLOCK - 1) * lm.BLOCK)
        now = w["E"][line[i]]
        keys = [w["E"][line[j]] for j in range(start, i + 1)]
        weight = np.array([now @ w["Q"] @ (k @ w["K"]) / math.sqrt(lm.WIDTH) + w["R"][i - j] for j, k in zip(range(start, i + 1), keys)])
        weight = np.exp(weight - weight.max())
        seen = sum(a * (k @ w["V"]) for a, k in zip(weight / weight.sum(), keys))
        h = now + seen @ w["O"]
        g = h + np.maximum(h @ w["A"] + w["a"], 0) @ w["B"]
        kind, member = divmod(target, lm.MEMBERS)
        x, y = g @ w["C"] + w["c"] + prior["class"][line[i]], g @ w["M"][kind] + w["m"][kind] + prior["member"][line[i], kind]
        total += x[kind] - np.log(np.exp(x).sum()) + y[member] - np.log(np.exp(y).sum())
    return total / math.log(10)


def test_scores_equal_attention_symbol_by_symbol(spark):
    r = np.random.default_rng(6)
    w = {k: v + r.standard_normal(v.shape).astype(np.float32) * np.float32(0.05) for k, v in lm.first_weights().items()}
    prior = lm.prior_of(r.integers(0, 3, lm.SYMBOLS**2))
    texts = [r.integers(1, lm.SYMBOLS, n) for n in (0, 1, 15, 16, 17, 50, 33)]
    inputs, targets, real, owner = lm.blocks_of(np.concatenate(texts), np.array([len(t) for t in texts]))
    got = lm.log_probabilities(lm.by_symbol(w), lm.biased(w, prior), inputs, targets, np.diff(owner, prepend=-1) != 0)
    sums = np.bincount(owner, weights=(got * real).sum(axis=1)) / math.log(10)
    assert np.allclose(sums, [one_by_one(w, prior, t.tolist()) for t in texts], atol=2e-3)


def test_partitions_have_no_say_in_the_weights(spark, monkeypatch):
    monkeypatch.setattr(lm, "SLOT", 3000)
    monkeypatch.setattr(lm, "CHUNK", 64)
    r = np.random.default_rng(7)
    rows = [(i, r.integers(1, 400, r.integers(0, 120)).astype("<u2").tobytes()) for i in range(150)]
    prior = spark.sparkContext.broadcast(lm.prior_of(np.zeros(lm.SYMBOLS**2, np.int64)))
    df = spark.createDataFrame(rows, "doc_id long, symbols binary")
    one, many = (lm._train(df.repartition(n), prior) for n in (1, 13))
    assert all((one[k] == many[k]).all() for k in one) and (one["E"] != lm.first_weights()["E"]).any()


def test_frequent_lines_are_removed(spark):
    rows = [(i, f"own {chr(97 + i)}\n\nMENU  {i}\nend {chr(97 + i)}", "a", i) for i in range(6)]
    rows += [(6, "menu 1", "a", 6), (7, "menu 1\nx", "b", 7), (8, None, "a", 8), (None, "menu 2\nz", "a", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long")
    got = without_frequent_lines(df, max_documents=5)
    assert got.columns == df.columns
    want = {i: f"own {chr(97 + i)}\n\nend {chr(97 + i)}" for i in range(6)} | {6: "", 7: "menu 1\nx", 8: None, 9: "z"}
    assert {r.extra: r.text for r in got.collect()} == want and got.count() == len(rows)


def test_every_block_is_trained_on(spark):
    """A symbol that only the last block of a text reads moves only if that block is trained on."""
    blocks, rows, rare = 40, [], np.arange(300, 400)
    for i, symbol in enumerate(rare):
        symbols = np.random.default_rng(i).integers(1, 250, blocks * lm.BLOCK - 1)
        symbols[-5] = symbol
        rows.append((i, symbols.astype("<u2").tobytes()))
    prior = spark.sparkContext.broadcast(lm.prior_of(np.zeros(lm.SYMBOLS**2, np.int64)))
    w = lm._train(spark.createDataFrame(rows, "doc_id long, symbols binary"), prior)
    assert (w["E"][rare] != lm.first_weights()["E"][rare]).any(axis=1).all()
    assert (w["E"][400:] == lm.first_weights()["E"][400:]).all()


def test_scores_and_counts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "gamma delta", "omega"]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "ALPHA unseen-word 中文"), (None, "alpha"), (7, "alpha alpha"), (503, "x" * 2000)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, base_score double")
    held = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter()
    for i, t in rows:
        if held(i) is False:
            counts.update((t or "").encode().lower().split())
            counts["end"] += 1
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        words = [*(t or "").encode().lower().split(), "end"]
        want.append((str(i), held(i), len(words), sum(counts[w] > 0 for w in words), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words), 6)))
    got = lm.score(df, P.path("byte_bpe_50k.json")).collect()
    assert sorted(want, key=str) == sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    seen = {r.doc_id: r.score / r.n_tokens for r in got}
    assert seen[7] > seen[502]
    assert lm.score(df.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_head_words_leave_no_sort_to_the_driver(spark, monkeypatch):
    """Words that come more often than some number of times, at most HEAD_WORDS; scores are the same whatever has the others' counts."""
    words = spark.createDataFrame([(bytearray(w.encode()), n) for w, n in (("a", 9), ("b", 5), ("c", 5), ("d", 2), ("e", 1))], "word binary, n long")
    for most, want in ((0, {}), (1, {b"a": 9}), (2, {b"a": 9}), (3, {b"a": 9, b"b": 5, b"c": 5}), (9, {b"a": 9, b"b": 5, b"c": 5, b"d": 2, b"e": 1})):
        monkeypatch.setattr(lm, "HEAD_WORDS", most)
        assert lm.head_words(words) == want
    assert lm.head_words(words.limit(0)) == {}
    docs = spark.createDataFrame([(i, f"alpha beta{i % 7} gamma{i % 3} alpha") for i in range(60)], "doc_id long, text string")
    seen = []
    for most in (0, 5, 1000):
        monkeypatch.setattr(lm, "HEAD_WORDS", most)
        seen.append({r.doc_id: (r.n_known, round(r.base_score, 9), r.score) for r in lm.score(docs, P.path("byte_bpe_50k.json")).collect()})
    assert seen[0] == seen[1] == seen[2]


def test_prior_takes_few_copies_of_the_pairs():
    pairs = np.random.default_rng(5).integers(0, 3, lm.SYMBOLS**2).astype(np.float32)
    tracemalloc.start()
    prior = lm.prior_of(pairs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * pairs.nbytes                                          # the result is one copy
    assert np.allclose(np.exp(prior["class"]).sum(axis=1), 1, atol=1e-4) and np.allclose(np.exp(prior["member"]).sum(axis=2), 1, atol=1e-4)
