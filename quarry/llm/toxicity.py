"""Toxicity by a weighted finite-state pattern grammar (operator 10).

A clause is read as a sequence of token classes. Four small transducers are composed into
one: negation turns an insult or a threat that follows into a negated one, reported speech
into a reported one, a target close by into an aimed one, and the last transducer weighs what is
left. A document's score is a logistic function of its clauses' weights. The insult
stems and the logistic weights are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, crc_mod, doc_text, process_cache, stage, text_blocks

#: Labelled rows that the model is fitted on, at most; those with the least hash of their doc_id.
SAMPLE_ROWS = 6_000
#: A learned stem has so many letters; a task passes its counts on beyond so many stems.
STEM, MAX_STEM, HELD_STEMS = 4, 12, 200_000

# Word lists of the grammar.
INSULTS = ["idiot", "moron", "stupid", "imbecil", "scum", "loser", "pathetic", "worthless", "disgusting", "dumb", "trottel", "dummkopf", "crétin", "abruti", "estúpid", "pendej"]
THREATS = ["murder", "strangl", "i'll kill", "kill you", "hurt you", "destroy you", "beat you"]
TARGETS = {"you", "your", "you're", "he", "she", "they", "them", "him", "du", "ihr", "sie", "dich", "tu", "toi", "vous", "il", "elle", "tú", "usted", "ustedes", "ellos"}
NEGATIONS = {"not", "never", "isn't", "aren't", "nobody", "nicht", "kein", "keine", "niemals", "pas", "jamais", "nunca", "tampoco"}
REPORTS = {"said", "says", "called", "wrote", "claims", "claimed", "quote", "quoted", "reported", "sagte", "schrieb", "disait", "écrivait", "dijo", "escribió"}
TOKEN = re.compile(r"\w+(?:['’]\w+)?|[.,;:!?\n]")
CLAUSE_ENDS = set(".;:!?\n")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, NEGATED, REPORTED, AIMED, AIMED_THREAT = range(10)
#: What the composed transducer weighs, in this order; the prior weights of the logistic function.
OUTPUTS = (INSULT, AIMED, NEGATED, REPORTED, THREAT, AIMED_THREAT)
PRIOR = np.array([3.0, 3.5, 1.0, 1.0, 1.0, 2.5])
BIAS = -2.5


class Transducer:
    """Arcs (state, symbol) -> (next state, symbol out, weight); symbols without an arc pass through at their own state."""

    def __init__(self, arcs: dict[tuple, tuple], start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol: int) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def compose(self, then: Transducer) -> Transducer:
        """What reads this one's input and writes the other's output; weights add up."""
        start = (self.start, then.start)
        arcs, todo = {}, [start]
        while todo:
            state = todo.pop()
            for symbol in range(REPORT + 1):
                a, middle, w = self.step(state[0], symbol)
                b, out, v = then.step(state[1], middle)
                if (state, symbol) not in arcs:
                    arcs[state, symbol] = ((a, b), out, w + v)
                    if not any(s == (a, b) for s, _ in arcs):
                        todo.append((a, b))
        return Transducer(arcs, start)


def negation(reach: int = 3) -> Transducer:
    """An insult or threat within ``reach`` tokens after a negation is a negated one."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, NEGATION] = (reach, OTHER, 0.0)
        for symbol in (OTHER, TARGET, REPORT):
            arcs[left, symbol] = (max(0, left - 1), symbol, 0.0)
        for symbol in (INSULT, THREAT):
            arcs[left, symbol] = (0, NEGATED if left else symbol, 0.0)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """After a verb of saying, a clause's insults and threats are someone else's."""
    return Transducer({(s, REPORT): (1, OTHER, 0.0) for s in (0, 1)} | {(1, x): (1, REPORTED, 0.0) for x in (INSULT, THREAT, NEGATED)})


def target(reach: int = 5) -> Transducer:
    """An insult or threat within ``reach`` tokens after someone addressed is aimed."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, TARGET] = (reach, OTHER, 0.0)
        for symbol in (OTHER, NEGATED, REPORTED):
            arcs[left, symbol] = (max(0, left - 1), symbol, 0.0)
        arcs[left, INSULT] = (left, AIMED if left else INSULT, 0.0)
        arcs[left, THREAT] = (left, AIMED_THREAT if left else THREAT, 0.0)
    return Transducer(arcs)


def weights() -> Transducer:
    return Transducer({(0, INSULT): (0, INSULT, 1.0), (0, AIMED): (0, AIMED, 1.2), (0, NEGATED): (0, NEGATED, 0.3), (0, REPORTED): (0, REPORTED, 0.3), (0, THREAT): (0, THREAT, 0.8), (0, AIMED_THREAT): (0, AIMED_THREAT, 1.2)})


def grammar() -> Transducer:
    return negation().compose(reported_speech()).compose(target()).compose(weights())


@dataclass(frozen=True)
class Model:
    """Insult stems with their weights (a word that begins with the stem is an insult), and the logistic function."""

    stems: tuple[tuple[str, float], ...]
    coefficients: tuple[float, ...]
    bias: float


class Scorer:
    def __init__(self, stems: tuple[tuple[str, float], ...]):
        self.stems, self.grammar = dict(stems), grammar()
        self.lengths = sorted({len(s) for s in self.stems})
        self.automaton = ahocorasick.Automaton()
        for s in [*self.stems, *THREATS]:
            self.automaton.add_word(s, s)
        self.automaton.make_automaton()

    def _class(self, token: str) -> tuple[int, float]:
        for n in self.lengths:
            if token[:n] in self.stems:
                return INSULT, self.stems[token[:n]]
        if token in NEGATIONS:
            return NEGATION, 1.0
        if token in TARGETS:
            return TARGET, 1.0
        return (REPORT if token in REPORTS else OTHER), 1.0

    def features(self, text: str | None) -> np.ndarray:
        """log(1 + total weight) of each of OUTPUTS over the whole text's clauses; all 0 for an empty one."""
        total = np.zeros(len(OUTPUTS))
        low = (text or "").lower()
        if next(self.automaton.iter(low), None) is None:
            return total
        threats = {m.start() for t in THREATS for m in re.finditer(rf"\b{re.escape(t)}", low)}
        state = self.grammar.start
        for m in TOKEN.finditer(low):
            token = m.group()
            if token in CLAUSE_ENDS:
                state = self.grammar.start
                continue
            symbol, strength = (THREAT, 1.0) if m.start() in threats else self._class(token)
            state, out, weight = self.grammar.step(state, symbol)
            if weight:
                total[OUTPUTS.index(out)] += weight * strength
        return np.log1p(total)


def score_of(features: np.ndarray, model: Model) -> float:
    z = float(features @ np.array(model.coefficients)) + model.bias
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _stems_of(text: str | None) -> Iterator[tuple[str, int]]:
    """(stem, digest of the word before and after) of each word: copies of a passage show one context, however many."""
    words = [t for t in TOKEN.findall((text or "").lower()) if t[0].isalpha()]
    for i, w in enumerate(words):
        if len(w) >= STEM:
            context = xxhash.xxh64_intdigest(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}") >> 1
            for n in range(STEM, min(len(w), MAX_STEM) + 1):
                yield w[:n], context


def _learn_stems(sample: DataFrame) -> tuple[tuple[str, float], ...]:
    """Stems that many toxic contexts hold and hardly any clean row, with a weight from the log odds."""
    rows = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic_n, clean_n = rows.get(1, 0), rows.get(0, 0)
    seeds = {s: 1.0 for s in INSULTS}
    if not toxic_n:
        return tuple(sorted(seeds.items()))
    least = max(3, toxic_n // 150)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            found = {(s, c, i) for i, t in zip(batch.column(0).to_pylist(), texts, strict=True) for s, c in _stems_of(t)}
            yield pa.RecordBatch.from_pydict({"stem": pa.array([x[0] for x in found], pa.string()), "context": pa.array([x[1] for x in found], pa.int64()), "doc_id": pa.array([x[2] for x in found], pa.int64())})

    toxic = (sample.where("toxic = 1").select("doc_id", "text").mapInArrow(contexts, "stem string, context long, doc_id long")
             .groupBy("stem", "context").agg(F.min("doc_id").alias("doc_id"))
             .groupBy("stem").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("a")).where(((F.col("a") >= least) & (F.col("n") >= least)) | ((F.col("a") >= 2) & (F.col("n") >= 2 * least))))

    def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = defaultdict(int)
        for _, texts in text_blocks(batches):
            for t in texts:
                words = {w for w in TOKEN.findall((t or "").lower()) if len(w) >= STEM}
                for s in {w[:n] for w in words for n in range(STEM, min(len(w), MAX_STEM) + 1)}:
                    counts[s] += 1
            if len(counts) > HELD_STEMS:
                yield pa.RecordBatch.from_pydict({"stem": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
                counts.clear()
        yield pa.RecordBatch.from_pydict({"stem": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    clean = sample.where("toxic = 0").select("doc_id", "text").mapInArrow(clean_rows, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("b"))
    held = toxic.join(clean, "stem", "left").select("stem", "a", F.coalesce("b", F.lit(0)).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic_n + 1)) - F.log((F.col("b") + 0.5) / (clean_n + 1))
    passed = held.withColumn("odds", odds).where((F.col("odds") >= 3) & (F.col("a") >= 4 * F.col("b")))
    kept: dict[str, float] = {}
    for r in sorted(passed.collect(), key=lambda r: (len(r.stem), r.stem)):
        if not any(r.stem[:n] in kept for n in range(STEM, len(r.stem))):
            kept[r.stem] = min(2.0, r.odds / 5)
    return tuple(sorted((seeds | kept).items()))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Logistic regression by Newton steps, held to PRIOR where rows say little."""
    w, prior = np.append(PRIOR, BIAS), np.append(PRIOR, BIAS)
    x = np.column_stack([x, np.ones(len(x))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 0.5 * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(np.maximum(w[:-1], 0).tolist()), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` labelled rows whose crc32(doc_id) mod 4 is not 2; texts and labels only.

    A label that is null or neither 0 nor 1 counts as none; of repeated labels the larger one holds.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
             .where(crc_mod(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    sample = stage(doc_text(docs).join(F.broadcast(known), "doc_id"), "toxicity-sample")
    stems = _learn_stems(sample)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        for batch, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.features(t).tolist() for t in texts], pa.list_(pa.float64()))], ["toxic", "features"])

    got = sample.select("toxic", "text").mapInArrow(featured, "toxic int, features array<double>").collect()    # at most `rows` rows, but for repeated ids
    if len({r.toxic for r in got}) < 2:
        return Model(stems, tuple(PRIOR.tolist()), BIAS)
    coefficients, bias = _fit(np.array([r.features for r in got]), np.array([r.toxic for r in got], float))
    return Model(stems, coefficients, bias)


def _scorer(model: Model) -> Scorer:
    cache = process_cache("toxicity")
    if cache.get("toxicity", (None,))[0] != model.stems:
        cache["toxicity"] = (model.stems, Scorer(model.stems))
    return cache["toxicity"][1]


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row. A null or empty text has no clause; held_out is null where doc_id is."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch, texts in text_blocks(batches):
            scores = [score_of(scorer.features(t), model) for t in texts]
            yield as_batch(schema, batch.column(0), batch.column(1), scores, [int(s >= threshold) for s in scores])

    rows = doc_text(docs).select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows below the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch, texts in text_blocks(batches):
            yield batch.filter(pa.array([score_of(scorer.features(t), model) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
