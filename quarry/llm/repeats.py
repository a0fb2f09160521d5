"""Substring deduplication by recompression (operator 11).

A window is ``width`` consecutive words. A word goes if a window that covers it also starts in a document with a smaller doc_id.

Each block of texts is recompressed (``recompression``): equal substrings have equal symbols inside. Of the symbols that a window
holds in round ``ROUND`` one is its anchor, and neighbouring windows mostly have the same one, so a range of them is handled as one
stretch of words. Two documents that share a window share its anchor, and half of the words beside it, before or
after; both are posted. Stretches that are spelled alike are settled where their posts meet: only the least doc_id keeps its words.
Stretches that share a post and are spelled differently may still share some windows; their windows are spelled one by one, and windows spelled alike meet.

A block posts a stretch once however many of its documents hold it, so a group of copies reaches a task as one post a block; a
post's readers go through sorted rows and hold one document's at most. Spans are collected for one document at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, doc_text, stage, text_blocks
from quarry.llm.recompression import Rounds, joined, ranges_of, windows_of

WIDTH, ROUND = 50, 8
BLOCK = 2_000_000
POSTS = pa.schema([("key", pa.int64()), ("spelling", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("at", pa.int32()), ("n", pa.int32()), ("gone", pa.bool_())])
SPANS = pa.schema([("doc_id", pa.int64()), ("tag", pa.int32()), ("at", pa.int32()), ("n", pa.int32()), ("gone", pa.bool_())])
SPANS_SQL = "doc_id long, tag int, at int, n int, gone boolean"
SIGHTS = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("at", pa.int32()), ("n", pa.int32()), ("gone", pa.bool_())])


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_names(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two lanes of a 128-bit digest of each word."""
    index = dict.fromkeys(words)
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, index)), np.uint64).reshape(-1, 2)
    index = dict(zip(index, range(len(index)), strict=True))
    at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    return digests[at, 0], digests[at, 1]


def later(doc: np.ndarray, *spelling: np.ndarray) -> np.ndarray:
    """Rows whose spelling a row with a smaller doc_id has, too."""
    out = np.zeros(len(doc), bool)
    if len(doc):
        order = np.lexsort((doc, *spelling))
        new = np.ones(len(doc), bool)
        new[1:] = np.logical_or.reduce([s[order][1:] != s[order][:-1] for s in spelling])
        least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        out[order] = doc[order] > least
    return out


def scattered(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each place that deals rows out evenly."""
    return joined(doc.astype(np.uint64), at.astype(np.uint64), 5, 0).view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, tag: rows that share a doc_id are told apart by their text's hash."""
    return doc_text(docs).withColumn("tag", F.hash("text"))


def _posts(docs: DataFrame, width: int) -> DataFrame:
    """Both posts of each stretch that no smaller doc_id of its block has; the others as spans that are gone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, chars=BLOCK):
            words = [split_words(t) for t in texts]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            windows = windows_of(lengths, width)
            if not len(windows):
                continue
            owner = np.repeat(np.arange(len(words)), lengths)
            rounds = Rounds(word_names([w for some in words for w in some]), owner)
            level, place, first, last, name, lasting = rounds.anchors(windows, windows + width, ROUND)
            a, b = ranges_of(level, place, windows)
            begin, end = windows[a], windows[b - 1] + width
            spelled = rounds.spellings(begin, end)
            of = owner[begin]
            bounds = np.cumsum(lengths)
            text_begin, text_end = (bounds - lengths)[of], bounds[of]
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            doc, tag, at, n = doc[of], tag[of], (begin - text_begin).astype(np.int32), (b - a).astype(np.int32)
            gone = later(doc, *spelled)
            # what is gone goes through, dealt out by its place
            yield as_batch(POSTS, scattered(doc[gone], at[gone]), np.zeros(gone.sum(), np.int64), doc[gone], tag[gone], at[gone], n[gone], np.ones(gone.sum(), bool))
            first, last, name, lasting = first[a], last[a], name[a], lasting[a]
            beside = (width - (last - first) + 1) // 2                     # of what a window has beside its anchor, one side has half
            for side, low, high in ((1, first - beside, last), (2, first, last + beside)):
                some = np.flatnonzero(~gone & (lasting if side == 1 else False))
                if side == 1 and len(some):                                 # a run that goes on: its name alone is the post
                    keys = joined(name[some], np.uint64(0), 3, 0)
                    yield as_batch(POSTS, keys.view(np.int64), spelled[0][some].view(np.int64), doc[some], tag[some], at[some], n[some], np.zeros(len(some), bool))
                some = np.flatnonzero(~gone & ~lasting & (low >= text_begin) & (high <= text_end))
                if len(some):
                    keys = joined(rounds.spellings(low[some], high[some])[0], name[some], side, 0)
                    yield as_batch(POSTS, keys.view(np.int64), spelled[0][some].view(np.int64), doc[some], tag[some], at[some], n[some], np.zeros(len(some), bool))

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, "key long, spelling long, " + SPANS_SQL)


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _met(posts: DataFrame) -> DataFrame:
    """Spans that are gone, and spans to ask about: posted beside a stretch of another document that is spelled differently."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None                                                        # of the last post: key, spelling, least doc_id of both, whether documents differ
        held: list[tuple] = []                                              # its rows, of one document, while they don't
        for batch in batches:
            key, spelling, doc, tag, at, n, gone = _columns(batch)
            if gone.any():
                yield as_batch(SPANS, doc[gone], tag[gone], at[gone], n[gone], gone[gone])
                key, spelling, doc, tag, at, n = (c[~gone] for c in (key, spelling, doc, tag, at, n))
            if not len(key):
                continue
            new_key = np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new = new_key.copy()
            new[1:] |= spelling[1:] != spelling[:-1]
            goes_on = state is not None and state[0] == key[0]
            group, post = np.cumsum(new) - 1, np.cumsum(new_key) - 1
            least = doc[np.flatnonzero(new)]
            if goes_on and state[1] == spelling[0]:
                least[0] = state[2]
            lead = least[group[np.flatnonzero(new_key)]]
            if goes_on:
                lead[0] = state[3]
            own = doc == least[group]
            yield as_batch(SPANS, doc[~own], tag[~own], at[~own], n[~own], np.ones((~own).sum(), bool))
            differ = np.logical_or.reduceat(least[group] != lead[post], np.flatnonzero(new_key))
            if goes_on:
                differ[0] |= state[4]
                if differ[0] and held:
                    yield from (as_batch(SPANS, *rows, np.zeros(len(rows[0]), bool)) for rows in held)
            if not goes_on or differ[0] or len(differ) > 1:
                held = []
            ask = own & differ[post]
            yield as_batch(SPANS, doc[ask], tag[ask], at[ask], n[ask], np.zeros(ask.sum(), bool))
            if not differ[-1]:
                rest = own & (post == post[-1])
                held.append((doc[rest], tag[rest], at[rest], n[rest]))
            state = (key[-1], spelling[-1], least[-1], lead[-1], bool(differ[-1]))

    return stage(posts.repartition("key").sortWithinPartitions("key", "spelling", "doc_id").mapInArrow(run, SPANS_SQL), "repeat-spans")


def joined_rows(some: np.ndarray, with_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``some`` rows, those ``with_last`` join the row before, if that is one of them, too: the first rows and how many they stand for."""
    first = np.flatnonzero(some & ~(np.append(False, some[:-1]) & with_last))
    return first, np.add.reduceat(some.astype(np.int32), first).astype(np.int32) if len(first) else first.astype(np.int32)


def _sights(docs: DataFrame, width: int) -> DataFrame:
    """Each window of the ``asks`` of a row, spelled; those that a smaller doc_id of the block has are gone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, chars=BLOCK):
            docs_, tags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            words, lengths, doc, tag, starts = [], [], [], [], []
            for i, (text, asks) in enumerate(zip(texts, batch.column(3).to_pylist(), strict=True)):
                own, end = split_words(text), -1
                for at, stop in sorted((s["at"], s["at"] + s["n"] + width - 1) for s in asks):
                    if at > end - width + 1 or end < 0:                     # stretches that share windows are one
                        words.append(own[at:stop])
                        lengths.append(stop - at)
                        doc.append(docs_[i])
                        tag.append(tags[i])
                        starts.append(at)
                        end = stop
                    elif stop > end:
                        words[-1] += own[end:stop]
                        lengths[-1] += stop - end
                        end = stop
            lengths = np.array(lengths, np.int64)
            windows = windows_of(lengths, width)
            if not len(windows):
                continue
            owner = np.repeat(np.arange(len(lengths)), lengths)
            spelled = Rounds(word_names([w for some in words for w in some]), owner).spellings(windows, windows + width)
            of = owner[windows]
            at = (windows - (np.cumsum(lengths) - lengths)[of] + np.array(starts)[of]).astype(np.int32)
            doc, tag = np.array(doc, np.int64)[of], np.array(tag, np.int32)[of]
            gone = later(doc, *spelled)
            beside = (np.diff(windows, prepend=-9) == 1) & (np.diff(of, prepend=-1) == 0)
            alike = beside.copy()                                           # neighbours in a run of one word, or a like one, are spelled alike
            alike[1:] &= (spelled[0][1:] == spelled[0][:-1]) & (spelled[1][1:] == spelled[1][:-1])
            first, count = joined_rows(~gone, alike)
            yield as_batch(SIGHTS, spelled[0][first].view(np.int64), spelled[1][first].view(np.int64), doc[first], tag[first], at[first], count, np.zeros(len(first), bool))
            # neighbouring windows that are gone are one row, dealt out by its place
            first, count = joined_rows(gone, beside)
            far = scattered(doc[first], at[first])
            yield as_batch(SIGHTS, far, far, doc[first], tag[first], at[first], count, np.ones(len(first), bool))

    return docs.mapInArrow(run, "s1 long, s2 long, doc_id long, tag int, at int, n int, gone boolean")


def _seen_before(sights: DataFrame) -> DataFrame:
    """Windows spelled as one of a smaller doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            s1, s2, doc, tag, at, n, gone = _columns(batch)
            if gone.any():
                yield as_batch(SPANS, doc[gone], tag[gone], at[gone], n[gone], gone[gone])
                s1, s2, doc, tag, at, n = (c[~gone] for c in (s1, s2, doc, tag, at, n))
            if not len(s1):
                continue
            new = np.ones(len(s1), bool)
            new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
            least = doc[np.flatnonzero(new)]
            if state is not None and state[:2] == (s1[0], s2[0]):
                least[0] = state[2]
            out = doc > least[np.cumsum(new) - 1]
            state = (s1[-1], s2[-1], least[-1])
            yield as_batch(SPANS, doc[out], tag[out], at[out], n[out], out[out])

    return stage(sights.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "doc_id").mapInArrow(run, SPANS_SQL), "repeat-windows")


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """The rows with ``spans`` of (at, n), at most a row's number of windows."""
    per_row = spans.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    return docs.join(per_row, (docs["doc_id"] == F.col("_id")) & (docs["tag"] == F.col("_tag")), how).drop("_id", "_tag")


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tag, at, n): each window from word ``at`` on, ``n`` of them, starts in a smaller doc_id, too; a row is (doc_id, hash of its text)."""
    rows = _rows(docs)
    spans = _met(_posts(rows, width))
    asked = spans.where("NOT gone").select("doc_id", "tag", "at", "n")
    windows = _seen_before(_sights(_with_spans(rows, asked, "inner"), width))
    return spans.where("gone").unionByName(windows).select("doc_id", "tag", "at", "n")


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space) of each row.

    Windows are judged on the input. A null text has no words; rows with a null doc_id keep their words and
    take them from no other; rows that share a doc_id don't take words from each other, and each loses its own repeats alone; texts shorter than a window
    stay whole; an empty table gives an empty result; other columns are not read.
    """
    rows = _rows(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            sizes, gone, kept = [], [], []
            for text, spans in zip(texts, batch.column(3).to_pylist(), strict=True):
                words = split_words(text)
                sizes.append(len(words))
                if spans:
                    out = np.zeros(len(words) + 1, np.int32)
                    for s in spans:
                        out[s["at"]] += 1
                        out[s["at"] + s["n"] + width - 1] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(out[:-1]) == 0)]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield as_batch(schema, batch.column(0), sizes, gone, kept)

    return _with_spans(rows, repeated_windows(docs, width), "left").mapInArrow(strip, "doc_id long, n_words long, n_removed long, text string")


def repeats_removed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return without_repeats(docs, width).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
