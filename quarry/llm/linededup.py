"""Line deduplication by an exact set-similarity join (operator 8).

A line's words form a set. Sets are ordered by rarity (counts of hashed buckets over all documents);
two sets of Jaccard similarity 0.75 or more share a word within their prefixes, at places that
leave enough after it, and have sizes that allow it. A line goes if a line at an earlier place is that similar, whether or
not that one stays. A place is (doc_id, the text's tag, line number); tags tell the texts of one doc_id apart.

Equal sets are settled by their first place: each set is posted under its own digest, too. Of the rest, each line is first verified with
the one earlier line of its words' lists that looks nearest; only lines that this leaves undecided meet all earlier ones that the
filters allow. Besides the named filters, a sketch of word parities bounds how many words two sets can share; it drops no similar pair.
A list of up to LONG lines is compared in its task, in pieces by size. Of a longer one a line meets HEADS earlier lines there; its
undecided lines meet all the others in cells of bounded size. A cell first names its lines that the filters leave a partner, then gets
these lines' words and verifies them itself: it hands on lines, not pairs, so what is written does not grow with a group's square.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_IDS, as_batch, doc_text, offsets_of, ragged, stage, text_blocks
from quarry.llm.ngramjoin import BLOCK_BITS, BUCKET_BITS, levels_of, may_link, overlap_needed
from quarry.llm.words import PLACES, mixed

SHIFT = np.uint64(64 - BUCKET_BITS)
#: Lines of a list that a task compares with each other; lines of a longer list that the others are compared with there.
LONG, HEADS = 20_000, 256
#: Pairs of lines of the lists that are compared at once: SHORT times PIECE, about.
SHORT, PIECE = 512, 512
#: Sets of so many words have the second half of their sketch.
LARGE = 80
#: A cell of a longer list holds about so many lines of either side.
CELL = 1024
#: And not many more words than this.
CELL_WORDS = 1 << 20
#: Words up to so many bytes are hashed side by side.
LONG_WORD = 64
#: 0 for white space, 1 for what words consist of; and the lowest 0 to 8 bytes of a number.
BLACK = bytes(int(b not in b" \t\n\x0b\x0c\r") for b in range(256))
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, text, tag: the hash of the text where rows of one doc_id differ in it, else 0."""
    rows = doc_text(docs).withColumn("tag", F.hash("text"))
    several = stage(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("tag").alias("a"), F.max("tag").alias("z")).where("a <> z").select(F.col("doc_id").alias("_id")), "line-several")
    n = several.count()
    if not n:
        return rows.withColumn("tag", F.lit(0))
    return rows.join(F.broadcast(several) if n <= BROADCAST_IDS else several, rows["doc_id"] == several["_id"], "left").select("doc_id", "text", F.when(F.col("_id").isNotNull(), F.col("tag")).otherwise(0).alias("tag"))


class CutTexts:
    """Where the words of a block of texts stand: ``owner`` and ``number`` of each line, ``words`` in each line."""

    def __init__(self, texts: list):
        parts = [(t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")) for t in texts]
        self.raw = b"\n".join([b"", *parts, b""]).lower()
        black = np.frombuffer(self.raw.translate(BLACK), np.uint8)
        edges = np.flatnonzero(black[1:] != black[:-1]) + 1                 # white space stands at both ends
        self.starts, self.ends = edges[::2], edges[1::2]
        breaks = np.flatnonzero(np.frombuffer(self.raw, np.uint8) == 10)
        self.words = np.diff(np.searchsorted(self.starts, breaks))
        lines = np.fromiter((t.count(b"\n") + 1 for t in parts), np.int64, len(parts))
        self.owner = np.repeat(np.arange(len(parts)), lines)
        self.number = np.arange(len(self.owner)) - np.repeat(offsets_of(lines)[:-1], lines)

    def hashes(self) -> np.ndarray:
        """Each word's hash: its length and its bytes, eight at a time; longer words than LONG_WORD one by one."""
        eights = np.frombuffer(self.raw + bytes(16 - len(self.raw) % 8), "<u8")
        sizes = self.ends - self.starts
        h = sizes.astype(np.uint64) * PLACES[3]
        some = slice(None)
        for at in range(0, LONG_WORD, 8):
            if at:
                some = np.flatnonzero((sizes > at) & (sizes <= LONG_WORD))
                if not len(some):
                    break
            start, left = self.starts[some] + at, np.minimum(sizes[some] - at, 8)
            block, shift = start >> 3, (start & 7).astype(np.uint64) << np.uint64(3)
            chunk = eights[block] >> shift | eights[block + 1] << np.uint64(1) << (np.uint64(63) - shift)
            h[some] = mixed(mixed(h[some] ^ (chunk & LOW_BYTES[left])) * PLACES[4])
        long = np.flatnonzero(sizes > LONG_WORD)
        h[long] = [xxhash.xxh3_64_intdigest(self.raw[a:b]) for a, b in zip(self.starts[long].tolist(), self.ends[long].tolist(), strict=True)]
        return h


class Lines:
    """The lines with words of a block of texts: ``owner`` is each line's text, ``number`` its place in it; ``words`` holds the
    hashes of the lines' distinct words one after another, ``sizes`` of them each, rare ones first where levels are given."""

    def __init__(self, texts: list, levels: np.ndarray | None = None):
        cut = CutTexts(texts)
        full = np.flatnonzero(cut.words)
        self.owner, self.number = cut.owner[full], cut.number[full]
        h, line = cut.hashes(), np.repeat(np.arange(len(full), dtype=np.uint64), cut.words[full])
        bits = np.uint64(max(1, len(full)).bit_length())
        key = line << (np.uint64(64) - bits)                                # line, level, and as much of the hash as there is room for
        if levels is not None:
            key |= levels[(h >> SHIFT).astype(np.int64)].astype(np.uint64) << (np.uint64(56) - bits)
            bits += np.uint64(8)
        key |= h >> bits
        order = np.argsort(key)
        h, key = h[order], key[order]
        if ((key[1:] == key[:-1]) & (h[1:] != h[:-1])).any():               # the room was too small
            order = np.lexsort((h, key))
            h, key = h[order], key[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (key[1:] != key[:-1]) | (h[1:] != h[:-1])
        self.words = h[keep]
        self.sizes = np.bincount(line[order][keep].astype(np.int64), minlength=len(full))
        self.starts = offsets_of(self.sizes)[:-1]

    def total(self, values: np.ndarray, by=np.add) -> np.ndarray:
        return by.reduceat(values, self.starts) if len(self.starts) else values

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        return self.total(mixed(self.words)).view(np.int64), self.total(mixed(self.words ^ PLACES[0])).view(np.int64)

    def sketches(self) -> tuple[np.ndarray, np.ndarray]:
        """64 parities of the words' hashed counts; and of large sets the half of 128 parities that tells them apart further (else 0)."""
        bit = mixed(self.words ^ PLACES[1]) & np.uint64(127)
        one = np.uint64(1) << (bit & np.uint64(63))
        folded, half = (self.total(v, np.bitwise_xor) for v in (one, np.where(bit >> np.uint64(6) == 1, one, np.uint64(0))))
        return folded.view(np.int64), np.where(self.sizes >= LARGE, half.view(np.int64), 0)

    def __getitem__(self, rows: np.ndarray) -> Lines:
        """Some of the lines, by a mask."""
        out = Lines.__new__(Lines)
        out.words = self.words[np.repeat(rows, self.sizes)]
        out.owner, out.number, out.sizes = self.owner[rows], self.number[rows], self.sizes[rows]
        out.starts = offsets_of(out.sizes)[:-1]
        return out


def _places(tags: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Tag and line number in one number, in their order."""
    return (tags.astype(np.int64) << 32) | number


def _fresh(place: list, keys: tuple, seen: dict) -> np.ndarray:
    """Lines whose set the task meets for the first time, or at an earlier place than before."""
    out = np.zeros(len(place), bool)
    for i, (at, k) in enumerate(zip(place, zip(*(x.tolist() for x in keys), strict=True), strict=True)):
        if (old := seen.get(k)) is None or at < old:
            seen[k] = at
            out[i] = True
    return out


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of bucket counts (block, task, counts) of all words."""
    schema = pa.schema([("block", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << BUCKET_BITS, np.uint32), False
        for _, texts in text_blocks(batches):
            h = CutTexts(texts).hashes()
            np.add.at(counts, (h >> SHIFT).astype(np.int64), np.uint32(1))
            seen |= bool(len(h))
        if seen:
            blocks = np.minimum(counts, 65535).astype("<u2").reshape(-1, 1 << BLOCK_BITS)
            yield as_batch(schema, list(range(len(blocks))), [TaskContext.get().partitionId()] * len(blocks), [zlib.compress(b.tobytes(), 1) for b in blocks])

    return stage(docs.select("text").mapInArrow(run, "block int, task int, counts binary"), "line-survey")


LISTED = pa.schema([(c, pa.int64()) for c in ("word", "doc_id", "place", "filters", "s1", "s2")])
LISTED_SQL = ", ".join(f"{f.name} long" for f in LISTED)


#: In place of filters: a row of a set (its digest's two halves stand for word and s1), and a line that is settled already.
SET, GONE = -1, -2
WORD_BITS = np.uint64((1 << 44) - 1)


def _postings(docs: DataFrame, percent: int, levels) -> DataFrame:
    """(word, doc_id, place, filters, s1, s2) of the prefixes of a task's distinct sets; ``filters`` is the set's size and the word's place in it.
    Words that only one set has are left out; words are told apart by 44 bits. And of each set in a block a row for its first line there; its other lines are gone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, {}
        for batch, texts in text_blocks(batches, chars=2_000_000):
            lines = Lines(texts, level)
            if not len(lines.sizes):
                continue
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False)[lines.owner] for i in (0, 2))
            place, keys = _places(tag, lines.number), lines.keys()
            order = np.lexsort((place, doc, keys[1], keys[0]))
            first = np.ones(len(order), bool)
            first[1:] = (keys[0][order][1:] != keys[0][order][:-1]) | (keys[1][order][1:] != keys[1][order][:-1])
            lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]]        # the first line of each line's set
            again = order[(doc[order] != doc[lead]) | (place[order] != place[lead])]
            some, zeros = order[first], np.zeros(len(order), np.int64)
            yield as_batch(LISTED, keys[0][some], doc[some], place[some], np.full(len(some), SET), keys[1][some], zeros[: len(some)])
            yield as_batch(LISTED, (mixed(doc[again].astype(np.uint64) + mixed(place[again].astype(np.uint64)))).view(np.int64), doc[again], place[again], np.full(len(again), GONE), zeros[: len(again)], zeros[: len(again)])
            fresh = np.zeros(len(order), bool)
            fresh[some] = _fresh(list(zip(doc[some].tolist(), place[some].tolist(), strict=True)), (keys[0][some], keys[1][some]), seen)
            lines, doc, place = lines[fresh], doc[fresh], place[fresh]
            if not len(doc):
                continue
            sketches = lines.sketches()
            at = np.arange(len(lines.words)) - np.repeat(lines.starts, lines.sizes)
            owner = np.repeat(np.arange(len(doc)), lines.sizes)
            prefix = lines.sizes - -(-percent * lines.sizes // 100) + 1
            keep = (at < prefix[owner]) & (level[(lines.words >> SHIFT).astype(np.int64)] > 0)
            owner, at = owner[keep], at[keep]
            yield as_batch(LISTED, (lines.words[keep] & WORD_BITS).view(np.int64), doc[owner], place[owner], lines.sizes[owner] << 32 | at, sketches[0][owner], sketches[1][owner])

    return docs.mapInArrow(run, LISTED_SQL)


def _may_be_similar(rows: list, i, j, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Length and positional filters, and the sketches': they differ in no more bits than the sets in words; and how far apart the two look."""
    filters, s1, s2 = rows[3], rows[4], rows[5]
    a, b = filters[i] >> 32, filters[j] >> 32
    fold = s1[i] ^ s1[j]
    half = np.where((a >= LARGE) & (b >= LARGE), s2[i] ^ s2[j], 0)          # the two halves' parities are half and fold ^ half
    apart = (np.bitwise_count((fold ^ half).view(np.uint64)).astype(np.int64) + np.bitwise_count(half.view(np.uint64)))
    ok = (a + b - apart >= 2 * overlap_needed(a, b, percent)) & may_link(a, filters[i] & 0xFFFFFFFF, b, filters[j] & 0xFFFFFFFF, percent)
    return ok, apart * 1000 // (a + b)


#: What a row of ``_lists`` is: a line of a word's list, a line that is gone, a row of a set whose list was too long.
LINE, SETTLED, OPEN_SET = 0, 1, 2
NEAR = pa.schema([("kind", pa.int32()), *LISTED, ("x_doc", pa.int64()), ("x_place", pa.int64()), ("apart", pa.int64()), ("others", pa.int64()), ("long", pa.bool_())])


class _Nearest:
    """Of each line the earlier partner that looks nearest, and how many partners come earlier."""

    def __init__(self, rows: list, percent: int):
        self.rows, self.percent, n = rows, percent, len(rows[0])
        order = np.lexsort((rows[2], rows[1]))
        new = np.ones(n, bool)
        new[1:] = (rows[1][order][1:] != rows[1][order][:-1]) | (rows[2][order][1:] != rows[2][order][:-1])
        self.rank = np.empty(n, np.int64)
        self.rank[order] = np.cumsum(new) - 1                               # of the places; a repeated row is no other line
        self.of_rank = order[np.flatnonzero(new)]
        self.best, self.count, self.found = np.full(n, 1 << 62), np.zeros(n, np.int64), np.zeros(n, bool)
        self.room = ((rows[3] >> 32) * ((100 - percent) / (100 + percent)) + 0.1).astype(np.float32)     # a line's part of the words by which similar sets differ

    def meet(self, i: np.ndarray, j: np.ndarray) -> None:
        s1 = self.rows[4]
        some = np.flatnonzero(np.bitwise_count((s1[i] ^ s1[j]).view(np.uint64)) <= self.room[i] + self.room[j])      # most pairs end here
        i, j = i[some], j[some]
        ok, apart = _may_be_similar(self.rows, i, j, self.percent)
        ok &= self.rank[i] != self.rank[j]
        i, j, apart = i[ok], j[ok], apart[ok]
        swap = self.rank[i] > self.rank[j]
        x, y = np.where(swap, j, i), np.where(swap, i, j)
        self.found[x] = self.found[y] = True
        np.minimum.at(self.best, y, apart << 32 | self.rank[x])
        np.add.at(self.count, y, 1)

    def batch(self, rows: np.ndarray, long: np.ndarray) -> pa.RecordBatch:
        none = (self.count == 0)[rows]
        x = self.of_rank[np.where(none, 0, self.best[rows] & 0xFFFFFFFF)]
        return as_batch(NEAR, np.full(len(rows), LINE), *(c[rows] for c in self.rows), *(pa.array(self.rows[c][x], mask=none) for c in (1, 2)), pa.array(self.best[rows] >> 32, mask=none), np.maximum(self.count[rows] - 1, 0), long)


def _compare_lists(rows: list, percent: int) -> _Nearest:
    """Whole lists, in order of word and size."""
    near = _Nearest(rows, percent)
    size = rows[3] >> 32
    number = np.cumsum(np.diff(rows[0], prepend=rows[0][0] - 1) != 0)
    last = np.searchsorted(number << 32 | size, number << 32 | 100 * size // percent, "right")      # behind the last that is not too large
    partners = last - np.arange(len(size)) - 1
    ends, at = np.cumsum(partners), 0
    while at < len(size):
        before = int(ends[at] - partners[at])
        to = max(at + 1, int(np.searchsorted(ends, before + SHORT * PIECE, "right")))
        n = partners[at:to]
        i = np.repeat(np.arange(at, to), n)
        near.meet(i, i + 1 + np.arange(len(i)) - np.repeat(ends[at:to] - n - before, n))
        at = to
    return near


def stream_lists(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``_lists`` of batches in order of word; a list that goes on is held up to LONG rows."""
    held = [np.zeros(0, np.int64)] * 6
    giant, heads = None, None                                               # the word of a longer list, and its lines to compare with
    for batch in chain(batches, [None]):
        rows = held if batch is None else [np.concatenate([a, c.to_numpy(zero_copy_only=False)]) for a, c in zip(held, batch.columns, strict=True)]
        held = [c[:0] for c in rows]
        gone = rows[3] == GONE
        if gone.any():
            yield _settled([c[gone] for c in rows])
            rows = [c[~gone] for c in rows]
        if giant is not None and len(rows[0]) and rows[0][0] == giant:
            n = int(np.searchsorted(rows[0], giant, "right"))
            yield from _giant([c[:n] for c in rows], heads, percent)
            rows = [c[n:] for c in rows]
        if not len(rows[0]):
            continue
        cut = len(rows[0]) if batch is None else int(np.searchsorted(rows[0], rows[0][-1]))
        if batch is not None and len(rows[0]) - cut > LONG:
            giant, heads = int(rows[0][-1]), _earliest([c[cut:] for c in rows])
            yield from _giant([c[cut:] for c in rows], heads, percent)
        else:
            held = [c[cut:].copy() for c in rows]
        rows = [c[:cut] for c in rows]
        sets = rows[3] == SET
        if sets.any():
            s = [c[sets] for c in rows]
            order = np.lexsort((s[2], s[1], s[4], s[0]))
            s = [c[order] for c in s]
            first = np.ones(len(order), bool)
            first[1:] = (s[0][1:] != s[0][:-1]) | (s[4][1:] != s[4][:-1])
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            again = (s[1] != s[1][lead]) | (s[2] != s[2][lead])
            yield _settled([c[again] for c in s])
            rows = [c[~sets] for c in rows]
        if len(rows[0]):
            order = np.lexsort((rows[3] >> 32, rows[0]))
            rows = [c[order] for c in rows]
            near = _compare_lists(rows, percent)
            some = np.flatnonzero(near.found)
            yield near.batch(some, np.zeros(len(some), bool))


def _settled(rows: list) -> pa.RecordBatch:
    n = len(rows[0])
    return as_batch(NEAR, np.full(n, SETTLED), *rows, *[pa.nulls(n, pa.int64())] * 3, np.zeros(n, np.int64), np.zeros(n, bool))


def _earliest(rows: list) -> list:
    lines = [c[rows[3] != SET] for c in rows]
    order = np.lexsort((lines[2], lines[1]))[:HEADS]
    return [c[order] for c in lines]


def _giant(rows: list, heads: list, percent: int) -> Iterator[pa.RecordBatch]:
    """Lines of a list that is too long for one task: each is held to the list's heads only. Rows of sets are handed on."""
    sets = rows[3] == SET
    if sets.any():
        s, n = [c[sets] for c in rows], int(sets.sum())
        yield as_batch(NEAR, np.full(n, OPEN_SET), *s, *[pa.nulls(n, pa.int64())] * 3, np.zeros(n, np.int64), np.zeros(n, bool))
        rows = [c[~sets] for c in rows]
    k = len(heads[0])
    for at in range(0, len(rows[0]), 4096):
        some = [np.concatenate([h, c[at : at + 4096]]) for h, c in zip(heads, rows, strict=True)]
        near = _Nearest(some, percent)
        n = len(some[0]) - k
        near.meet(np.tile(np.arange(k), n), np.repeat(np.arange(k, k + n), k))
        own = np.arange(k, k + n)
        yield near.batch(own, np.ones(n, bool))


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """Lines that are gone, as equal to earlier ones; and postings that may be similar to another of their word, and all of lists over LONG (``long``), with x_doc, x_place: of the
    earlier lines that one was held to the nearest, where there is one, how far ``apart`` it looks, and how many ``others`` there are."""
    run = lambda batches: stream_lists(batches, percent)
    return stage(postings.repartition("word").sortWithinPartitions("word").mapInArrow(run, "kind int, " + LISTED_SQL + ", x_doc long, x_place long, apart long, others long, long boolean"), "line-lists")


PAIR = ["x_doc", "x_place", "y_doc", "y_place"]


CELL_KEY = ["word", "xc", "yc"]
CELLED_SQL = LISTED_SQL + ", asks boolean, xc long, yc long"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One cell after another, of batches in order of the cells; a cell is of bounded size."""
    held = None
    for batch in chain(batches, [None]):
        rows = [t for t in (held, None if batch is None else pa.Table.from_batches([batch])) if t is not None]
        if not rows:
            continue
        rows = pa.concat_tables(rows)
        new = np.zeros(max(0, rows.num_rows - 1), bool)
        for c in CELL_KEY:
            new |= np.diff(rows.column(c).to_numpy()) != 0
        bounds = [0, *(np.flatnonzero(new) + 1).tolist(), rows.num_rows]
        held = rows.slice(bounds.pop(-2)) if batch is not None else None
        if held is not None:
            bounds[-1] -= held.num_rows
        yield from (rows.slice(a, b - a) for a, b in pairwise(bounds) if b > a)


def _partners(cell: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each line of a cell that asks, with the earlier members that the filters allow."""
    rows, asks = [cell.column(f.name).to_numpy() for f in LISTED], cell.column("asks").to_numpy()
    doc, place, members = rows[1], rows[2], np.flatnonzero(~asks)
    for j in np.flatnonzero(asks).tolist():
        i = members[(doc[members] < doc[j]) | ((doc[members] == doc[j]) & (place[members] < place[j]))]
        i = i[_may_be_similar(rows, i, np.full(len(i), j), percent)[0]]
        if len(i):
            yield j, i


def _others(lists: DataFrame, decided: DataFrame, tried: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """What the undecided lines are still to be verified with. Where a list has one earlier line that may be similar, it is known: pairs. Lists with several, and long ones, are
    dealt into cells of about CELL lines by CELL undecided lines, so that a long list has many tasks: the cells' rows that may be similar to another of their cell."""
    open_ = lists.join(decided, ["doc_id", "place"], "left_anti")
    known = open_.where("NOT long AND others = 0 AND x_doc IS NOT NULL").select("x_doc", "x_place", F.col("doc_id").alias("y_doc"), F.col("place").alias("y_place"))
    asks = stage(open_.where("long OR others > 0").select(*LISTED.names), "line-asks")
    members = stage(lists.select(*LISTED.names).join(asks.select("word").distinct(), "word", "left_semi"), "line-members")
    words = F.sum(F.shiftright("filters", 32))
    parts = lambda n, w: (1 + F.greatest(F.floor((F.col(n) - 1) / CELL), F.floor(F.col(w) / CELL_WORDS))).cast("long")
    cells = (members.groupBy("word").agg(F.count("*").alias("n"), words.alias("nw")).join(asks.groupBy("word").agg(F.count("*").alias("u"), words.alias("uw")), "word")
             .select("word", parts("n", "nw").alias("xs"), parts("u", "uw").alias("ys")))
    of = lambda rows: rows.join(cells, "word").withColumn("h", F.xxhash64("doc_id", "place"))
    series = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    x = of(members).withColumn("xc", F.pmod("h", "xs")).withColumn("yc", series("ys")).withColumn("asks", F.lit(False))
    y = of(asks).withColumn("yc", F.pmod("h", "ys")).withColumn("xc", series("xs")).withColumn("asks", F.lit(True))
    dealt = x.select(*LISTED.names, "asks", "xc", "yc").unionByName(y.select(*LISTED.names, "asks", "xc", "yc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, some = [], 0
        for cell in _cells(batches):
            keep = np.zeros(cell.num_rows, bool)
            for j, i in _partners(cell, percent):
                keep[j] = keep[i] = True
            if keep.any():
                out.append(cell.filter(pa.array(keep)))
                some += out[-1].num_rows
            if some > 10_000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, some = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    near = dealt.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(run, CELLED_SQL)
    return stage(known.distinct().join(tried, PAIR, "left_anti"), "line-pairs"), stage(near, "line-cells")


def _sets(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, place, words) of the lines at these places, each once; the words as text, which takes less room than their hashes."""
    per_row = stage(places.groupBy(F.col("doc_id").alias("_id"), F.shiftright("place", 32).cast("int").alias("_tag")).agg(F.collect_set(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")).alias("wanted")), "line-wanted")
    small = per_row.agg(F.coalesce(F.sum(F.size("wanted") + 4), F.lit(0))).first()[0] <= BROADCAST_IDS
    some = docs.join(F.broadcast(per_row) if small else per_row, (docs["doc_id"] == F.col("_id")) & (docs["tag"] == F.col("_tag"))).select("doc_id", "text", "tag", "wanted")
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, chars=2_000_000):
            wanted = [np.sort(w) for w in batch.column(3).to_pylist()]
            owner = np.repeat(np.arange(len(texts)), [len(w) for w in wanted])
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False)[owner] for i in (0, 2))
            found = []
            for text, some in zip(texts, wanted, strict=True):
                lines = text.encode("utf-8", "surrogatepass").lower().split(b"\n")
                found += [b" ".join(dict.fromkeys(lines[k].split())) for k in some.tolist()]
            yield as_batch(schema, doc, _places(tag, np.concatenate(wanted)), found)

    return stage(some.mapInArrow(run, "doc_id long, place long, words binary").dropDuplicates(["doc_id", "place"]), "line-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x_doc").alias("doc_id"), F.col("x_place").alias("place")).union(pairs.select("y_doc", "y_place"))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, place) of the later lines of the pairs that are similar."""
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            room = np.cumsum([len(x) + len(y) for x, y in zip(left, right, strict=True)]) // 2_000_000
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(room)) + 1).tolist(), batch.num_rows]):
                some = batch.slice(a, b - a)
                x, y = Lines(left[a:b]), Lines(right[a:b])                  # one line a row
                found = np.zeros(some.num_rows, bool)
                for k in range(some.num_rows):
                    both = np.sort(np.concatenate([s.words[s.starts[k] : s.starts[k] + s.sizes[k]] for s in (x, y)]))      # both have distinct words
                    found[k] = int((both[1:] == both[:-1]).sum()) >= overlap_needed(x.sizes[k], y.sizes[k], percent)
                yield as_batch(schema, *(some.column(i).to_numpy(zero_copy_only=False)[found] for i in (0, 1)))

    side = lambda s: sets.select(F.col("doc_id").alias(f"{s}_doc"), F.col("place").alias(f"{s}_place"), F.col("words").alias(f"{s}_words"))
    both = pairs.join(side("y"), ["y_doc", "y_place"]).join(side("x"), ["x_doc", "x_place"]).select("y_doc", "y_place", "x_words", "y_words")
    return stage(both.mapInArrow(run, "doc_id long, place long").distinct(), "line-similar")


def _similar_in_cells(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, place) of the asking lines of the cells that are similar to an earlier member; a cell's sets are compared where they meet, so no pair is written."""
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            lines = Lines(cell.column("words").to_pylist())                 # one line a row
            starts, sizes = lines.starts, lines.sizes
            known, ids = np.unique(lines.words, return_inverse=True)
            asked, found = np.zeros(len(known), bool), []
            for j, i in _partners(cell, percent):
                own = ids[starts[j] : starts[j] + sizes[j]]
                asked[own] = True
                both = np.add.reduceat(asked[ragged(ids, starts[i], sizes[i])], offsets_of(sizes[i])[:-1], dtype=np.int64)
                asked[own] = False
                if (both >= overlap_needed(sizes[i], sizes[j], percent)).any():
                    found.append(j)
            if found:
                yield as_batch(schema, *(cell.column(c).to_numpy()[found] for c in schema.names))

    met = near.join(sets, ["doc_id", "place"]).select(*LISTED.names, "asks", "xc", "yc", "words")
    return stage(met.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(run, "doc_id long, place long").distinct(), "line-similar")


def _gone(rows: DataFrame, percent: int) -> DataFrame:
    """(doc_id, place) of the lines that go, of rows with tags."""
    docs = rows.where("doc_id IS NOT NULL")
    levels = rows.sparkSession.sparkContext.broadcast(levels_of(_survey(docs)))        # 2^BUCKET_BITS bytes, whatever the corpus
    listed = _lists(_postings(docs, percent, levels), percent)
    open_sets = listed.where(F.col("kind") == OPEN_SET).select("word", "s1", "doc_id", "place")
    firsts = open_sets.groupBy("word", "s1").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    later = open_sets.join(firsts, ["word", "s1"]).where("struct(doc_id, place) > first").select("doc_id", "place")
    again = stage(listed.where(F.col("kind") == SETTLED).select("doc_id", "place").unionByName(later).distinct(), "line-again")
    lists = listed.where(F.col("kind") == LINE).drop("kind")
    nearest = (lists.where("x_doc IS NOT NULL").groupBy(F.col("doc_id").alias("y_doc"), F.col("place").alias("y_place")).agg(F.min(F.struct("apart", "x_doc", "x_place")).alias("x"))
               .join(again.select(F.col("doc_id").alias("y_doc"), F.col("place").alias("y_place")), ["y_doc", "y_place"], "left_anti"))
    tried = stage(nearest.select("x.x_doc", "x.x_place", "y_doc", "y_place"), "line-nearest")
    decided = again.unionByName(_similar(tried, _sets(docs, _ends(tried)), percent))
    known, near = _others(lists, decided, tried, percent)
    sets = _sets(docs, _ends(known).union(near.select("doc_id", "place")))
    return decided.unionByName(_similar(known, sets, percent)).unionByName(_similar_in_cells(near, sets, percent)).distinct()


def repeated_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, tag, line) of the lines that go; a line counts from 0 in its text, ``tag`` as in ``tagged``. See ``dedup_lines`` for the special cases."""
    return _gone(tagged(docs), percent).select("doc_id", F.shiftright("place", 32).cast("int").alias("tag"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("line"))


def _without(docs: DataFrame, percent: int) -> DataFrame:
    """``docs`` with ``_lines`` (all lines) and ``_left`` (those that stay)."""
    gone = stage(repeated_lines(docs, percent), "line-gone")
    per_doc = gone.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.collect_list("line").alias("_gone"))    # at most a document's lines
    per_doc = F.broadcast(per_doc) if gone.count() <= BROADCAST_IDS else per_doc
    same = (docs["doc_id"].cast("long") == F.col("_id")) & ((F.col("_tag") == 0) | (F.hash(docs["text"].cast("string")) == F.col("_tag")))
    joined = docs.join(per_doc, same, "left").withColumn("_lines", F.split(docs["text"].cast("string"), "\n"))
    return joined.withColumn("_left", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.filter("_lines", lambda x, i: ~F.array_contains("_gone", i))))


def dedup_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_lines, n_removed, text of each row, the text without the lines that go.

    Lines without words never go. Rows that share doc_id and text are one document; texts that share a doc_id only are
    in the order of their tags, and each loses its own lines. Rows without doc_id or text stay as they are and take no part.
    """
    return _without(doc_text(docs), percent).select("doc_id", F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).cast("long").alias("n_removed"), F.array_join("_left", "\n").alias("text"))


def with_lines_removed(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows with all their columns; ``text`` without the lines that go, and ``n_chars``, where there, its new length."""
    fixed = _without(docs, percent).withColumn("_text", F.when(F.col("_gone").isNull(), docs["text"]).otherwise(F.array_join("_left", "\n")))
    kinds = dict(docs.dtypes)
    out = {c: docs[c] for c in docs.columns} | {"text": F.col("_text").alias("text")}
    if "n_chars" in kinds:
        out["n_chars"] = F.when(F.col("_gone").isNull(), docs["n_chars"]).otherwise(F.length("_text")).cast(kinds["n_chars"]).alias("n_chars")
    return fixed.select(*out.values())
