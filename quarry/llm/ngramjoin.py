"""Exact Jaccard join of documents on word n-grams through prefix trees (operator 9).

Every document's n-gram set is put in one global order, rare n-grams first (by counts
of hashed buckets over all documents; any order gives the same links, this one gives short lists). Two
sets that link share an n-gram within their prefixes, at places that leave enough after it. The
documents of a prefix n-gram meet its most typical member first; what that links is joined into components, and
only pairs across components are looked at afterwards, so a family of near copies costs as many checks as it has
members, and no link between different components is missed. Checks store the candidates of a
document in a prefix tree and walk it with the document's set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_IDS, as_batch, doc_text, some_documents, stage, text_blocks
from quarry.llm.components import components
from quarry.llm.words import shingles_of

#: Counts of n-grams are kept in 2^BUCKET_BITS hashed buckets, dealt into blocks; noise only costs speed.
BUCKET_BITS, BLOCK_BITS = 22, 16
#: Candidates that one prefix tree holds, about.
TREE = 128


def overlap_needed(m, n, percent: int):
    """Least size of the intersection of sets of m and n that link: 100 i >= percent (m + n - i)."""
    return -(-(percent * (m + n)) // (100 + percent))


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """Rows of documents (doc_id, n_shingles, digest), and rows of bucket counts (block, task, counts)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("block", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << BUCKET_BITS, np.uint32), set()
        for batch, texts in text_blocks(batches):
            sizes, digests, fresh = [], [], []
            for grams in shingles_of(texts, size):
                digest = xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None
                sizes.append(len(grams))
                digests.append(digest)
                if len(grams) and digest not in seen:
                    seen.add(digest)
                    fresh.append(grams)
            if fresh:
                np.add.at(counts, (np.concatenate(fresh) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
            none = [None] * len(texts)
            yield as_batch(schema, batch.column(0), sizes, digests, none, none, none)
        if seen:
            blocks = np.minimum(counts, 65535).astype("<u2").reshape(-1, 1 << BLOCK_BITS)
            task = TaskContext.get().partitionId()
            none = [None] * len(blocks)
            yield as_batch(schema, none, none, none, list(range(len(blocks))), [task] * len(blocks), [zlib.compress(b.tobytes(), 1) for b in blocks])

    return stage(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, block int, task int, counts binary"), "ngram-survey")


def levels_of(survey: DataFrame) -> np.ndarray:
    """The buckets' counts over all documents, on a logarithmic scale; 2^BUCKET_BITS bytes."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK_BITS, np.uint64)
        for c in group.column("counts").to_pylist():
            raw = np.frombuffer(zlib.decompress(c), np.uint8)
            total += raw.view("<u2" if len(raw) == 2 << BLOCK_BITS else "<u8").astype(np.uint64)
        return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()), "task": pa.array([0], pa.int32()), "counts": pa.array([zlib.compress(total.astype("<u8").tobytes(), 1)], pa.binary())})

    kind = "block int, task int, counts binary"
    blocks = survey.where("block IS NOT NULL").select("block", F.pmod("task", F.lit(64)).alias("task"), "counts")
    rows = blocks.groupBy("block", "task").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind)
    levels = np.zeros(1 << BUCKET_BITS, np.uint8)
    for row in rows.toLocalIterator():                                     # one row a block
        total = np.frombuffer(zlib.decompress(row.counts), "<u8").astype(np.float64)
        levels[row.block << BLOCK_BITS : (row.block + 1) << BLOCK_BITS] = np.floor(4 * np.log2(np.maximum(total, 1))).astype(np.uint8)
    return levels


def _postings(docs: DataFrame, size: int, percent: int, levels) -> DataFrame:
    """(gram, doc_id, size, place) of every prefix; of equal sets in a task the first stands for all."""
    schema = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = levels.value, set()
        for batch, texts in text_blocks(batches, chars=1_000_000):
            parts, owners, sizes, places = [], [], [], []
            for doc_id, grams in zip(batch.column(0).to_pylist(), shingles_of(texts, size), strict=True):
                n = len(grams)
                if not n or (digest := xxhash.xxh3_128_digest(grams.tobytes())) in seen:
                    continue
                seen.add(digest)
                k = n - -(-percent * n // 100) + 1
                level = rank[(grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                parts.append(grams[np.argsort(level, kind="stable")[:k]])
                owners.append(doc_id)
                sizes.append(n)
                places.append(np.arange(k))
            if parts:
                lengths = np.fromiter(map(len, parts), np.int64, len(parts))
                yield as_batch(schema, np.concatenate(parts).view(np.int64), np.repeat(np.array(owners, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths), np.concatenate(places).astype(np.int32))

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "gram long, doc_id long, size int, place int")


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of equal first values, of batches sorted by it; runs of one row are left out."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate([a, b]) for a, b in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))                     # the last run may go on
        held = [c[cut:].copy() for c in now]
        now = [c[:cut] for c in now]
        if cut:
            yield _shared(now)
    if held is not None and len(held[0]):
        yield _shared(held)


def _shared(columns: list[np.ndarray]) -> list[np.ndarray]:
    first = columns[0]
    same = first[1:] == first[:-1]
    keep = np.zeros(len(first), bool)
    keep[1:] |= same
    keep[:-1] |= same
    return [c[keep] for c in columns]


def may_link(size_a, place_a, size_b, place_b, percent: int) -> np.ndarray:
    """The length filter, and the positional one: what follows the shared n-gram suffices."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    return (100 * small >= percent * large) & (np.minimum(size_a - place_a, size_b - place_b) >= overlap_needed(size_a + 0, size_b + 0, percent))


SHARED = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("place", pa.int32()), ("members", pa.int32()), ("centre", pa.int64())])


#: Lists up to this long are looked through for members that may link with none of the others.
SHORT = 64


def _has_partner(gram, doc, size, place, members, percent: int) -> np.ndarray:
    """Rows that may link with another of their run; all rows of long runs."""
    found = members > SHORT
    rows = np.flatnonzero(~found)
    for step in range(1, SHORT):
        rows = rows[rows + step < len(gram)]
        rows = rows[gram[rows] == gram[rows + step]]
        if not len(rows):
            break
        ok = (doc[rows] != doc[rows + step]) & may_link(size[rows], place[rows], size[rows + step], place[rows + step], percent)
        found[rows[ok]] = True
        found[rows[ok] + step] = True
    return found


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of n-grams with several documents, without those that may link with none of them; ``centre`` is the list's most typical member (the least place) where the two may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, doc, size, place in runs_of(batches):
            if not len(gram):
                continue
            order = np.lexsort((doc, place, gram))
            gram, doc, size, place = gram[order], doc[order], size[order], place[order]
            head = np.flatnonzero(np.diff(gram, prepend=gram[0] - 1))
            members = np.diff(head, append=len(gram))
            at = np.repeat(head, members)
            ok = (doc != doc[at]) & may_link(size.astype(np.int64), place, size[at].astype(np.int64), place[at], percent)
            members = np.repeat(members, members)
            keep = ok | (members > 2) & _has_partner(gram, doc, size.astype(np.int64), place, members, percent)
            yield as_batch(SHARED, gram[keep], doc[keep], size[keep], place[keep], members[keep].astype(np.int32), pa.array(doc[at][keep], mask=~ok[keep]))

    return stage(postings.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "gram long, doc_id long, size int, place int, members int, centre long"), "ngram-lists")


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _across(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of a list's members in different components that may link; lists of two were settled with their centre."""
    named = lists.where("members > 2").join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("gram", "doc_id", "size", "place", F.coalesce("component", "doc_id").alias("component"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, doc, size, place, component in runs_of(batches):
            done = np.zeros((0, 2), np.int64)
            for rows in np.split(np.arange(len(gram)), np.flatnonzero(np.diff(gram)) + 1):
                if len(rows) < 2 or (component[rows] == component[rows[0]]).all():
                    continue
                rows = rows[np.argsort(size[rows], kind="stable")]
                sizes = size[rows].astype(np.int64)
                for i in range(len(rows) - 1):                              # partners no longer than the length filter allows
                    end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))
                    other = rows[i + 1 : end]
                    a = rows[i]
                    other = other[(component[other] != component[a]) & (doc[other] != doc[a])]
                    other = other[may_link(np.int64(size[a]), place[a], size[other].astype(np.int64), place[other], percent)]
                    if len(other):
                        done = np.concatenate([done, np.column_stack([np.minimum(doc[a], doc[other]), np.maximum(doc[a], doc[other])])])
                        if len(done) > 1_000_000:
                            done = np.unique(done, axis=0)
                            yield as_batch(PAIRS, done[:, 0], done[:, 1])
                            done = done[:0]
            if len(done):
                done = np.unique(done, axis=0)
                yield as_batch(PAIRS, done[:, 0], done[:, 1])

    return named.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "a long, b long").distinct()


def tree_join(probe: np.ndarray, sets: list[np.ndarray], percent: int, levels: np.ndarray) -> list[int]:
    """Which of ``sets`` link with ``probe`` (all sorted arrays of distinct hashes); paths of the tree follow the global order,
    from the common n-grams (by ``levels`` of their buckets) to the rare ones, so that they are shared for long."""
    values = np.unique(np.concatenate([probe, *sets]))
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -levels[(values >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.int64)))] = np.arange(len(values))
    ordered = [np.sort(rank[np.searchsorted(values, s)]) for s in sets]
    inside = np.zeros(len(values) + 1, np.int64)
    inside[rank[np.searchsorted(values, probe)]] = 1
    left = np.concatenate([np.cumsum(inside[::-1])[::-1], [0]])             # how many of probe's come from a rank on
    order = sorted(range(len(sets)), key=lambda k: ordered[k].tolist())
    lengths = np.array([len(ordered[k]) for k in order])
    linked: list[int] = []
    todo = [(0, len(order), 0, 0)]
    while todo:                                                              # a node: the sets lo..hi, alike in their first `depth` n-grams
        lo, hi, depth, overlap = todo.pop()
        first, last = ordered[order[lo]], ordered[order[hi - 1]]
        n = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:n] != last[depth:n])
        end = depth + int(differ[0]) if len(differ) else n
        overlap += int(inside[first[depth:end]].sum())
        rest = int(left[first[end - 1] + 1]) if end else int(left[0])
        least, most = int(lengths[lo:hi].min()), int(lengths[lo:hi].max())
        if overlap + min(rest, most - end) < overlap_needed(len(probe), least, percent):
            continue
        while lo < hi and lengths[lo] == end:                                # sets that end here
            if overlap >= overlap_needed(len(probe), end, percent):
                linked.append(order[lo])
            lo += 1
        while lo < hi:
            symbol = ordered[order[lo]][end]
            stop = lo + 1
            while stop < hi and ordered[order[stop]][end] == symbol:
                stop += 1
            todo.append((lo, stop, end, overlap))
            lo = stop
    return linked


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, levels) -> DataFrame:
    """The pairs (a, b) that link."""
    pairs = stage(pairs, "ngram-pairs")
    texts = stage(some_documents(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()), "ngram-texts")
    trees = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", (1 + F.floor((F.col("n") - 1) / TREE)).cast("int").alias("trees"))
    stored = pairs.join(trees, "a").select("a", F.pmod(F.xxhash64("b"), "trees").cast("int").alias("tree"), F.col("b").alias("doc_id")).join(texts, "doc_id").select("a", "tree", "doc_id", "text", F.lit(False).alias("probes"))
    probes = trees.join(texts, trees["a"] == texts["doc_id"]).select("a", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"), "doc_id", "text", F.lit(True).alias("probes"))

    def run(group: pa.Table) -> pa.Table:
        flags, docs = group.column("probes").to_pylist(), group.column("doc_id").to_pylist()
        sets = shingles_of(group.column("text").to_pylist(), size)
        kept = [k for k, f in enumerate(flags) if not f and len(sets[k])]
        out = set()
        for k, f in enumerate(flags):
            if f and kept and len(sets[k]):
                out |= {(docs[k], docs[kept[j]]) for j in tree_join(sets[k], [sets[j] for j in kept], percent, levels.value)}
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return stage(stored.unionByName(probes).groupBy("a", "tree").applyInArrow(run, "a long, b long"), "ngram-links")


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id of each row.

    Documents link where 100 * intersection >= percent * union of their n-gram sets. Rows without
    words (null texts too) have 0 and are a component of their own. Rows that share a doc_id are one document, so they
    share its component. A row without doc_id has a null component and links with nothing.
    """
    spark = docs.sparkSession
    docs = doc_text(docs)
    survey = _survey(docs, size)
    rows = survey.where("block IS NULL").select("doc_id", "n_shingles", "digest")
    levels = spark.sparkContext.broadcast(levels_of(survey))
    lists = _lists(_postings(docs, size, percent, levels), percent)
    first = lists.where("centre IS NOT NULL").select(F.least("centre", "doc_id").alias("a"), F.greatest("centre", "doc_id").alias("b")).distinct()
    # the centre of a list is the side with many partners: it probes
    hubs = lists.where("centre IS NOT NULL").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = _verified(hubs, docs, size, percent, levels)
    labels = components(links)
    rest = _across(lists, labels, percent).join(first, ["a", "b"], "left_anti")
    links = links.unionByName(_verified(rest, docs, size, percent, levels))
    least = stage(rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "ngram-copies")
    known = stage(rows.join(least, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "ngram-classes")
    of = known.where("doc_id IS NOT NULL").select("doc_id", "rep").distinct()
    several = of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    between = (links.join(of.select(F.col("doc_id").alias("a"), F.col("rep").alias("_a")), "a").join(of.select(F.col("doc_id").alias("b"), F.col("rep").alias("_b")), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
               .unionByName(several.select("doc_id", "a").join(of, "doc_id").select("a", F.col("rep").alias("b"))))
    joined = components(between.distinct())
    return known.join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def _few(ids: DataFrame) -> DataFrame:
    """Staged ids to join the texts with: the texts are shuffled only where these are too many for a broadcast."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def keep_one(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of one document of each component, the one with the least doc_id, with all their columns.

    Of rows that share a doc_id the one with the least text stays; rows without doc_id stay.
    """
    found = stage(similar_documents(docs, size, percent).where("doc_id IS NOT NULL"), "ngram-found")
    gone = _few(stage(found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "ngram-gone"))
    twice = _few(stage(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_twice")), "ngram-twice"))
    key = docs["doc_id"].cast("long")
    left = docs.join(gone, key == gone["_gone"], "left_anti")
    repeated = left.join(twice, left["doc_id"].cast("long") == twice["_twice"], "left_semi")
    one = repeated.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where("_k = 1").select(*[repeated[c] for c in docs.columns])
    return left.join(twice, left["doc_id"].cast("long") == twice["_twice"], "left_anti").unionAll(one)
