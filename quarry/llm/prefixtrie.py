"""Conversation prefix trie by truncation peeling (operator 13).

A prefix of a rebuilt conversation is named by 128 bits: the exclusive or of its turns' digests, each taken with the turn's
depth. So the name of what is left when the last turn is stripped is one step away, and names of prefixes come from a running window
that reads digests, never texts.

Conversations of one whole sequence are merged first; the digest of their ids is made from ranges of (sequence, id), so that a
large group is sorted and written out by many tasks. Levels are then peeled from the deepest on: nodes of a level are the
conversations that end there and the stripped nodes of the level below, regrouped; what they add up is complete when their level is reached.
A tail that no other sequence shares is one chain, so it is peeled at once; the number of steps is the depth to
which sequences are shared, not that of the longest conversation. Each level is written before the next one reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, column_or_null, crc_mod, stage

#: Bytes of ids that a row of a large group holds.
BLOB = 16_384
#: How many conversations share a base, and the modulus of the number of turns taken from it.
SIBLINGS, HEADS = 5, 9
KEY = ["depth", "x1", "x2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, k (place among the conversation's turns, from 0), h1, h2 (digest of role and text), bytes (of the text)."""
    role, text = (F.coalesce(column_or_null(conversations, c, "string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), column_or_null(conversations, "turn", "long").alias("turn"),
                                F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"), F.octet_length(text).cast("long").alias("bytes")).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "bytes", "h1", "h2")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("k"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, k, h1, h2, bytes) of the rebuilt conversations' turns, in the order of (part, k); and their conv_ids."""
    ids = turns.where("k = 0").select("conv_id")                            # every conversation has one
    taken = lambda c: crc_mod(c, HEADS)
    base = turns.where((F.pmod("conv_id", F.lit(SIBLINGS)) == 0) & (F.col("k") < HEADS - 1))
    heads = (base.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(SIBLINGS - 1)), lambda i: F.try_add("conv_id", i))).alias("conv_id"), F.lit(0).alias("part"), "k", "h1", "h2", "bytes")
             .where(F.col("k") < taken(F.col("conv_id"))).join(ids, "conv_id", "left_semi"))
    tails = turns.where(F.col("k") >= taken(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "k", "h1", "h2", "bytes")
    return heads.unionByName(tails), ids


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, x1, x2 (name of the first ``depth`` turns), f1, f2 (what its last turn adds to the name), bytes (of that turn's text), before (bytes of the turns before it)."""
    order = Window.partitionBy("conv_id").orderBy("part", "k")
    placed = turns.withColumn("depth", F.row_number().over(order).cast("long"))
    placed = placed.withColumn("f1", F.xxhash64(F.lit(3), "depth", "h1", "h2")).withColumn("f2", F.xxhash64(F.lit(4), "depth", "h1", "h2"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select("conv_id", "depth", F.bit_xor("f1").over(so_far).alias("x1"), F.bit_xor("f2").over(so_far).alias("x2"), "f1", "f2", "bytes",
                         (F.sum("bytes").over(so_far) - F.col("bytes")).alias("before"))


ENDS = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("sha", pa.string()), ("blob", pa.binary())])
ENDS_SQL = "depth long, x1 long, x2 long, conv_id long, n_convs long, sha string, blob binary"


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows as tuples, batch by batch."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


def sequences(ends: DataFrame) -> DataFrame:
    """depth, x1, x2, conv_id (the least), n_convs, sha (of the ascending ids) of every distinct whole sequence.

    Tasks hold ranges of (sequence, id). A sequence within one of them is done there; the first and the last of a range, and long ones, hand
    on pieces of their text of ids, which one task per sequence digests in order: the digest is sequential, its input is not.
    """
    def piecewise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, ids, whole = [], None, [], False

        def close(done: bool) -> None:
            nonlocal ids
            text = ",".join(map(str, ids)).encode()
            out.append((*key, ids[0], len(ids), hashlib.sha256(text).hexdigest() if done else None, None if done else text))
            ids = []

        for depth, x1, x2, conv_id in _runs(batches, [*KEY, "conv_id"]):
            if (depth, x1, x2) != key:
                if key is not None:
                    close(whole)
                whole = key is not None                                     # the first of the range may have begun before it
                key = (depth, x1, x2)
            elif len(ids) * 8 >= BLOB:
                close(False)
                whole = False
            ids.append(conv_id)
            if len(out) >= 2_000:
                yield as_batch(ENDS, *zip(*out, strict=True))
                out = []
        if ids:
            close(False)
        if out:
            yield as_batch(ENDS, *zip(*out, strict=True))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, digest = [], None, None
        for depth, x1, x2, conv_id, n, blob in _runs(batches, [*KEY, "conv_id", "n_convs", "blob"]):
            if (depth, x1, x2) == key:
                digest.update(b",")
                total += n
            else:
                if key is not None:
                    out.append((*key, first, total, digest.hexdigest(), None))
                key, digest, first, total = (depth, x1, x2), hashlib.sha256(), conv_id, n
            digest.update(blob)
            if len(out) >= 2_000:
                yield as_batch(ENDS, *zip(*out, strict=True))
                out = []
        if key is not None:
            out.append((*key, first, total, digest.hexdigest(), None))
        if out:
            yield as_batch(ENDS, *zip(*out, strict=True))

    order = [*KEY, "conv_id"]
    pieces = stage(ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(piecewise, ENDS_SQL), "trie-ends")
    open_ = pieces.where("sha IS NULL").repartition(*KEY).sortWithinPartitions(*order).mapInArrow(joined, ENDS_SQL)
    return stage(pieces.where("sha IS NOT NULL").unionByName(open_).drop("blob"), "trie-sequences")


def _grouped(rows: DataFrame) -> DataFrame:
    """Nodes of one level from what reaches them: (x1, x2, conv_id, n_convs, child, leaves, saved, sha)."""
    return rows.groupBy("x1", "x2").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
                                        F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved"), F.max("sha").alias("sha"))


def peel(paths: DataFrame, whole: DataFrame) -> DataFrame:
    """All nodes, from ``prefixes`` and ``sequences``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = paths.sparkSession
    whole = whole.select("conv_id", F.col("depth").alias("length"), F.col("x1").alias("e1"), F.col("x2").alias("e2"), "n_convs", "sha")
    own = stage(paths.join(whole.select("conv_id"), "conv_id", "left_semi").sortWithinPartitions("depth"), "trie-paths")     # one conversation for each sequence
    shared = own.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    known = own.join(shared, KEY).groupBy("conv_id").agg(F.max("depth").alias("fork"))                                        # a sequence is shared down to there
    whole = whole.join(known, "conv_id", "left").withColumn("fork", F.coalesce("fork", F.lit(0).cast("long")))
    placed = own.join(whole, "conv_id")
    total = stage(placed.withColumn("below", F.max(F.struct("depth", F.expr("before + bytes").alias("b"))).over(Window.partitionBy("conv_id"))["b"]), "trie-placed")

    chains = total.where("depth > fork").select("conv_id", "depth", "n_convs", "fork", F.expr("x1 ^ f1").alias("p1"), F.expr("x2 ^ f2").alias("p2"),
                                                (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                                                F.expr("(n_convs - 1) * (below - before)").alias("saved"), F.when(F.expr("depth = length"), F.col("sha")).alias("sha"))
    tops = chains.where("depth = fork + 1").select(F.col("fork").alias("level"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), "conv_id", "n_convs",
                                                   F.lit(1).cast("long").alias("child"), F.lit(1).cast("long").alias("leaves"), "saved", F.lit(None).cast("string").alias("sha"))
    ended = whole.where("length = fork").select(F.col("length").alias("level"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv_id", "n_convs",
                                                F.lit(0).cast("long").alias("child"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "sha")
    reach = stage(tops.unionByName(ended).sortWithinPartitions("level"), "trie-entries")
    top = reach.agg(F.max("level")).first()[0]
    strip = total.select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), "f1", "f2", "bytes")

    levels: list[DataFrame] = []
    stripped: DataFrame | None = None
    for depth in range(-1 if top is None else top, -1, -1):
        rows = reach.where(F.col("level") == depth).drop("level")
        nodes = _grouped(rows if stripped is None else rows.unionByName(stripped))
        if depth:
            last = strip.where(F.col("_d") == depth)
            nodes = nodes.join(last, nodes["conv_id"] == last["_c"]).select(
                "x1", "x2", "conv_id", "n_convs", "n_children", "n_leaves", F.expr("saved + (n_convs - 1) * bytes").alias("saved"), "sha", F.expr("x1 ^ f1").alias("p1"), F.expr("x2 ^ f2").alias("p2"))
        else:
            nodes = nodes.withColumn("p1", F.lit(None).cast("long")).withColumn("p2", F.lit(None).cast("long"))
        nodes = stage(nodes.withColumn("depth", F.lit(depth).cast("long")), f"trie-level-{depth}")
        stripped = nodes.select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), "conv_id", "n_convs", F.lit(1).cast("long").alias("child"),
                                F.col("n_leaves").alias("leaves"), "saved", F.lit(None).cast("string").alias("sha"))
        levels.append(nodes)

    kept = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "sha", "p1", "p2"]
    lone = chains.where("depth > fork + 1").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *kept[2:7])
    if not levels:                                                          # no conversation at all
        return _named(lone)
    # the levels are read as one table, from the folders they were written to
    peeled = spark.read.schema(levels[0].schema).parquet(*[f for n in levels for f in n.inputFiles()])
    parents = peeled.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    joined = peeled.select(*kept).unionByName(chains.where("depth = fork + 1").select(*kept)).join(parents, ["depth", "p1", "p2"], "left")
    return _named(lone.unionByName(joined.select("conv_id", "depth", "parent_conv_id", *kept[2:7])))


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row a node; see ``peel`` for the columns.

    Rows without conv_id belong to no conversation; a null role or text is empty; a null turn comes first, and turns of one number
    stand in the order of their texts' lengths, then of their digests; a repeated row is a turn of its own; missing columns
    count as null and others are not read; an empty table gives no node.
    """
    turns = stage(turn_digests(conversations), "trie-turns")
    rows, ids = rebuilt(turns)
    paths = stage(prefixes(rows), "trie-prefixes")
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last"))
    ends = stage(ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"last.{c}", F.lit(0).cast("long")).alias(c) for c in KEY]), "trie-last")
    return peel(paths, sequences(ends))
