"""Vector code compression: product codes by a dual-tree Lloyd iteration (operator 12).

Vectors become integers and are cut into four parts; each part has a codebook of 256 entries. A kd-tree over
a block's parts meets a kd-tree over the entries: for a pair of nodes, the boxes bound every distance between them
from below and above, and a pair whose least distance is over another pair's greatest goes. Against single
entries a box is also held to the plane between two entries. What is left with one entry takes it as a whole, by the node's
cached sum; leaves that keep several are compared part by part, in integers. All bounds are integers too, so the
result is that of the plain iteration.

The blocks with their trees are written once. A round is one pass that adds up sums in each task, then in Spark;
the driver sees the sums of the entries (at most 4 x 256 rows) and nothing that grows with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, column_or_null, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block, which share a tree, and points of a leaf at most.
BLOCK, LEAF = 4096, 32


def part_bounds(width: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Consecutive parts; where the width does not divide, the first ones are longer by one."""
    ends = np.cumsum([width // parts + (i < width % parts) for i in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def largest(width: int) -> int:
    """Integers stay under this, so that sums of squared differences fit in 64 bits."""
    return 1 << ((58 - max(1, width).bit_length()) // 2 - 1)


def integers(vectors: np.ndarray) -> np.ndarray:
    top = largest(vectors.shape[1])
    return np.clip(np.floor(vectors * SCALE), -top, top).astype(np.int64)


class KdTree:
    """A balanced tree: level ``l`` has 2^l nodes, node ``k`` holds ``order[bounds[l][k]:bounds[l][k + 1]]``; boxes, sums and sizes of all nodes."""

    def __init__(self, points: np.ndarray, leaf: int, order: np.ndarray | None = None):
        n = len(points)
        self.depth = max(0, (n // leaf).bit_length() - 1) if n > leaf else 0
        self.bounds = [np.array([0, n])]
        for _ in range(self.depth):
            b = self.bounds[-1]
            out = np.zeros(2 * len(b) - 1, np.int64)
            out[::2], out[1::2] = b, (b[:-1] + b[1:]) // 2
            self.bounds.append(out)
        self.order = self._split(points) if order is None else order
        self.points = points[self.order]
        starts = self.bounds[-1][:-1]
        low, high, total = ([f.reduceat(self.points, starts, axis=0)] for f in (np.minimum, np.maximum, np.add))
        for _ in range(self.depth):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            total.insert(0, total[0][::2] + total[0][1::2])
        self.low, self.high, self.total = low, high, total
        self.size = [np.diff(b) for b in self.bounds]

    def _split(self, points: np.ndarray) -> np.ndarray:
        order = np.arange(len(points))
        for level in range(self.depth):
            for a, m, b in zip(self.bounds[level][:-1].tolist(), self.bounds[level + 1][1::2].tolist(), self.bounds[level][1:].tolist(), strict=True):
                own = points[order[a:b]]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                order[a:b] = order[a:b][np.argpartition(own[:, widest], m - a)]
        return order


def _least_per(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, owner, values)
    return out


def _beaten(tree: KdTree, level: int, node: np.ndarray, entry: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Pairs whose entry is, for every point of the node's box, behind the entry nearest to the box's middle."""
    low, high = tree.low[level][node], tree.high[level][node]
    middle = ((low + high - 2 * entries[entry]) ** 2).sum(axis=1)
    order = np.lexsort((entry, middle, node))
    first = order[np.flatnonzero(np.diff(node[order], prepend=-1))]
    champion = np.zeros(len(tree.size[level]), np.int64)
    champion[node[first]] = entry[first]
    c = champion[node]
    apart = entries[entry] - entries[c]
    squares = (entries**2).sum(axis=1)
    margin = squares[entry] - squares[c] - 2 * (np.where(apart > 0, high, low) * apart).sum(axis=1)      # the least of |x - e|^2 - |x - c|^2
    return (margin > 0) | ((margin == 0) & (c < entry))


def _compare(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of the nearest entry, the lowest of equals; doubles hold these integers exactly, else 64-bit integers are used."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 3 * points.shape[1] * top * top < 1 << 53:
        e = entries.astype(np.float64)
        return np.argmin((e * e).sum(axis=1) - 2 * (points.astype(np.float64) @ e.T), axis=1)
    return np.argmin(np.stack([((points - e) ** 2).sum(axis=1) for e in entries], axis=1), axis=1)


def assign(tree: KdTree, entries: np.ndarray) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """(whole nodes as (level, nodes, entries), places in ``tree.order`` of the other points, their entries)."""
    over = KdTree(entries, 1)
    whole = []
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level = above = 0
    single = False
    while True:
        if single:
            low = high = entries[other]
        else:
            low, high = over.low[above][other], over.high[above][other]
        p_low, p_high = tree.low[level][node], tree.high[level][node]
        gap = np.maximum(np.maximum(low - p_high, p_low - high), 0)
        nearest = (gap * gap).sum(axis=1)
        reach = np.maximum(high - p_low, p_high - low)
        farthest = (reach * reach).sum(axis=1)
        keep = nearest <= _least_per(farthest, node, len(tree.size[level]))[node]
        node, other = node[keep], other[keep]
        if single:
            keep = ~_beaten(tree, level, node, other, entries)
            node, other = node[keep], other[keep]
            alone = np.bincount(node, minlength=len(tree.size[level]))[node] == 1
            whole.append((level, node[alone], other[alone]))
            node, other = node[~alone], other[~alone]
            if level == tree.depth or not len(node):
                break
        if level < tree.depth:
            node, other, level = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other]), level + 1
        if not single:
            if above < over.depth:
                node, other, above = np.concatenate([node, node]), np.concatenate([2 * other, 2 * other + 1]), above + 1
            else:
                sizes = over.size[above][other]
                firsts = over.bounds[above][other]
                at = np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                node, other, single = np.repeat(node, sizes), over.order[at], True
    places, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = np.lexsort((other, node))
    node, other = node[order], other[order]
    for rows in np.split(np.arange(len(node)), np.flatnonzero(np.diff(node)) + 1):
        if len(rows):
            a, b = tree.bounds[level][node[rows[0]] : node[rows[0]] + 2]
            places.append(np.arange(a, b))
            codes.append(other[rows][_compare(tree.points[a:b], entries[other[rows]])])
    return whole, np.concatenate(places), np.concatenate(codes)


def _codes(tree: KdTree, entries: np.ndarray) -> np.ndarray:
    """The entry of every point, in the points' own order."""
    whole, places, own = assign(tree, entries)
    out = np.zeros(len(tree.order), np.int64)
    out[tree.order[places]] = own
    for level, nodes, codes in whole:
        for node, code in zip(nodes.tolist(), codes.tolist(), strict=True):
            a, b = tree.bounds[level][node : node + 2]
            out[tree.order[a:b]] = code
    return out


def _add_sums(tree: KdTree, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    whole, places, own = assign(tree, entries)
    np.add.at(sums, own, tree.points[places])
    counts += np.bincount(own, minlength=len(counts))
    for level, nodes, codes in whole:
        np.add.at(sums, codes, tree.total[level][nodes])
        np.add.at(counts, codes, tree.size[level][nodes])


BLOCKS = pa.schema([("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())), ("data", pa.binary()), ("orders", pa.binary())])


def _blocks(rows: DataFrame, width: int) -> DataFrame:
    """Blocks of vectors as integers, with the order of their points in each part's tree."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                data = integers(some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                orders = [KdTree(data[:, a:b], LEAF).order if b > a else np.arange(len(data)) for a, b in part_bounds(width)]
                ends = pa.array([0, some.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays([some.column(i)])) for i in (0, 1)]
                yield as_batch(BLOCKS, *lists, [data.astype("<i4").tobytes()], [np.concatenate(orders).astype("<i4").tobytes()])

    return stage(rows.mapInArrow(build, "vec_id array<long>, label array<string>, data binary, orders binary"), "vector-blocks")


def _trees(data: bytes, orders: bytes, width: int) -> Iterator[tuple[int, KdTree | None]]:
    points = np.frombuffer(data, "<i4").reshape(-1, width).astype(np.int64)
    order = np.frombuffer(orders, "<i4").reshape(PARTS, -1)
    for part, (a, b) in enumerate(part_bounds(width)):
        yield part, KdTree(points[:, a:b], LEAF, order[part]) if b > a else None


def _round(blocks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one assignment and update."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for data, orders in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part, tree in _trees(data, orders, width):
                    if tree:
                        _add_sums(tree, books[part], sums[part], counts[part])
        for part, n in enumerate(counts):
            used = np.flatnonzero(n)
            if len(used):
                yield as_batch(schema, [part] * len(used), used, n[used], sums[part][used].tolist())

    widest = max(b - a for a, b in part_bounds(width))
    found = blocks.select("data", "orders").mapInArrow(add, "part int, entry int, n long, sums array<long>")
    total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(widest)])
    books = [b.copy() for b in books]
    for row in total.collect():                                             # at most PARTS x ENTRIES rows
        book = books[row.part]
        book[row.entry] = [int(row[f"s{i}"]) // row.n for i in range(book.shape[1])]
    return books


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of each vector that takes part, the codebooks by part).

    Vectors that are null, empty or hold null or non-finite components are dropped, and so are those of another
    length than the vector of the least vec_id. Components are held to integers that keep squared distances within 64 bits (up to
    +-2^25 for 64 components, +-32,768 before scaling). Rows of equal vec_id stand in the order of their vectors, null vec_ids last;
    fewer than 256 vectors make smaller codebooks; an empty table gives an empty result; a missing label column counts as null.
    """
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), column_or_null(embeddings, "label", "string").alias("label"), embeddings["embedding"].cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), [np.zeros((0, 0), np.int64)] * PARTS
    width = len(first[0].vector)
    rows = rows.where(F.size("vector") == width)
    starts = integers(np.array([r.vector for r in rows.orderBy(*order).limit(ENTRIES).collect()]))
    books = [starts[:, a:b] for a, b in part_bounds(width)]
    blocks = _blocks(rows, width)
    for _ in range(rounds):
        books = _round(blocks, books, width)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (data, orders) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                n = len(batch.column(0)[i])
                codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for part, tree in _trees(data, orders, width):
                    if tree:
                        codes[:, part] = own = _codes(tree, books[part])
                        error[tree.order] += ((tree.points - books[part][own[tree.order]]) ** 2).sum(axis=1)
                yield as_batch(schema, batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten(), [c.tobytes().hex() for c in codes], error)

    return stage(blocks.mapInArrow(finish, "vec_id long, label string, code string, error long"), "vector-codes"), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (null labels together), codebooks_sha256; special cases as in ``compress``."""
    codes, books = compress(embeddings)
    totals = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(totals, codes["label"].eqNullSafe(totals["_label"])).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
