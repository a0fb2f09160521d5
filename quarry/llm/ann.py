"""Nearest neighbours by inner product through a hierarchical k-means tree (operator 3).

The tree is fitted on a bounded sample; every vector is routed to a leaf. A query visits
leaves best-bin-first, through a priority queue over the tree's nodes. How many leaves it
visits is calibrated: for a sample of queries the true neighbours come from a scan of all vectors, and the
visits widen until their recall is reached.

Inner products become distances by one more component, sqrt(M^2 - |v|^2) with the longest vector's
length M; queries are scaled to length M and have 0 there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, stage

#: The tree is fitted on at most so many vectors, those with the least hash of their id; nodes have so many children, leaves so many sample vectors.
SAMPLE, BRANCHES, LEAF = 20_000, 8, 400
#: Recall that so many calibration queries have to reach.
RECALL, CALIBRATION = 0.95, 200
#: A cell holds about so many vectors of a leaf, and about so many of the queries that visit it.
CHUNK = 1024


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


class Tree:
    """Nodes in arrays: ``centres[i]`` are the children's centres, ``children[i]`` their nodes; a leaf has no children and a number."""

    def __init__(self, points: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 7):
        self.centres: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        self.number: list[int] = []
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self._grow(np.unique(points, axis=0), branches, leaf)

    def _grow(self, points: np.ndarray, branches: int, leaf: int) -> int:
        node = len(self.children)
        self.centres.append(None)
        self.children.append([])
        self.number.append(-1)
        groups, centres = ([], None) if len(points) <= leaf else self._split(points, branches)
        if len(groups) < 2:
            self.number[node] = self.leaves
            self.leaves += 1
        else:
            self.centres[node] = centres
            self.children[node] = [self._grow(g, branches, leaf) for g in groups]
        return node

    def _split(self, points: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        centres = points[self._random.choice(len(points), k, replace=False)]
        for _ in range(12):
            own = nearest(points, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, points)
            sizes = np.bincount(own, minlength=len(centres))
            centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        own = nearest(points, centres)
        used = np.unique(own)
        return [points[own == c] for c in used], centres[used]

    def route(self, points: np.ndarray) -> np.ndarray:
        """Each point's leaf."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.number[node]
            elif len(rows):
                own = nearest(points[rows], self.centres[node])
                todo += [(child, rows[own == c]) for c, child in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, the most promising first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.number[node]
                continue
            gaps = ((self.centres[node] - query) ** 2).sum(axis=1)
            for gap, child in zip(gaps.tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (gap, child))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.maximum(0.0, longest**2 - (vectors**2).sum(axis=1))
    return np.column_stack([vectors, np.sqrt(rest)])


def aimed(queries: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack([queries * (longest / np.sqrt((queries**2).sum(axis=1)))[:, None], np.zeros(len(queries))])


def top_products(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's k best, ties to smaller ids; a row's own id is left out.

    A matrix product finds the rows that may belong; their scores are then summed row by row, so that
    equal vectors have equal scores whatever block they came in.
    """
    rough = queries @ vectors.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    n = min(k, rough.shape[1])
    bar = np.partition(rough, rough.shape[1] - n, axis=1)[:, rough.shape[1] - n]
    slack = 1e-9 * (1e-300 + np.sqrt((queries**2).sum(axis=1)) * np.sqrt((vectors**2).sum(axis=1)).max())
    rows, columns = np.nonzero((rough >= (bar - slack)[:, None]) & (rough > -np.inf))
    scores = (queries[rows] * vectors[columns]).sum(axis=1)
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return rows[keep], columns[keep], scores[keep]


def floors(queries: np.ndarray, query_ids: np.ndarray, visited: list[list[int]], sample: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Each query's k-th best score among the sample's vectors in the leaves it visits, its own left out: the k-th it finds scores no less."""
    ids, points, leaf = sample
    out = np.full(len(queries), -np.inf)
    for at in range(0, len(queries), 128):
        scores = queries[at : at + 128] @ points.T
        scores[query_ids[at : at + 128][:, None] == ids[None, :]] = -np.inf
        for row, leaves in zip(scores, visited[at : at + 128], strict=True):
            row[~np.isin(leaf, leaves)] = -np.inf
        if scores.shape[1] > k:
            out[at : at + 128] = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return out


HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Brute force for a block of queries that fits a task's closure: every task keeps its own k best of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy()
                rows, columns, scores = top_products(queries, query_ids, matrix(batch.column(1)), ids, k)
                yield as_batch(HITS, query_ids[rows], ids[columns], scores)

    return _ranked(vectors.select("vec_id", "embedding").mapInArrow(scan, "query_id long, vec_id long, score double"), k)


def usable(embeddings: DataFrame) -> tuple[DataFrame, float]:
    """(vec_id, embedding) of the vectors that take part, and the longest one's length.

    Left out: null ids, null or zero vectors, null or non-finite components, and vectors whose number
    of components isn't the most frequent one (of equals the smaller).
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND abs(x) < double('infinity') AND NOT isnan(x)) AND exists(embedding, x -> x <> 0)")
    by_size = sound.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(embedding, 0D, (a, x) -> a + x * x)")).alias("longest"))
    most = by_size.orderBy(F.desc("n"), "size").limit(1).collect()
    if not most:
        return sound.limit(0), 1.0
    return sound.where(F.size("embedding") == most[0].size), float(np.sqrt(most[0].longest))


def search(embeddings: DataFrame, query_rows: str, k: int = 20, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every usable row that ``query_rows`` (a condition on vec_id) picks.

    Candidates are all usable rows but those with the query's own id. Queries that repeat an id count once (the least
    vector); candidates that repeat one are each reported. With at most k candidates, all are returned.
    """
    vectors, longest = usable(embeddings)
    some = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not some:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = np.array([r.embedding for r in some])
    tree = Tree(lifted(points, longest))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.route(lifted(matrix(batch.column(1)), longest)))], ["vec_id", "embedding", "leaf"])

    routed = stage(vectors.mapInArrow(route, "vec_id long, embedding array<double>, leaf int"), "ann-routed")
    sizes = {r.leaf: r["count"] for r in routed.groupBy("leaf").count().collect()}        # as many as the tree has leaves
    asked = routed.where(query_rows).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select(F.col("vec_id").alias("query_id"), "embedding")
    visits = _calibrate(routed, asked, tree, longest, k, recall)
    held = embeddings.sparkSession.sparkContext.broadcast((np.array([r.vec_id for r in some]), points, tree.route(lifted(points, longest))))    # the tree's sample

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves, queries = [], matrix(batch.column(1))
            for q in aimed(queries, longest):
                seen, rows = [], 0
                for leaf in tree.visit(q):
                    if len(seen) >= visits and rows > k:
                        break
                    seen.append(leaf)
                    rows += sizes.get(leaf, 0)
                leaves.append([x for x in seen if x in sizes])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32())), pa.array(floors(queries, batch.column(0).to_numpy(), leaves, held.value, k))], ["query_id", "embedding", "leaves", "floor"])

    walked = stage(asked.mapInArrow(walk, "query_id long, embedding array<double>, leaves array<int>, floor double"), "ann-visits")
    visitors = {r.leaf: r["count"] for r in walked.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()}
    spark = embeddings.sparkSession
    cells = spark.createDataFrame([(leaf, 1 + (n - 1) // CHUNK, 1 + (visitors[leaf] - 1) // CHUNK) for leaf, n in sizes.items() if leaf in visitors], "leaf int, chunks int, blocks int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (routed.join(F.broadcast(cells), "leaf").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int"))
            .select("leaf", "chunk", each("blocks").alias("block"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), F.lit(None).cast("double").alias("floor"), "embedding"))
    right = (walked.select("query_id", "embedding", "floor", F.explode("leaves").alias("leaf")).join(F.broadcast(cells), "leaf").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int"))
             .select("leaf", each("chunks").alias("chunk"), "block", F.lit(True).alias("asks"), F.col("query_id").alias("id"), "floor", "embedding"))

    def meet(cell: pa.Table) -> pa.Table:
        asks = cell.column("asks").to_numpy(zero_copy_only=False) if cell.num_rows else np.zeros(0, bool)
        ids, points = cell.column("id").to_numpy(), matrix(cell.column("embedding").combine_chunks())
        if not asks.any() or asks.all():
            return HITS.empty_table()
        rows, columns, scores = top_products(points[asks], ids[asks], points[~asks], ids[~asks], k)
        floor = cell.column("floor").to_numpy()[asks][rows]
        keep = scores >= floor - 1e-9 * (1 + np.abs(np.maximum(floor, -1e300)))       # what the sample already beats k times is no neighbour
        return pa.Table.from_batches([as_batch(HITS, ids[asks][rows][keep], ids[~asks][columns][keep], scores[keep])])

    hits = left.unionByName(right).groupBy("leaf", "chunk", "block").applyInArrow(meet, "query_id long, vec_id long, score double")
    return _ranked(hits, k)


def _calibrate(routed: DataFrame, asked: DataFrame, tree: Tree, longest: float, k: int, recall: float) -> int:
    """Leaves to visit so that the calibration queries find ``recall`` of their true neighbours; all leaves where no fewer do."""
    some = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).collect()
    if not some:
        return 1
    ids, queries = np.array([r.query_id for r in some]), np.array([r.embedding for r in some])
    truth = exact(routed, ids, queries, k)
    where = truth.join(routed.select("vec_id", "leaf").dropDuplicates(["vec_id"]), "vec_id").select("query_id", "leaf").collect()     # k rows a query
    order = {i: {leaf: place for place, leaf in enumerate(tree.visit(q))} for i, q in zip(ids.tolist(), aimed(queries, longest), strict=True)}
    places = np.array([order[r.query_id][r.leaf] for r in where])
    visits = 1
    while visits < tree.leaves and (places < visits).mean() < recall:
        visits += 1
    return visits
