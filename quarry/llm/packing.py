"""Best-fit packing by bin completion (operator 2).

All pieces of one length are alike, so the packing is found on the counts of lengths (at most
``capacity`` numbers, whatever the corpus): a packing is a list of fillings, each with
how often it is used. The documents then meet the fillings in Spark by their rank within
their length; ranks come from counts of salted length groups, so no group is whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, crc_of_ids, doc_text, stage, text_blocks
from quarry.llm.subwords import LibraryEncoder

#: Parts that each length's group is dealt into.
SALTS = 256
#: Steps that the search for a packing may take.
NODES = 20_000
END = object()
Filling = tuple[tuple[int, int], ...]      # (length, how many), longest first


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Martello and Toth's bound L2: no packing has fewer bins."""
    sizes = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    a = np.arange(half + 1)
    large = number[capacity] - number[capacity - a]                         # longer than capacity - a
    middle = number[capacity - a] - number[half]
    room = middle * capacity - (total[capacity - a] - total[half])
    small = total[half] - np.where(a > 0, total[np.maximum(a - 1, 0)], 0)
    return int(max(-(-int(total[capacity]) // capacity), (large + middle + np.maximum(0, -(-(small - room) // capacity))).max()))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on counts: bins of one content move together."""
    bins: list[dict[Filling, int]] = [{} for _ in range(capacity + 1)]    # by room left: content -> how many bins
    bins[capacity][()] = int(counts.sum())                                # bins not opened yet
    some = np.zeros(capacity + 1, bool)
    some[capacity] = True
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            room = size + int(np.argmax(some[size:]))                       # the tightest that fits
            content, have = next(iter(bins[room].items()))
            each = min(room // size, left)
            n = min(have, left // each)
            if n == have:
                del bins[room][content]
                some[room] = bool(bins[room])
            else:
                bins[room][content] = have - n
            new, rest = (*content, (size, each)), room - each * size
            bins[rest][new] = bins[rest].get(new, 0) + n
            some[rest] = True
            left -= n * each
    return [(content, n) for contents in bins for content, n in contents.items() if content]


def _dominated(counts: np.ndarray, filling: list[int], waste: int) -> bool:
    """An unused item still fits, or some of its items (one, or two together) could give way to a longer unused one that does."""
    free = counts.copy()
    for x in filling:
        free[x] -= 1
    if (free[: waste + 1] > 0).any():
        return True
    for k in (1, 2):
        for some in combinations(filling, k):
            s = sum(some)
            low = s + 1 if k == 1 else s
            if low <= s + waste and (free[low : s + waste + 1] > 0).any():
                return True
    return False


def _fillings(counts: np.ndarray, room: int, most_waste: int) -> Iterator[list[int] | None]:
    """All undominated ways to fill ``room`` with at most ``most_waste`` left, least waste first; None for a step that ends in none.

    Sums that a run of the smaller sizes can reach are kept as bits, so only branches that come out at the wanted sum are followed.
    """
    if counts[room] and room:
        yield [room]                                                       # dominates every other filling
        return
    sizes = np.flatnonzero(counts[: room + 1]).tolist()
    mask, sums = (1 << (room + 1)) - 1, [1]
    for size in sizes:
        bits, most, step = sums[-1], min(int(counts[size]), room // size), 1
        while most:
            step = min(step, most)
            bits |= bits << (size * step) & mask
            most -= step
            step *= 2
        sums.append(bits)
    for waste in range(min(most_waste, room) + 1):
        stack: list[tuple[int, int, list[int]]] = [(room - waste, len(sizes), [])]
        while stack:
            left, k, chosen = stack.pop()
            if not left:
                yield None if _dominated(counts, chosen, waste) else chosen
                continue
            if not sums[k] >> left & 1:
                continue
            # the largest size is taken once more, or not at all from here on
            size = sizes[k - 1]
            stack.append((left, k - 1, chosen))
            if size <= left and chosen.count(size) < counts[size]:
                stack.append((left - size, k, [*chosen, size]))


def plan_bins(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """A packing of ``counts[length]`` pieces into few bins, as (filling, times used).

    Depth-first: each node fills bins around the longest piece left, with the filling as often as the counts allow and
    (when the search comes back) once. A branch ends when the bins so far and the bound for the
    rest, which counts the waste already made, reach the incumbent; fillings that alone waste as much are not made. Best-fit packings of what is
    left are the incumbents. The search is complete but for ``nodes``: it ends at the lower bound, when all is searched, or after so many steps with the best packing found.
    """
    counts = counts.astype(np.int64)
    best = best_fit(counts, capacity)
    best_n, goal = sum(n for _, n in best), lower_bound(counts, capacity)
    if best_n <= goal or not counts.any():
        return best

    lengths = np.arange(capacity + 1)

    def choices(state: np.ndarray, used: int) -> Iterator[tuple[Filling, int] | None]:
        longest = int(np.flatnonzero(state)[-1])
        free = state.copy()
        free[longest] -= 1
        for some in _fillings(free, capacity - longest, (best_n - 1 - used) * capacity - int((state * lengths).sum())):
            if some is None:
                yield None
                continue
            sizes, each = np.unique([longest, *some], return_counts=True)
            most = int((state[sizes] // each).min())
            filling = tuple(zip(sizes[::-1].tolist(), each[::-1].tolist(), strict=True))
            for n in dict.fromkeys((most, 1)):
                yield filling, n

    path: list[tuple[Filling, int]] = []
    stack: list[tuple[np.ndarray, int, Iterator]] = [(counts, 0, choices(counts, 0))]
    seen = 0
    while stack and seen < nodes and best_n > goal:
        state, used, options = stack[-1]
        step = next(options, END)
        seen += 1
        if step is END:
            stack.pop()
            if path:
                path.pop()
        if step is END or step is None:
            continue
        filling, n = step
        left = state.copy()
        for size, each in filling:
            left[size] -= each * n
        if used + n + (lower_bound(left, capacity) if left.any() else 0) >= best_n:
            continue
        if seen % 64 == 1 or not left.any():
            tail = best_fit(left, capacity)
            total = used + n + sum(k for _, k in tail)
            if total < best_n:
                best, best_n = [*path, step, *tail], total
        if left.any():
            path.append(step)
            stack.append((left, used + n, choices(left, used + n)))
    return best


def slots_of(plan: list[tuple[Filling, int]]) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces a bin, offset in the bin), sorted by length and rank."""
    rows, next_rank, first_bin = [], {}, 0
    for filling, n in plan:
        offset = 0
        for size, each in filling:
            rank = next_rank.get(size, 0)
            rows.append((size, rank, first_bin, each, offset))
            next_rank[size] = rank + n * each
            offset += size * each
        first_bin += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LibraryEncoder.cached(tokenizer)
        for batch, texts in text_blocks(batches, chars=1_000_000):
            ids, sizes = encoder.encode(texts)
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            number = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            first = (sizes - (number - 1) * capacity)[owner]
            start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
            length = np.where(piece == 0, first, capacity)
            at = (np.cumsum(sizes) - sizes)[owner] + start
            crcs = [crc_of_ids(ids[a : a + n]) for a, n in zip(at, length, strict=True)]
            yield as_batch(schema, batch.column(0).take(pa.array(owner)), piece, start, length, crcs)

    return doc_text(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, nodes: int = NODES) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty (its end id alone); rows with a null or repeated doc_id are documents of their own;
    an empty table gives an empty result. ``nodes`` bounds the search, not the documents.
    """
    pieces = stage(pieces_of(docs, tokenizer, capacity, end_id).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")), "pieces")
    cells = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():                # at most `capacity` rows
        counts[row["length"]] = row["count"]
    slots = slots_of(plan_bins(counts, capacity, nodes))
    base = cells.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    ranked = (pieces.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")))
              .join(base, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k") - 1).alias("rank")))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = np.searchsorted(slots[:, 0], np.arange(capacity + 2))     # slots of each length
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for size in np.unique(length):
                mine = np.flatnonzero(length == size)
                own = slots[begins[size] : begins[size + 1]]
                slot = own[np.searchsorted(own[:, 1], rank[mine], "right") - 1]
                k = rank[mine] - slot[:, 1]
                sequence[mine] = slot[:, 2] + k // slot[:, 3]
                offset[mine] = slot[:, 4] + k % slot[:, 3] * size
            yield as_batch(schema, *batch.columns[:5], sequence, offset)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
