"""JSON files that hold one array of samples (or an envelope with one, or one sample), read by many tasks.

A file is read in splits: Spark's text source cuts it at closing braces. What a split means depends on where it begins: outside or
inside a string, after a backslash, and how deep. So a first pass finds, for each split and each of these starts, where it ends
and how the depth changes; put one after the other, these give every split its true start. A second pass cuts the
records, at the commas of the array that holds them; what lies across splits is put together from its pieces.

The starts are one small row for each split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry._workers import ship_by_value
from quarry.session import materialize

ship_by_value(__name__)

#: Starts: outside strings, inside one, inside one after a backslash.
OUT, IN, ESCAPED = 0, 1, 2
#: A key that stands before a value.
LAST_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)
KEY_BYTES = 4096


def quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Which bytes are quotes that open or close a string, and whether the byte after the last one is escaped."""
    place = np.flatnonzero(data == 92)
    out = data == 34
    if escaped and len(data) and data[0] != 92:
        out[0] = False
    if not len(place):
        return out, False
    first = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    start, size = place[first], np.diff(first, append=len(place))
    after = start + size
    odd = (size - ((start == 0) & escaped)) % 2 == 1
    inner = odd & (after < len(data))
    out[after[inner]] = False
    return out, bool(odd[-1] and after[-1] == len(data))


def depths(data: np.ndarray) -> np.ndarray:
    """+1 for what opens, -1 for what closes."""
    return ((data == 91) | (data == 123)).astype(np.int64) - ((data == 93) | (data == 125))


def outside(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Which bytes stand outside strings, and the state after the last one."""
    marks, escaped = quotes(data, state == ESCAPED)
    inside = (np.cumsum(marks) + (state != OUT)) % 2 == 1
    end = bool(inside[-1]) if len(data) else state != OUT
    return ~inside & ~marks, (ESCAPED if escaped else IN) if end else OUT


def transitions(data: bytes) -> list[tuple[int, int]]:
    """(state after, change of depth) for each start."""
    raw = np.frombuffer(data, np.uint8)
    step = depths(raw)
    if not len(raw):
        return [(s, 0) for s in (OUT, IN, ESCAPED)]
    out = []
    for state in (OUT, IN, ESCAPED):
        if state == ESCAPED and raw[0] not in (34, 92):                     # an ordinary byte: as inside
            out.append(out[IN])
            continue
        free, end = outside(raw, state)
        out.append((end, int(step[free].sum())))
    return out


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[bytes]]]:
    """((file, split), pieces) of the runs of rows of one split; every piece ended with a brace, the file's last perhaps not."""
    for batch in batches:
        files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        pieces = batch.column(2).to_pylist()
        at = 0
        for k in range(1, len(files) + 1):
            if k == len(files) or (files[k], starts[k]) != (files[at], starts[at]):
                yield (files[at], starts[at]), pieces[at:k]
                at = k


class Cutter:
    """Cuts a split's bytes, fed in order, into (kind, text): records that are ``whole``, and the ``tail``, ``middle`` and ``head`` of such as go on.
    ``base`` is the depth of the array that holds them; a file of one sample has base 0. ``closed`` tells that the array ended here."""

    def __init__(self, state: int, depth: int, base: int, key: bytes | None):
        self.state, self.depth, self.base, self.key = state, depth, base, key
        self.active = depth >= base if base else True
        self.started = depth < base or base == 0 and depth == 0             # whether what is held began in this split
        self.held: list[bytes] = []
        self.member = b""                                                   # in an envelope: what precedes, for the key
        self.closed = False

    def feed(self, data: bytes) -> Iterator[tuple[str, bytes]]:
        raw = np.frombuffer(data, np.uint8)
        free, end = outside(raw, self.state)
        step = np.where(free, depths(raw), 0)
        after = self.depth + np.cumsum(step)
        if self.base:
            cuts = np.flatnonzero(free & (raw == 44) & (after == self.base) | (step == 1) & (after == self.base) | (step == -1) & (after == self.base - 1))
        else:
            cuts = np.flatnonzero((step == -1) & (after == 0))[:1] if not self.closed else []
        at = 0
        for cut in cuts if isinstance(cuts, list) else cuts.tolist():
            if self.base == 0:
                self.held.append(data[at : cut + 1])
                yield ("whole" if self.started else "head"), b"".join(self.held)
                self.held, self.active, self.closed = [], False, True
            elif step[cut] == 1:
                self.active = not self.closed and (self.key is None or self._key_before(data[at:cut]) == self.key) and raw[cut] == 91
                self.held, self.started = [], True
            elif self.active:
                self.held.append(data[at:cut])
                text = b"".join(self.held)
                if not self.started or text.strip():
                    yield ("whole" if self.started else "head"), text
                self.held, self.started = [], True
                if step[cut] == -1:
                    self.active, self.closed = False, True
            at = cut + 1
        if self.active:
            self.held.append(data[at:])
        else:
            self.member = (self.member + data[at:] if not len(cuts) else data[at:])[-KEY_BYTES:]
        self.state, self.depth = end, int(after[-1]) if len(raw) else self.depth

    def _key_before(self, data: bytes) -> bytes | None:
        found = LAST_KEY.search((self.member + data)[-KEY_BYTES:])
        return found.group(1) if found else None

    def rest(self) -> Iterator[tuple[str, bytes]]:
        if self.active:
            yield ("tail" if self.started else "middle"), b"".join(self.held)


def shape_of(data: bytes, keys: tuple[str, ...]) -> tuple[int, str | None]:
    """(base, key) by a file's first split: 1 for an array; 2 and the key for an envelope, the first of ``keys`` that it has there; 0 for one sample."""
    text = data.lstrip(b"\xef\xbb\xbf \t\r\n")
    if text[:1] != b"{":
        return 1, None
    raw = np.frombuffer(data, np.uint8)
    free, _ = outside(raw, OUT)
    step = np.where(free, depths(raw), 0)
    found = set()
    for cut in np.flatnonzero((step == 1) & (np.cumsum(step) == 2) & (raw == 91)).tolist():
        before = LAST_KEY.search(data[max(0, cut - KEY_BYTES) : cut])
        found.add(before.group(1).decode("utf-8", "replace") if before else None)
    for key in keys:
        if key in found:
            return 2, key
    return 0, None


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"), F.col("_metadata.file_size").alias("file_size"))


def _surveyed(pieces: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(file, split, bytes, file_size, ends, deltas, base, key) of every split."""
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("bytes", pa.int64()), ("file_size", pa.int64()), ("ends", pa.list_(pa.int32())), ("deltas", pa.list_(pa.int64())), ("base", pa.int32()), ("key", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, total, ends, deltas, first = None, 0, 0, [], [], b""

        def row():
            base, key = shape_of(first, keys) if name[1] == 0 else (None, None)
            return pa.RecordBatch.from_pylist([dict(file=name[0], split=name[1], bytes=total, file_size=size, ends=ends, deltas=deltas, base=base, key=key)], schema=schema)

        for batch in batches:
            sizes = batch.column(3).to_pylist()
            at = 0
            for new, some in _splits([batch]):
                if new != name:
                    if name is not None:
                        yield row()
                    name, size, total, ends, deltas, first = new, sizes[at], 0, [OUT, IN, ESCAPED], [0, 0, 0], b""
                data = b"".join(x + b"}" for x in some)
                got = transitions(data)
                deltas = [d + got[e][1] for d, e in zip(deltas, ends, strict=True)]
                ends = [got[e][0] for e in ends]
                total += len(data)
                if new[1] == 0 and len(first) < FIRST_BYTES:
                    first += data
                at += len(some)
        if name is not None:
            yield row()

    return pieces.mapInArrow(run, "file string, split long, bytes long, file_size long, ends array<int>, deltas array<long>, base int, key string")


#: Splits whose starts a broadcast may hold; with more, files meet their starts by a shuffle.
BROADCAST_SPLITS = 1_000_000
#: An envelope's array is looked for in so many bytes at a file's beginning.
FIRST_BYTES = 32 << 20


def _starts(survey: DataFrame) -> DataFrame:
    """(file, split, state, depth, base, key, broken): every split's true start; a file is broken where its last split does not end at depth 0 outside strings."""
    s = F.struct("split", "ends", "deltas", "bytes")
    files = survey.groupBy("file").agg(F.array_sort(F.collect_list(s)).alias("splits"), F.max("base").alias("base"), F.max("key").alias("key"), F.max("file_size").alias("file_size"), F.sum("bytes").alias("bytes"))
    zero = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("depth"), F.array().cast("array<struct<split:long,state:int,depth:long>>").alias("out"))
    walked = F.aggregate("splits", zero, lambda a, x: F.struct(
        F.get(x["ends"], a["state"]).alias("state"), (a["depth"] + F.get(x["deltas"], a["state"])).alias("depth"),
        F.concat(a["out"], F.array(F.struct(x["split"].alias("split"), a["state"].alias("state"), a["depth"].alias("depth")))).alias("out")))
    w = files.withColumn("w", walked)
    # every piece is counted with a brace; where that is a byte more than the file has, its last one had none
    depth = F.col("w.depth") + F.when((F.col("bytes") > F.col("file_size")) & (F.col("w.state") == OUT), 1).otherwise(0)
    return w.select("file", "base", "key", ((F.col("w.state") != OUT) | (depth != 0)).alias("broken"), F.explode("w.out").alias("o")).select("file", "base", "key", "broken", "o.*")


def json_records(spark: SparkSession, path: str, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """((file, value) of every record as JSON text, (file) of the files that end inside a value; these give no record).

    An envelope's array must begin within its file's first split (and its first 32 MB). Text after the array or the object is not read.
    """
    pieces = _pieces(spark, path).withColumn("n", F.monotonically_increasing_id())
    starts = materialize(_starts(_surveyed(pieces, keys)), "json-splits")
    broken = starts.where("broken").select("file").distinct()
    plain = ["file", "split", "state", "depth", "base", "key"]
    known = starts.where("NOT broken").select(*plain)
    if known.count() <= BROADCAST_SPLITS:
        rows = pieces.join(F.broadcast(known), ["file", "split"])           # pieces stay where they are read, in order
    else:
        rows = pieces.join(known, ["file", "split"]).sortWithinPartitions("file", "split", "n")
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("kind", pa.string()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, cutter, out = None, None, []

        def flush():
            batch = pa.RecordBatch.from_pylist([dict(file=n[0], split=n[1], kind=k, value=v) for n, k, v in out], schema=schema)
            out.clear()
            return batch

        def finish():
            out.extend((name, *x) for x in cutter.rest())
            if cutter.closed:
                out.append((name, "end", None))

        for batch in batches:
            at, column = 0, [batch.column(i).to_pylist() for i in (3, 4, 5, 6)]
            for new, some in _splits([batch]):
                if new != name:
                    if name is not None:
                        finish()
                    state, depth, base, key = (c[at] for c in column)
                    name, cutter = new, Cutter(state, depth, base, key.encode() if key is not None else None)
                held = 0
                for k in range(0, len(some), 1000):
                    for kind, text in cutter.feed(b"".join(x + b"}" for x in some[k : k + 1000])):
                        out.append((name, kind, text))
                        held += len(text)
                        if held > 4_000_000:
                            yield flush()
                            held = 0
                at += len(some)
            if out:
                yield flush()
        if name is not None:
            finish()
        if out:
            yield flush()

    cut = materialize(rows.select("file", "split", "value", "state", "depth", "base", "key").mapInArrow(run, "file string, split long, kind string, value binary"), "json-cut")
    ends = cut.where("kind = 'end'").groupBy("file").agg(F.min("split").alias("last"))
    several = starts.where("split > 0").select("file").distinct()           # only where a file has several splits can something follow its end
    ends = F.broadcast(ends.join(several, "file", "left_semi").withColumnRenamed("file", "_file"))
    kept = cut.where("kind <> 'end'").join(ends, (F.col("file") == F.col("_file")) & (F.col("split") > F.col("last")), "left_anti")
    parts = kept.where("kind <> 'whole'").withColumn("part", F.when(F.col("kind") == "tail", 1).otherwise(0))
    order = Window.partitionBy("file").orderBy("split", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of = parts.withColumn("begun", F.max(F.when(F.col("part") == 1, F.col("split"))).over(order))
    joined = of.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("split", "part", "value"))).alias("p")) \
        .select("file", F.array_join(F.transform("p", lambda x: x["value"].cast("string")), "").alias("value"))      # the pieces of one record
    return kept.where("kind = 'whole'").select("file", F.col("value").cast("string").alias("value")).unionByName(joined), broken
