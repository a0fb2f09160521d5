"""URL rules through a sorted digest array (operator 5).

A rule is a host and a path prefix. Its string's 64-bit xxhash is its key; keys lie sorted
in shard files that tasks memory-map, next to the full strings. A URL's candidates (its host
and parent domains, with its path cut to each length that rules have) are hashed, searched
by vectorised binary search, and confirmed against the stored strings.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, filesystem, offsets_of, open_buffer, stage_path

#: Spark's xxhash64() of one string uses this seed.
SEED = 42
HOST_END, PATH_END = re.compile(r"[/?#]"), re.compile(r"[?#]")
#: A-Z to a-z and nothing else.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
SHARD_ROWS = 1_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = m.start() if (m := HOST_END.search(rest)) else len(rest)
    return rest[:end].translate(ASCII_LOWER), PATH_END.split(rest[end:], maxsplit=1)[0]


def _digest(text: str) -> int:
    d = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), SEED)
    return d - (1 << 64) if d >> 63 else d


def write_index(rules: DataFrame) -> list[tuple[str, int, list[int]]]:
    """Write rules (host, path, verdict) as shards sorted by key; returns each shard's file, first key and path lengths.

    Rows with a null host, path or verdict are no rules; of rules with one string the least verdict
    ('allow' before 'block') holds. What returns has one entry for each million rules.
    """
    spark = rules.sparkSession
    folder = stage_path(spark, "url-index")
    keyed = (rules.select(F.col("host").cast("string").alias("host"), F.col("path").cast("string").alias("path"), F.col("verdict").cast("string").alias("verdict")).dropna()
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn("key", F.xxhash64(F.concat("host", "path"))))
    shards = 1 + keyed.count() // SHARD_ROWS

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[], [], [], []]
        for batch in batches:
            for values, column in zip(columns, batch.columns, strict=True):
                values += column.to_pylist()
        host, path, verdict, key = columns
        if not key:
            return
        blobs = [f"{h}{p}\0{len(h)}\0{v}".encode() for h, p, v in zip(host, path, verdict, strict=True)]
        name = f"{folder}/shard-{uuid.uuid4().hex}"
        system, at = filesystem(name)
        system.create_dir(at.rpartition("/")[0], recursive=True)
        with system.open_output_stream(at) as out:
            out.write(np.array([len(key)], "<i8").tobytes() + np.array(key, "<i8").tobytes() + offsets_of(np.array(list(map(len, blobs)))).astype("<i8").tobytes() + b"".join(blobs))
        yield pa.RecordBatch.from_pydict({"file": [name], "first": pa.array([key[0]], pa.int64()), "lengths": pa.array([sorted(set(map(len, path)))], pa.list_(pa.int32()))})

    written = keyed.repartitionByRange(shards, "key").sortWithinPartitions("key").mapInArrow(write, "file string, first long, lengths array<int>")
    return [(r.file, r.first, r.lengths) for r in sorted(written.collect(), key=lambda r: r[1])]


class DigestIndex:
    """The shards, mapped when first needed."""

    def __init__(self, shards: list[tuple[str, int, list[int]]]):
        self.shards, self.firsts = shards, np.array([s[1] for s in shards], np.int64)
        self.lengths = sorted({n for s in shards for n in s[2]})
        self.open: dict[int, tuple] = {}

    def _shard(self, k: int) -> tuple:
        if k not in self.open:
            data = open_buffer(self.shards[k][0])
            n = int(np.frombuffer(data, "<i8", 1)[0])
            self.open[k] = np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<i8", n + 1, 8 + 8 * n), memoryview(data)[8 + 8 * n + 8 * (n + 1):]
        return self.open[k]

    def find(self, candidates: list[str], hosts: list[int]) -> list[str | None]:
        """Verdict of each candidate string whose host part has the given length, or None."""
        out: list[str | None] = [None] * len(candidates)
        if not self.shards or not candidates:
            return out
        keys = np.fromiter(map(_digest, candidates), np.int64, len(candidates))
        of = np.maximum(np.searchsorted(self.firsts, keys, "right") - 1, 0)
        for k in np.unique(of):
            stored, offsets, blob = self._shard(int(k))           # equal keys lie in one shard
            mine = np.flatnonzero(of == k)
            left, right = np.searchsorted(stored, keys[mine], "left"), np.searchsorted(stored, keys[mine], "right")
            hit = left < right
            for i, a, b in zip(mine[hit], left[hit], right[hit], strict=True):
                for j in range(a, b):
                    text, host, verdict = bytes(blob[offsets[j]:offsets[j + 1]]).decode().split("\0")
                    if text == candidates[i] and int(host) == hosts[i]:
                        out[i] = verdict
        return out


def url_filter(pages: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``rules``: rows (verdict, host, path) or a DataFrame with these columns. A rule fits its host
    and all subdomains where the path starts with the rule's; the longest string wins, among
    equals the longer host. URLs that no rule fits get ``default``. A null URL, or one
    without ``://``, has an empty host and path, and fits no rule. Rows repeat as they
    do in the input; an empty table gives an empty result.
    """
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    shards = write_index(rules)
    schema = pa.schema([("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(shards)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            owner, texts, hosts = [], [], []
            for i, (host, path) in enumerate(parts):
                labels = host.split(".")
                for k in range(len(labels)) if host else ():
                    domain = ".".join(labels[k:])
                    for n in index.lengths:
                        if n <= len(path):
                            owner.append(i)
                            texts.append(domain + path[:n])
                            hosts.append(len(domain))
            best: list[tuple] = [(-1, -1, None, default)] * len(parts)
            for i, text, host, verdict in zip(owner, texts, hosts, index.find(texts, hosts), strict=True):
                if verdict is not None:
                    best[i] = max(best[i], (len(text), host, text, verdict), key=lambda x: x[:2])
            yield as_batch(schema, batch.column(0), [h for h, _ in parts], [p for _, p in parts], [b[2] for b in best], [b[3] for b in best])

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url")).mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")
