"""Helpers the operators of this package share: stage tables, Arrow batches, ragged arrays, shared files."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import session

#: Text is handled in blocks of this many characters, so a task's memory does not follow its batch size.
BLOCK_CHARS = 4_000_000

cloudpickle.register_pickle_by_value(sys.modules["quarry.llm"])   # executors need no package path


def process_cache(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker (functions shipped by value lose their globals).

    It holds one owner's entries: a worker that serves another operator next lets them go.
    """
    name = "_quarry_llm_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    kept = sys.modules[name].__dict__.setdefault("kept", {})
    if kept.get("owner") != owner:
        if kept:
            kept.clear()
            give_back()
        kept["owner"] = owner
    return kept


def give_back() -> None:
    """Hand memory that is no longer used back to the system, where the C library can."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return session.stage_path(spark, name, "quarry-llm")


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return df[name].cast(kind) if name in df.columns else F.lit(None).cast(kind)


def doc_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads, and no others, so that extra columns can't clash."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       *[column_or_null(docs, c, "string").alias(c) for c in more])


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches of about ``chars`` characters, with the texts as Python strings."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= chars):
                size += len(texts[end] or "")
                end += 1
            yield batch.slice(at, end - at), texts[at:end]
            at = end


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[s:s+n]`` for each (s, n)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def crc_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def filesystem(uri: str):
    """(pyarrow file system, path) of a shared folder or file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_buffer(uri: str) -> pa.Buffer:
    """A file's bytes: memory-mapped where the shared folder is a mounted one, else read."""
    from pyarrow import fs

    system, path = filesystem(uri)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with system.open_input_file(path) as f:
        return f.read_buffer()


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of a number's decimal text, modulo n."""
    return F.crc32(column.cast("string").cast("binary")) % n


#: Ids that a broadcast may hold; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def some_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with an id in ``ids``."""
    ids = stage(ids.select("doc_id"), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi").select("doc_id", "text")
