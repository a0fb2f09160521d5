"""Token ids in flat binary files (operator 6).

Format, for each part: ``<part>.bin`` holds the ids of its documents one after another
as little-endian unsigned integers (16 bits where the vocabulary fits, else 32);
``<part>.idx`` holds int64 n, uint64 offsets[n + 1] (in ids), int64 doc_ids[n] and n bytes
that are 1 where doc_id is not null. Parts follow each other in ascending doc_id order.

A task attempt writes files of its own name; only files named in the manifest count, so a
lost or repeated attempt leaves nothing behind that a reader would see.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_batch, crc_of_ids, doc_text, filesystem, offsets_of, open_buffer, stage, stage_path, text_blocks
from quarry.llm.subwords import LibraryEncoder

MANIFEST = "part int, n_docs long, n_tokens long, stem string, width int"
ROWS = 10_000


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LibraryEncoder.cached(tokenizer)
        width = 2 if max(encoder.vocab_size, end_id + 1) <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        stem = f"part-{part:06d}-{uuid.uuid4().hex}"
        system, path = filesystem(f"{folder}/{stem}")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        lengths, doc_ids, valid = [], [], []
        with system.open_output_stream(path + ".bin") as out:
            for batch, texts in text_blocks(batches, chars=1_000_000):
                ids, sizes = encoder.encode(texts)
                ends = np.cumsum(sizes)
                out.write(np.insert(ids, ends, end_id).astype(f"<u{width}").tobytes())
                lengths.append(sizes + 1)
                column = batch.column(0)
                valid.append(np.asarray(column.is_valid()).astype(np.uint8))
                doc_ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        if not lengths:
            system.delete_file(path + ".bin")
            return
        offsets = offsets_of(np.concatenate(lengths))
        with system.open_output_stream(path + ".idx") as out:
            out.write(np.array([len(offsets) - 1], "<i8").tobytes())
            out.write(offsets.astype("<u8").tobytes())
            out.write(np.concatenate(doc_ids).tobytes())
            out.write(np.concatenate(valid).tobytes())
        schema = pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("stem", pa.string()), ("width", pa.int32())])
        yield as_batch(schema, [part], [len(offsets) - 1], [int(offsets[-1])], [stem], [width])

    return write


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write all documents in ascending doc_id order; returns the folder and the manifest (one row a file).

    Null texts are empty (the end id alone); null doc_ids come first; rows that share a
    doc_id stand in the order of their texts; an empty table gives no file.
    """
    folder = folder or stage_path(docs.sparkSession, "token-files")
    rows = doc_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return folder, stage(rows.mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST), "token-manifest")


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    The manifest has one row for each written file; its prefix sums are the files' bases.
    """
    spark = manifest.sparkSession
    files, base = [], 0
    for row in manifest.orderBy("part").toLocalIterator():
        files.append((f"{folder}/{row.stem}", base, row.width))
        base += row.n_tokens
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stem, first, width in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index, data = open_buffer(stem + ".idx"), open_buffer(stem + ".bin")
                n = int(np.frombuffer(index, "<i8", 1)[0])
                offsets = np.frombuffer(index, "<u8", n + 1, 8).astype(np.int64)
                doc_ids = np.frombuffer(index, "<i8", n, 8 + 8 * (n + 1))
                null = np.frombuffer(index, np.uint8, n, 8 + 8 * (n + 1) + 8 * n) == 0
                ids = np.frombuffer(data, f"<u{width}")
                for at in range(0, n, ROWS):
                    some = slice(at, min(n, at + ROWS))
                    bounds = offsets[at : some.stop + 1]
                    crcs = [crc_of_ids(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    yield as_batch(schema, pa.array(doc_ids[some], mask=null[some]), first + bounds[:-1], np.diff(bounds), crcs)

    listed = spark.createDataFrame(files, "stem string, base long, width int")
    return listed.repartition(max(1, len(files)), F.col("stem")).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
