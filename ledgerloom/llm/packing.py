"""Packing by power-of-two decomposition: every document is cut into pieces of binary
lengths and pieces of equal length share a bucket, so no sequence crosses documents and
no token is padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import with_defaults
from .textbytes import buffers, chunks
from .token_counts import PieceTable

MAX_TOKENS = 2048
END_ID = 1


def binary_pieces(totals: np.ndarray, most: int = MAX_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the pieces of documents of so many tokens, in order."""
    sizes = np.array([most, *(1 << b for b in range(most.bit_length() - 2, -1, -1))], np.int64)
    counts = np.column_stack([totals // most, *((totals % most) // s % 2 for s in sizes[1:])])
    length = np.repeat(np.tile(sizes, len(totals)), counts.ravel())
    row = np.repeat(np.arange(len(totals)), counts.sum(axis=1))
    before = np.cumsum(length) - length
    return row, before - (np.cumsum(totals) - totals)[row], length


def pack_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: ``doc_id, start, length, ids,
    doc_tokens, bucket, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit bytes; every
    document ends in ``end_id``, so a null or empty text is one piece of one id.
    ``bucket`` is the base-2 logarithm of the length; a piece fills a sequence of its own,
    so ``offset`` is 0 and ``sequence_id`` is unique among all rows, also where rows of
    ``docs`` repeat.  Other columns are ignored, and an empty table gives no piece.
    ``max_tokens`` must be a power of two.  One narrow pass: no
    shuffle, and no state beyond a worker's memo of pieces.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(tokenizer_path)
        for batch in batches:
            keys = batch.column("doc_id")
            data, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                ids, edges = table.ids(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                ids = np.insert(ids, edges[1:], end_id).astype("<u4")
                total = np.diff(edges) + 1
                row, start, length = binary_pieces(total, max_tokens)
                own = keys.slice(lo, hi - lo).take(pa.array(row))
                # every id is in one piece and pieces keep the order, so the ids are one buffer
                ends = np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([own, pa.array(start), pa.array(length), blob, pa.array(total[row])], names)

    cut = with_defaults(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long")
    return cut.select("*", F.log2("length").cast("int").alias("bucket"), F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write sequences as Parquet, one folder per length, for equal-length batches."""
    packed.write.partitionBy("bucket").parquet(path)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens, without padding."""
    packed = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
