"""Packing by power-of-two decomposition.

Each document becomes its token ids plus an end id.  A document of L tokens is
cut into ``L // max_len`` pieces of ``max_len`` and one piece for every binary
digit of the rest, longest first.  Every piece is a sequence of its own in the
bucket of its length, so no sequence crosses documents, every length is a power
of two, and nothing is padded.  There is no shuffle: a document's pieces depend
on the document alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroframe.llm.common import small_batches
from agroframe.llm.tokens import TokenizerFile, encode_in_chunks

MAX_LEN = 2048
OUTPUT_BYTES = 4 << 20
_INDEX_BITS, _PARTITION_BITS = 33, 25

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, "
          "sequence_id long, offset long")


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of a document of *n* tokens, in document order."""
    whole, rest = divmod(n, max_len)
    return [max_len] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, file: TokenizerFile, end_id: int = 1, max_len: int = MAX_LEN,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: its document's id, ``start`` and ``length`` there, the piece's
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``bucket`` (log2 of the
    length), ``sequence_id`` and ``offset`` (always 0).

    A null or empty text is a document of the end id alone; a null id stays null;
    repeated rows are packed each by itself; other columns are ignored.  Sequence ids are
    unique, lie together by bucket (bucket, task, running number) and stay the
    same when a task is repeated over the same input partition.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("bucket", pa.int32()),
                            ("sequence_id", pa.int64()), ("offset", pa.int64())])
        task, used, rows, held = TaskContext.get().partitionId(), {}, [], 0

        def flush() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in small_batches(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, body in zip(ids, encode_in_chunks(file, texts)):
                body += end
                n, at = len(body) // 4, 0
                for length in piece_lengths(n, max_len):
                    bucket = length.bit_length() - 1
                    number = used[bucket] = used.get(bucket, -1) + 1
                    seq = (bucket << _PARTITION_BITS | task) << _INDEX_BITS | number
                    rows.append((i, at, length, body[4 * at:4 * (at + length)], n, bucket, seq, 0))
                    at += length
                held += len(body)
                if held >= OUTPUT_BYTES:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(pieces, SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "bucket",
                         "sequence_id", "offset")
