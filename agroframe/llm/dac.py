"""Token ids in directly addressable codes, with random access to any token.

An id is split into 8-bit chunks, lowest first.  Level 0 holds the first chunk
of every id; a bitmap beside it tells which ids go on; level 1 holds the second
chunk of just those, and so on.  The position in the next level is the number of
set bits before (rank), read from a directory of counts per 512 bits and at most
eight population counts.  So one id costs one step per level, and no block is
decoded.

A *store* is a Parquet table of segments: consecutive documents in ascending id
order, one binary image each, written by Spark's own committer into shared
storage (a lost task leaves no partial segment).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroframe.llm.common import few_or_shuffled, small_batches
from agroframe.llm.tokens import TokenizerFile, encode_in_chunks
from agroframe.session import materialize

MAGIC = b"DAC1"
WORDS_PER_BLOCK = 8  # 64-bit words in a block of the rank directory
SEGMENT_TOKENS = 1 << 18


class Codes:
    """Ids as chunk levels: ``build`` makes the binary image, ``get``/``slice`` read it."""

    def __init__(self, image: bytes):
        magic, self.n, n_levels = struct.unpack_from("<4sQI", image, 0)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = 16
        self.levels = []
        for _ in range(n_levels):
            (count,) = struct.unpack_from("<Q", image, at)
            words, blocks = -(-count // 64), -(-count // (64 * WORDS_PER_BLOCK))
            at += 8
            bitmap = np.frombuffer(image, "<u8", words, at)
            directory = np.frombuffer(image, "<u8", blocks, at + 8 * words)
            at += 8 * (words + blocks)
            self.levels.append((np.frombuffer(image, "u1", count, at), bitmap, directory))
            at += -(-count // 8) * 8

    @staticmethod
    def build(ids: np.ndarray) -> bytes:
        rest, parts = np.asarray(ids, dtype="<u4"), []
        n = len(rest)
        while len(rest):
            more = rest > 0xFF
            words = -(-len(rest) // 64)
            bits = np.zeros(8 * words, dtype="u1")
            packed = np.packbits(more, bitorder="little")
            bits[:len(packed)] = packed
            bitmap = bits.view("<u8")
            ones = np.zeros(-(-words // WORDS_PER_BLOCK) * WORDS_PER_BLOCK, dtype="<u8")
            ones[:words] = np.bitwise_count(bitmap)
            per_block = ones.reshape(-1, WORDS_PER_BLOCK).sum(axis=1, dtype="<u8")
            directory = (np.cumsum(per_block, dtype="<u8") - per_block).astype("<u8")
            chunk = (rest & 0xFF).astype("u1").tobytes()
            parts += [struct.pack("<Q", len(rest)), bitmap.tobytes(), directory.tobytes(), chunk,
                      b"\0" * (-len(chunk) % 8)]
            rest = rest[more] >> np.uint32(8)
        n_levels = len(parts) // 5
        return struct.pack("<4sQI", MAGIC, n, n_levels) + b"".join(parts)

    def get(self, positions) -> np.ndarray:
        """Ids at *positions* (any order, repeats allowed): one rank per level, no block is decoded."""
        at = np.asarray(positions, dtype=np.int64)
        if at.size and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("token position out of range")
        out, live, shift = np.zeros(at.shape, dtype="<u4"), np.arange(at.size), 0
        for chunk, bitmap, directory in self.levels:
            out[live] |= chunk[at].astype("<u4") << np.uint32(shift)
            word, bit = at >> 6, (at & 63).astype("<u8")
            more = (bitmap[word] >> bit & np.uint64(1)).astype(bool)
            live, at, word, bit = live[more], at[more], word[more], bit[more]
            if not at.size:
                break
            block = word // WORDS_PER_BLOCK
            rank = directory[block].astype(np.int64)
            for k in range(WORDS_PER_BLOCK - 1):  # whole words of the block before this one
                inside = block * WORDS_PER_BLOCK + k
                whole = inside < word
                rank[whole] += np.bitwise_count(bitmap[inside[whole]]).astype(np.int64)
            rank += np.bitwise_count(bitmap[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            at, shift = rank, shift + 8
        return out

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a..b-1: each level's part of a range is contiguous, so only its ends need ranks."""
        out, live, shift = np.zeros(b - a, dtype="<u4"), None, 0
        for chunk, bitmap, directory in self.levels:
            if a >= b:
                break
            part = chunk[a:b].astype("<u4") << np.uint32(shift)
            first = a >> 6
            bits = np.unpackbits(bitmap[first:(b + 63) >> 6].view("u1"), bitorder="little")
            more = bits[a - (first << 6):b - (first << 6)].astype(bool)
            if live is None:
                out |= part
                live = np.flatnonzero(more)
            else:
                out[live] |= part
                live = live[more]
            block = first // WORDS_PER_BLOCK
            before = int(directory[block]) + int(np.bitwise_count(bitmap[block * WORDS_PER_BLOCK:first]).sum())
            a, shift = before + int(bits[:a - (first << 6)].sum()), shift + 8
            b = a + len(live)
        return out


STORE_SCHEMA = "part int, seq long, start_in_part long, n_tokens long, doc_ids array<long>, doc_ends array<long>, image binary"


def write_store(docs: DataFrame, path: str, file: TokenizerFile, end_id: int = 1, doc_id: str = "doc_id",
                text: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every document and write the store in ascending id order.

    A null text is empty, so the document holds the end id alone; null ids come
    first; rows with equal ids follow their text; other columns are ignored; an
    empty table gives a store without segments.  Documents are dealt by ranges
    of the id and sorted within the range; a segment holds at least
    *segment_tokens* tokens, or what is left of the range.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("start_in_part", pa.int64()),
                            ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("doc_ends", pa.list_(pa.int64())), ("image", pa.binary())])
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, ends, bodies, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            image = Codes.build(np.frombuffer(b"".join(bodies), dtype="<u4"))
            row = [part, seq, start, held, ids, ends, image]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in small_batches(batches):
            for i, body in zip(batch.column(0).to_pylist(), encode_in_chunks(file, batch.column(1).to_pylist())):
                held += len(body) // 4 + 1
                ids.append(i)
                ends.append(held)
                bodies += (body, end)
                if held >= segment_tokens:
                    yield segment()
                    seq, start = seq + 1, start + held
                    ids, ends, bodies, held = [], [], [], 0
        if ids:
            yield segment()

    (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(segments, STORE_SCHEMA).write.parquet(path))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's segments with ``start``, the number of tokens of all segments before."""
    segs = spark.read.parquet(path)
    # one row per written partition: the running total is over a few numbers, and the images stay where they are
    totals = segs.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "part-starts")
    return segs.join(few_or_shuffled(base), "part").withColumn("start", F.col("_base") + F.col("start_in_part")).drop("_base")


def read_documents(store: DataFrame) -> DataFrame:
    """Per document, read from the codes: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["doc_ends"][-1]
                data, a, crcs = memoryview(Codes(row["image"]).slice(0, n).tobytes()), 0, []
                for b in row["doc_ends"]:
                    crcs.append(zlib.crc32(data[4 * a:4 * b]))
                    a = b
                ends = np.array(row["doc_ends"], dtype=np.int64)
                begin = np.r_[0, ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begin + row["start"]),
                     pa.array(ends - begin), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return store.select("start", "doc_ids", "doc_ends", "image").mapInArrow(documents, schema)


def tokens_at(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Random access: *wanted* (doc_id, k) rows with ``id``, the k-th token of the document.

    Positions outside the document give no row.  Only the segments that hold a
    wanted document are read, and only the wanted tokens are looked up.
    """
    held = store.select("part", "seq", "doc_ids", "doc_ends")
    spans = held.select("part", "seq", F.posexplode("doc_ids").alias("_i", "doc_id"), "doc_ends")
    spans = spans.select("part", "seq", "doc_id", F.get("doc_ends", F.col("_i")).alias("_end"),
                         F.when(F.col("_i") > 0, F.get("doc_ends", F.col("_i") - 1)).otherwise(0).alias("_begin"))
    hits = (wanted.select("doc_id", "k").join(spans, "doc_id")
            .where((F.col("k") >= 0) & (F.col("k") < F.col("_end") - F.col("_begin")))
            .withColumn("_at", F.col("_begin") + F.col("k")))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [int(Codes(image).get([at])[0]) for image, at in
                   zip(batch.column("image").to_pylist(), batch.column("_at").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), pa.array(got, pa.int64())],
                                             names=["doc_id", "k", "id"])

    return (hits.join(store.select("part", "seq", "image"), ["part", "seq"])
            .select("doc_id", "k", "_at", "image").mapInArrow(look, "doc_id long, k long, id long"))
