"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of binary lengths: as many of the full sequence length as fit, then
one for each set bit of the rest, longest first. A sequence holds one piece, so none crosses documents and
none is padded; sequences of equal length form a bucket, and their ids are consecutive: longest bucket first,
inside a bucket by the document order given (default: a seeded hash order).

Null texts are empty documents: they hold the end id alone, in a piece of length 1. A very long text is cut like any other, whole. Repeated rows are
packed each for themselves, null ids too; ties in the order go by id, start, length of the document and content; an empty table gives no rows. Only the id, text and order columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.llm.common import SEED, bucket_bits, scratch_table, small_batches, text_key
from clickwise.llm.tokens import END_ID, encode_texts

LENGTH = 4096
#: Orders below this are given ones; from it on are the places of the rows without an order (2**40 of them).
LATER_BITS = 24
LATER = 1 << 62


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; ``length`` is a power of two."""
    out = [(i * length, length) for i in range(n // length)]
    at, size = n // length * length, length >> 1
    while at < n:
        if (n - at) & size:
            out.append((at, size))
            at += size
        size >>= 1
    return out


_PIECES = "doc_id long, doc_tokens long, key long, pieces array<struct<start:long,length:long,ids_crc32:long>>"


def pack_pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text", order: Column | None = None,
                seed: int = SEED) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``order``: a long below 2**62 that places documents inside the buckets; ties by id and content, null after all others."""
    if length & (length - 1) or length < 1:
        raise ValueError("the sequence length is a power of two")
    small_batches(docs.sparkSession)
    out = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("key", pa.int64()), ("pieces", pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, pieces = [], []
            for ids in encode_texts(batch.column(2).to_pylist(), vocabulary, end_id):
                counts.append(len(ids))
                pieces.append([{"start": s, "length": k, "ids_crc32": zlib.crc32(ids[s:s + k])}
                               for s, k in cuts(len(ids), length)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), batch.column(1),
                                              pa.array(pieces, out.field("pieces").type)], schema=out)
        pa.default_memory_pool().release_unused()  # the worker goes on with other stages

    # the text spreads repeated and null ids over the buckets
    key = F.xxhash64(F.lit(seed), F.col(id_col), text_key(F.col(text_col)))
    if order is not None:  # rows without an order come last, in one another's hash order
        key = F.coalesce(order.cast("long"), F.lit(LATER) + F.shiftrightunsigned(key, LATER_BITS))
    cut_docs = scratch_table(docs.select(F.col(id_col).cast("long").alias("doc_id"), key.cast("long").alias("key"),
                                         F.col(text_col).alias("text")).mapInArrow(cut, _PIECES), "pack")
    pieces = cut_docs.select("doc_id", "key", "doc_tokens", F.inline("pieces"))
    return numbered(pieces, hashed=order is None)


def numbered(pieces: DataFrame, hashed: bool = True) -> DataFrame:
    """Add gapless sequence ids: longest pieces first, then by key (a hash, or small consecutive numbers; see :data:`LATER`)."""
    bits = bucket_bits(pieces.sparkSession)
    if hashed:
        bucket = F.shiftrightunsigned("key", 64 - bits)
    else:
        top, low = pieces.where(F.col("key") < LATER).agg(F.max("key"), F.min("key")).first()
        top, low = top or 0, low or 0
        given = F.expr(f"(key - {low}L) div {(top - low) // (1 << bits) + 1}L")
        bucket = F.when(F.col("key") < LATER, given).otherwise((1 << bits) + F.shiftrightunsigned(F.col("key") - LATER, 64 - LATER_BITS - bits))
    p = pieces.withColumn("_b", bucket)
    sizes = p.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    # (lengths x buckets) rows: bounded by the number of partitions, not by the data
    before = Window.orderBy(F.desc("length"), "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("length", "_b").orderBy("key", "doc_id", "start", "doc_tokens", "ids_crc32")
    return (p.withColumn("_r", F.row_number().over(inside)).join(offsets, ["length", "_b"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("_o") + F.col("_r") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
