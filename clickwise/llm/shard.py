"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Every row gets a dense global row number (rank in a seeded hash order). A balanced Feistel network over
Z_a x Z_b, a*b just above the row count n, permutes the numbers; results outside 0..n-1 are walked on
until they fall inside, which keeps the map a permutation of 0..n-1. Shard = result mod shards, slot =
result div shards: row counts differ by at most one, slots are gapless, and both can be computed from the
row number alone.

Nulls: a null text has size 16 and the checksum of the empty text; a null doc_id is hashed as null.
Repeated rows get places of their own; rows with equal hashes are ordered by id, then text hash. A very long text is
read for its size and checksum only. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import SEED, hashed_rank, scratch_table

ROUNDS = 6
OVERHEAD_BYTES = 16


def _network(x: str, a: int, b: int, seed: int) -> str:
    left, right = f"({x} div {b}L)", f"({x} % {b}L)"
    for j in range(ROUNDS):
        if j % 2 == 0:
            left = f"pmod({left} + pmod(xxhash64({right}, {seed + j}), {a}L), {a}L)"
        else:
            right = f"pmod({right} + pmod(xxhash64({left}, {seed + j}), {b}L), {b}L)"
    return f"({left} * {b}L + {right})"


def permuted(row: str, n: int, seed: int = SEED) -> Column:
    """The place of row number ``row`` (a column of 0..n-1) under the permutation of 0..n-1.

    At most a-1 results lie outside, so a walk ends within a steps; it runs only for the rows that need it
    (about one in sqrt(n))."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    first = _network(row, a, b, seed)
    walk = f"CASE WHEN p < {n}L THEN p ELSE {_network('p', a, b, seed)} END"
    return F.expr(f"aggregate(sequence(0, CASE WHEN {first} < {n}L THEN 0 ELSE {a} END), {first}, (p, i) -> {walk})")


def shard_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
               seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, row_number, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = scratch_table(docs.select(F.col(id_col).alias("doc_id"),
                                       (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
                                       F.crc32(text.cast("binary")).alias("text_crc32")), "shard")
    n = narrow.count()
    ranked = hashed_rank(narrow, ["doc_id", "text_crc32", "size"], [], "row_number", seed)
    placed = ranked.withColumn("_p", permuted("row_number", n, seed))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                         (F.col("_p") % shards).cast("int").alias("shard"),
                         F.expr(f"_p div {shards}").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")
