"""Exact dedup: a tree merge of sorted digest runs.

Each input partition forms a run: its distinct digests with the best identifier and the number of copies.
Runs then meet in binomial rounds: in round k a run trades with the runs that differ from it in digit k of
their number, each taking over the digests whose digit k is its own, and merges what it gets. After all
rounds every digest is in one run, whole. The answer goes back down the same tree, so a text with a third
of all rows is never gathered in a task: at each level a digest meets at most FAN_IN entries.

An entry is verified by length and a second, independent hash beside the SHA-256: entries that agree in the
digest only stay apart.

Null texts count as empty. A null doc_id is never preferred to another; a group of null ids only has a null
keep_id; there are no other ties. A very long text is read for its digests only. Rows repeated with the same doc_id and text all count; ``kept`` holds for each of them. An empty
table gives no rows. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import free_name, maybe_broadcast, scratch_table, text_key, without_rows

FAN_IN_BITS = 4
ROUNDS = 3
KEY = ["_digest", "_bytes", "_check"]


def exact_groups(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the text's 64-bit key."""
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    runs = 1 << (FAN_IN_BITS * ROUNDS)
    rows = scratch_table(docs.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("_digest"),
        F.octet_length(text).cast("long").alias("_bytes"), text_key(text).alias("_check"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).cast("int").alias("_run")), "exact")
    # the digest's own place among the runs; a run's number takes over one digit of it in each round
    home = F.pmod(F.xxhash64("_digest"), F.lit(runs)).cast("int")
    levels = [rows.groupBy("_run", *KEY).agg(best("doc_id").alias("_best"), F.count(F.lit(1)).alias("_n"))]
    for k in range(ROUNDS):
        mask = ((1 << FAN_IN_BITS) - 1) << (FAN_IN_BITS * k)
        to = F.col("_run").bitwiseAND(F.lit(~mask)).bitwiseOR(home.bitwiseAND(F.lit(mask)))
        levels[-1] = levels[-1].withColumn("_to", to)
        levels.append(levels[-1].groupBy(F.col("_to").alias("_run"), *KEY)
                      .agg(best("_best").alias("_best"), F.sum("_n").alias("_n")))
    found = levels.pop()
    for level in reversed(levels):
        above = found.select(F.col("_run").alias("_to"), *KEY, "_best", "_n")
        found = level.select("_run", "_to", *KEY).join(above, ["_to", *KEY]).drop("_to")
    out = rows.join(found, ["_run", *KEY])
    return out.select("doc_id", F.col("_best").alias("keep_id"), F.col("_n").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("_best")).alias("kept"),
                      F.lower(F.hex("_digest")).alias("text_sha256"), F.col("_check").alias("text_key"))


def drop_exact(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``docs`` with one row for each distinct text, all columns unchanged."""
    groups = scratch_table(exact_groups(docs, keep).where("group_size > 1"), "exact-groups")
    gone = groups.where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    left = without_rows(docs, scratch_table(gone, "exact-gone"))
    again = scratch_table(groups.where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
                          .count().where("count > 1").select("_id", "_key"), "exact-again")
    if again.isEmpty():
        return left
    # the same doc_id and text more than once: only those rows are compared whole
    same = left["doc_id"].eqNullSafe(again["_id"]) & (text_key(left["text"]) == again["_key"])
    hint = maybe_broadcast(again)
    whole = free_name(left.columns, "_t")
    repeated = left.join(hint, same, "left_semi").withColumn(whole, F.coalesce("text", F.lit("")))
    return (left.join(hint, same, "left_anti")
            .unionByName(repeated.dropDuplicates(["doc_id", whole]).drop(whole)))
