"""Document fingerprints: SimHash over weighted terms, and a search by permuted block tables.

A text's terms are its word pairs (a text of one word: that word), lower-cased in A-Z and hashed to 64 bits;
a term that occurs c times votes with the weight 1 + ln c, for or against each of the 64 bits. The signs of the sums
are the fingerprint; the share of equal bits is the likeness of two fingerprints.

Search: the 64 bits are cut into radius + SPARE blocks, and every choice of SPARE blocks makes a table keyed
by their bits. Two fingerprints within the radius agree in at least SPARE whole blocks, so they meet in
a table; each meeting is checked by its Hamming distance. Equal fingerprints are one entry. The query searches the
documents whose doc_id is a multiple of 20 among all.

Null and empty texts, and texts of white space alone, have no terms: fingerprint 0. Equal texts have equal fingerprints, so
repeated rows do too. A bit whose votes are tied is 0. A very long text is
held whole by one task. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.llm.common import maybe_broadcast, scratch_table, small_batches, text_key
from clickwise.llm.words import Words, groups

SPARE = 3
_SIGN = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1.0
_OFFSET = np.arange(8) * 256


def fingerprints(texts: list[str | None]) -> list[int]:
    out = []
    for group in groups(texts):
        w = Words(group, lower=True)
        for i in range(len(w)):
            terms = w.ngrams(i, 2)
            if not len(terms):
                out.append(0)
                continue
            term, count = np.unique(terms, return_counts=True)
            weight = 1 + np.log(count)
            # votes by byte: sum the weights of each byte value, then the values' signs
            at = term.astype(">u8").view(np.uint8).reshape(-1, 8) + _OFFSET
            votes = np.bincount(at.ravel(), np.repeat(weight, 8), 2048).reshape(8, 256) @ _SIGN
            out.append(int.from_bytes(np.packbits(votes.ravel() > 0).tobytes()))
    return out


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / 64


def with_next(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                  ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string())])


def _compared(ids: list, texts: list[str], followers: list[str]) -> list[list]:
    """The columns of ``_ROW`` for documents and the texts that follow them."""
    edited = [with_next(t, f) for t, f in zip(texts, followers)]
    of = dict.fromkeys([*texts, *followers, *edited])
    of = dict(zip(of, fingerprints(list(of))))
    fp, ep, np_ = [of[t] for t in texts], [of[t] for t in edited], [of[t] for t in followers]
    return [ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [f"{x:016x}" for x in fp], [f"{x:016x}" for x in ep],
            [likeness(x, y) for x, y in zip(fp, ep)], [likeness(x, y) for x, y in zip(fp, np_)]]


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (see :func:`with_next`; documents in
    descending id order, equal ids by a hash of the text, after the last the first), and their likeness.

    One shuffle by id range; inside a range each text meets the next as the rows go by, and only the first and last
    text of a range cross its edge."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / parts for i in range(1, parts)]
    bounds = []
    if at:  # a sketch whose size is set by the number of ranges
        bounds = sorted(set(docs.agg(F.percentile_approx(F.col(id_col).cast("long"), at, 20 * parts)).first()[0] or []))
    bounds = np.array(bounds, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = len(bounds) - np.searchsorted(bounds, b.column(0).fill_null(0).to_numpy(), "left")
            part = np.where(b.column(0).is_null(), len(bounds), part)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *b.columns], ["part", *b.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_id, part = None, None, None

        def edge(**columns):
            return pa.RecordBatch.from_pylist([{"part": part, **columns}], schema=_OUT)
        for b in batches:
            for p in sorted(set(b.column(0).to_pylist())):
                rows = b.filter(pa.compute.equal(b.column(0), p))
                ids, texts = rows.column(1).to_pylist(), [t or "" for t in rows.column(2).to_pylist()]
                if p != part:
                    if part is not None:
                        yield edge(tail=last, doc_id=last_id)
                    part = p
                    yield edge(head=texts[0])
                else:
                    ids, texts = [last_id, *ids], [last, *texts]
                last, last_id = texts[-1], ids[-1]
                if len(texts) > 1:
                    n = len(texts) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(_compared(ids[:-1], texts[:-1], texts[1:]), _OUT.types)]
                        + [pa.array([p] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], schema=_OUT)
        if part is not None:
            yield edge(tail=last, doc_id=last_id)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("tie"))
    placed = texts.mapInArrow(place, "part int, doc_id long, text string, tie long")
    ordered = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.desc("doc_id"), "tie")
    found = scratch_table(ordered.select("part", "doc_id", "text").mapInArrow(walk, f"{_ROW}, part int, head string, tail string"),
                          "neighbours")
    # the ranges' edges: one row a range; the range after the last is the first
    heads = found.where("head IS NOT NULL").select("part", F.col("head").alias("following"))
    order = Window.orderBy("part")
    after = (heads.select("part").withColumn("next", F.lead("part").over(order))
             .withColumn("first", F.min("part").over(Window.partitionBy())).select("part", F.coalesce("next", "first").alias("next")))
    tails = (found.where("tail IS NOT NULL").select("part", "doc_id", "tail").join(after, "part")
             .join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "tail", "following"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = _compared(*[c.to_pylist() for c in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _OUT.types)], _COLUMNS)

    inner = found.where("head IS NULL AND tail IS NULL").select(*_COLUMNS)
    return inner.unionByName(tails.mapInArrow(finish, _ROW))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """For each distinct query fingerprint, every distinct fingerprint within the radius: (query, fingerprint,
    distance, rows), and ``first_id``, the smallest doc_id that has it, if ``prints`` has a doc_id. Both tables: a
    ``fingerprint`` column of 16 hex digits. The queries are a stated set; copies (equal fingerprints) are counted
    before they are joined."""
    blocks = radius + SPARE
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in c) for c in combinations(range(blocks), SPARE)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    as_long = F.expr("cast(conv(fingerprint, 16, -10) as long)")
    ids = [F.min("doc_id").alias("first_id")] if "doc_id" in prints.columns else []

    def keyed(df: DataFrame, name: str) -> DataFrame:
        # one key of the table and its block; keys that clash only make meetings that the distance refuses
        keys = F.posexplode(F.array(*[F.xxhash64(F.lit(i), F.col(name).bitwiseAND(F.lit(m))) for i, m in enumerate(signed)]))
        return df.select("*", keys.alias("table", "_block"))

    copies = prints.groupBy(as_long.alias("_f")).agg(F.count(F.lit(1)).alias("rows"), *ids)
    rows = keyed(copies, "_f").drop("table")
    asked = keyed(queries.select(as_long.alias("_q")).distinct(), "_q")
    differ = F.col("_f").bitwiseXOR(F.col("_q"))
    # a pair that agrees in several tables counts in the first of them only
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(signed)])
    met = maybe_broadcast(scratch_table(asked, "queries")).join(
        rows.withColumnRenamed("_block", "_at"), (F.col("_block") == F.col("_at")) & (F.bit_count(differ) <= radius) & (first == F.col("table")))
    hexa = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return met.select(hexa("_q").alias("query"), hexa("_f").alias("fingerprint"), F.bit_count(differ).cast("int").alias("distance"), "rows",
                      *["first_id" for _ in ids])


def neighbours_in_radius(found: DataFrame, every: int = 20, radius: int = 3) -> DataFrame:
    """The rows of :func:`neighbour_fingerprints` (stored) with what the search finds for the documents whose doc_id is a
    multiple of ``every``: rows_within (other rows within the radius), nearest (the smallest distance of one of them, null
    if there is none), first_within (smallest doc_id within the radius, its own counted). All others have nulls."""
    is_query = F.coalesce(F.pmod(F.col("doc_id"), F.lit(every)) == 0, F.lit(False))
    met = within_radius(found.select("doc_id", "fingerprint"), found.where(is_query), radius)
    other = F.when((F.col("distance") > 0) | (F.col("rows") > 1), F.col("distance"))
    per_query = met.groupBy("query").agg((F.sum("rows") - 1).alias("rows_within"), F.min(other).alias("nearest"),
                                         F.min("first_id").alias("first_within"))
    per_query = maybe_broadcast(scratch_table(per_query, "within"))
    return found.join(per_query, is_query & (F.col("fingerprint") == F.col("query")), "left").drop("query")
