"""Near-duplicate detection: one-permutation hashing with optimal densification, banded buckets and
star-shaped candidate edges.

1. A text's set of word shingles is hashed once; the hash range is cut into BINS bins and each keeps its
   smallest hash. An empty bin takes the value of the first filled one in its own fixed random order of the
   bins (optimal densification). BANDS bands of ROWS bins give the bucket keys: two texts at the threshold
   0.8 share no bucket with a probability of 5e-8. Equal sets count as one class before.
2. In each bucket one member is the centre of a star; candidate edges lead from it to the other members, so
   their number is that of the bucket rows, not of the pairs.
3. Links are confirmed on the full shingle sets: first each member's edge to its smallest centre, then those
   edges that still lead between different components.
4. What stars leave out: where a bucket of three or more still holds several components, its members are
   compared across components. Shingles that at most FEW of them hold are matched directly; a pair that shares none of
   those can only be similar if both hold few of them and share one of the rarest others (the rarest
   n - ceil(0.8 n) + 1 shingles of similar texts always meet). Such a pair is taken once, at its first common
   shingle, if the heads of both lists share enough for the rest to reach the threshold. All bounds are exact:
   they drop pairs below the threshold only. What is left is confirmed in the same way.

Null and empty texts, and texts of white space alone, have an empty set and are linked with nothing. Repeated
rows and equal sets are one class. A null doc_id never names a component unless all of its members' are
null; ties for the centre of a bucket go to the smallest digest. A very long text is hashed whole, its set of shingles held by one task (8 bytes a
shingle). An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.llm.common import maybe_broadcast, scratch_table, small_batches, text_key, without_rows
from clickwise.llm.components import components
from clickwise.llm.words import Words, groups, keys, mix64

ROWS = 4
BANDS = 32
BINS = ROWS * BANDS
PERCENT = 80
#: A shingle that at most so many of the compared texts hold is counted out (see step 4).
FEW = 16
#: Shingles of a text that are compared before its whole set is.
HEAD = 64
CARRIED = ("cls", "label", "n", "few", "_r", "head", "last", "rest")

_order = np.argsort(keys(BINS * BINS, 11).reshape(BINS, BINS), axis=1)
#: _RANK[i, j]: when bin i, if empty, asks bin j
_RANK = np.empty((BINS, BINS), np.int16)
np.put_along_axis(_RANK, _order, np.arange(BINS, dtype=np.int16)[None, :].repeat(BINS, 0), axis=1)
_EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1))
_ROW_KEYS = keys(BINS, 12).reshape(BANDS, ROWS)
_BAND_KEYS = keys(BANDS, 13)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """One value for each bin of a sorted, non-empty set."""
    at = np.searchsorted(shingle_set, _EDGES)
    full = at < np.append(at[1:], len(shingle_set))
    values = shingle_set[np.minimum(at, len(shingle_set) - 1)]
    if not full.all():
        filled = np.flatnonzero(full)
        empty = np.flatnonzero(~full)
        values[empty] = values[filled[_RANK[np.ix_(empty, filled)].argmin(axis=1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    return mix64(mix64((values.reshape(BANDS, ROWS) * _ROW_KEYS).sum(axis=1)) ^ _BAND_KEYS)


def _sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    for group in groups(texts):
        w = Words(group, lower=True)
        for i in range(len(w)):
            yield np.unique(w.ngrams(i, width))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text key, n_shingles, class (digest of the set; null if empty) and bucket keys."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, bands = [], [], []
            for s in _sets(b.column(2).to_pylist(), width):
                n.append(len(s))
                cls.append(_digest(s) if len(s) else None)
                bands.append(band_keys(signature(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(profile, "doc_id long, key long, n long, cls binary, bands array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, n, set) of the classes in ``wanted`` (stored: cls, id, key), read again from one text of each."""
    schema = pa.schema([("cls", pa.binary()), ("n", pa.int64()), ("set", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(_sets(b.column(1).to_pylist(), width))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    w = maybe_broadcast(wanted.select("cls", F.col("id").alias("_id"), F.col("key").alias("_key")))
    texts = docs.join(w, docs["doc_id"].eqNullSafe(w["_id"]) & (docs["key"] == w["_key"]))
    return scratch_table(texts.select("cls", "text").mapInArrow(read, "cls binary, n long, set binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b"))
    return scratch_table(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
                         .mapInArrow(check, "a binary, b binary"), "confirmed")


def _labelled(rows: DataFrame, roots: DataFrame, node: str, label: str) -> DataFrame:
    r = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(r, F.col(node) == F.col("_node"), "left").select(*rows.columns, F.coalesce("_root", node).alias(label))


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that lead between different components."""
    return _labelled(_labelled(pairs, roots, "a", "_la"), roots, "b", "_lb").where("_la <> _lb").select("a", "b")


def _similar_sizes(a: str, b: str, percent: int):
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _residual_pairs(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 4: pairs across components in buckets that stars have not joined."""
    rows = scratch_table(_labelled(members.where("count > 2").select("key", "cls"), roots, "cls", "label"), "left")
    mixed = scratch_table(rows.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_h"))
                          .where("_l <> _h").select("key"), "mixed")
    nodes = scratch_table(rows.join(mixed, "key", "left_semi").select("cls", "label").distinct(), "left-nodes")
    whole = sets.dropDuplicates(["cls"]).join(nodes, "cls")
    schema = pa.schema([("cls", pa.binary()), ("label", pa.binary()), ("n", pa.int64()), ("sh", pa.int64())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                s = np.frombuffer(b.column(3)[i].as_buffer(), np.int64)
                one = b.slice(i, 1)
                again = pa.array(np.zeros(len(s), np.int32))
                yield pa.RecordBatch.from_arrays([one.column(j).take(again) for j in range(3)] + [pa.array(s)], schema=schema)

    shingles = scratch_table(whole.select("cls", "label", "n", "set")
                             .mapInArrow(explode, "cls binary, label binary, n long, sh long"), "left-shingles")
    df = scratch_table(shingles.groupBy("sh").agg(F.count(F.lit(1)).alias("df")), "left-df")
    counted = scratch_table(shingles.join(df, "sh"), "left-counted")
    # the shingles that only few hold can be counted out: a pair shares those it meets in, and no others
    few = scratch_table(counted.groupBy("cls").agg(F.count_if(F.col("df") <= FEW).alias("few")), "left-few")
    known = scratch_table(counted.where("df > 1").join(few, "cls"), "left-known")
    side = [F.col(c).alias(f"{c}_{x}") for x in "ab" for c in ("cls", "label", "n", "few")]
    a, b = (known.select("sh", "df", *side[i:i + 4]) for i in (0, 4))
    possible = "percent * (n_a + n_b) <= (100 + percent) * (shared + least(n_a - few_a, n_b - few_b))".replace("percent", str(percent))

    few_rows = (a.where(F.col("df") <= FEW).join(b.where(F.col("df") <= FEW).drop("df"), "sh")
                .where("cls_a < cls_b AND label_a <> label_b").where(_similar_sizes("n_a", "n_b", percent)))
    by_few = (few_rows.groupBy("cls_a", "cls_b", "n_a", "n_b", "few_a", "few_b").agg(F.count(F.lit(1)).alias("shared"))
              .where(possible).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")))

    # pairs that share none of those: both hold few of them, and share one of the rarest of the others
    rare = Window.partitionBy("cls").orderBy("df", "sh")
    core = known.where(f"100 * few <= (100 - {percent}) * n")
    ranked = scratch_table(core.where(F.col("df") > FEW).withColumn("_r", F.row_number().over(rare) + F.col("few")), "left-ranked")
    heads = scratch_table(ranked.where(F.col("_r") <= F.col("few") + HEAD).groupBy("cls", "n", "few")
                          .agg(F.array_sort(F.collect_list(F.struct("df", "sh"))).alias("_head"))
                          .select(F.col("cls").alias("_c"), F.col("_head.sh").alias("head"), F.when(F.size("_head") == HEAD, F.col("_head")[HEAD - 1])
                                  .alias("last"), F.when(F.size("_head") == HEAD, F.col("n") - F.col("few") - HEAD).otherwise(0).alias("rest")), "heads")
    prefix = scratch_table(ranked.where(F.col("_r") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
                           .join(heads, F.col("cls") == F.col("_c")).select("sh", *CARRIED), "left-prefix")
    by_label = prefix.groupBy("sh", "label").agg(F.count(F.lit(1)).alias("_c"))
    most = scratch_table(by_label.groupBy("sh").agg(F.max_by("label", F.struct("_c", "label")).alias("_most"),
                                                    F.count(F.lit(1)).alias("_k")).where("_k > 1").select("sh", "_most"), "left-most")
    stray = scratch_table(prefix.join(most, "sh").where("label <> _most")
                          .select("sh", "_most", *[F.col(c).alias(f"{c}_a") for c in CARRIED]), "strays")
    other = prefix.select("sh", *[F.col(c).alias(f"{c}_b") for c in CARRIED])
    near = possible.replace("shared", "0")
    # the rarest common shingle is among the first of the smaller text; before it nothing is common, and of the
    # counted-out ones none is
    place = (f"{percent} * (n_a + n_b) <= (100 + {percent}) * (least(_r_a - few_a, _r_b - few_b) + least(n_a - _r_a, n_b - _r_b))"
             f" AND CASE WHEN n_a < n_b OR n_a = n_b AND cls_a < cls_b THEN _r_a <= n_a - ceil(2 * {percent} * n_a / (100 + {percent})) + 1"
             f" ELSE _r_b <= n_b - ceil(2 * {percent} * n_b / (100 + {percent})) + 1 END")
    # a pair is taken at its first common shingle, if the heads (the first shingles of each, in one order for all)
    # share enough: up to the end of the shorter-reaching head what they share is known
    share = "array_intersect(head_a, head_b)"
    first = f"size({share}) = 0 OR {share}[0] = sh"
    rest = "CASE WHEN last_a IS NULL THEN IF(last_b IS NULL, 0, rest_b) WHEN last_b IS NULL OR last_a <= last_b THEN rest_a ELSE rest_b END"
    enough = f"{percent} * (n_a + n_b) <= (100 + {percent}) * (size({share}) + {rest})"
    by_rest = (stray.join(other, "sh").where(F.col("label_a") != F.col("label_b")).where(_similar_sizes("n_a", "n_b", percent))
               .where("label_b = _most OR cls_a < cls_b").where(near).where(place).where(first).where(enough)
               .select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")))
    return scratch_table(by_few.union(by_rest).distinct(), "left-pairs")


def near_groups(docs: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_key, n_shingles, component_id, component_key, kept.

    ``width``: words in a shingle. Linked: 100 * intersection >= percent * union; ``component_id`` is the smallest
    doc_id reachable over links. (component_id, component_key) is one row of the component, or several if rows
    are repeated; ``kept``: doc_id = component_id. Bands are laid out for percent >= 80."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("key"),
                        F.col(text_col).alias("text"))
    rows = scratch_table(_profiles(texts, width), "profiles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), "key"))
    classes = scratch_table(rows.where("cls IS NOT NULL").groupBy("cls", "n").agg(first.alias("rep"), F.first("bands").alias("bands")),
                            "classes")

    banded = classes.select("cls", "n", F.explode("bands").alias("key"))
    buckets = scratch_table(banded.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("centre"), F.count(F.lit(1)).alias("count"))
                            .where("count > 1"), "buckets")
    members = scratch_table(banded.join(buckets, "key").select(
        "key", "cls", "n", "count", F.col("centre.cls").alias("centre"), F.col("centre.n").alias("centre_n")), "members")
    edges = scratch_table(members.where("cls <> centre").where(_similar_sizes("n", "centre_n", percent))
                          .select(F.col("centre").alias("a"), F.col("cls").alias("b")).distinct(), "edges")
    wanted = (edges.select(F.col("a").alias("cls")).union(edges.select("b")).union(members.where("count > 2").select("cls"))
              .distinct())
    sets = _full_sets(texts, scratch_table(classes.join(wanted, "cls").select("cls", "rep.id", "rep.key"), "wanted"), width)

    links = _confirmed(edges.groupBy("b").agg(F.min("a").alias("a")), sets, percent)
    roots = components(links)
    links = links.union(_confirmed(_across(edges, roots), sets, percent))
    roots = components(links)
    links = links.union(_confirmed(_residual_pairs(members, roots, sets, percent), sets, percent))
    roots = components(links)

    named = scratch_table(_labelled(classes.select("cls", "rep"), roots, "cls", "root"), "named")
    reps = scratch_table(named.groupBy("root").agg(F.min("rep").alias("rep")), "reps")
    of_class = scratch_table(named.select("cls", "root").join(reps, "root").select(
        F.col("cls").alias("_cls"), F.col("rep.id").alias("_id"), F.col("rep.key").alias("_key")), "class-reps")
    out = rows.join(of_class, F.col("cls") == F.col("_cls"), "left")
    alone = F.col("cls").isNull()
    return out.select("doc_id", F.col("key").alias("text_key"), F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"),
                      F.when(alone, F.col("key")).otherwise(F.col("_key")).alias("component_key"),
                      F.coalesce(F.col("doc_id") == F.when(alone, F.col("doc_id")).otherwise(F.col("_id")), F.lit(False)).alias("kept"))


def drop_near(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns unchanged. Exact copies (the same id
    and text) are taken as removed before; if not, copies of the row that stays all stay."""
    groups_ = near_groups(docs, width, percent)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    gone = groups_.where(~stays).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return without_rows(docs, scratch_table(gone, "near-gone"))
