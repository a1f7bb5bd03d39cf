"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors.

1. Each vector is scaled to length 1 and mapped by a random matrix with orthonormal columns (seeded; more rows than
   columns when more bits are needed). The signs are its binary code. Stored with it is the correction factor a, the inner
   product of the mapped vector with its own code (as a unit vector). For any unit vector q,
   <code, mapped q> / a is an unbiased estimate of the cosine, and its error is below EPSILON * sqrt((1 - a^2) / a^2 / (bits - 1)) but for a
   chance of about 3e-5 (EPSILON standard deviations).
2. Candidates meet in buckets: the first bits of the code form ``tables`` keys of ``width`` bits. Two vectors at the threshold agree in a bit
   with probability 1 - angle / pi, and there are as many tables as it takes for the chance MISS that they meet in none. The width
   grows with the logarithm of the rows, so buckets keep their size.
3. Inside a bucket both estimates of a pair (either code against the other vector) plus their bounds must reach the threshold; only
   then is the cosine computed, in double precision, and it alone decides. A pair is counted in the first table that it shares.
   Tasks give sums of links a row and each row's smallest partner group, never pairs.

Large groups. Equal vectors are one row with a count. Groups of near copies that hold more than about one row in a thousand show in a
bounded sample (SAMPLE rows, by hash): their centres are found there, and every row within half the threshold's angle of a centre
belongs to that centre's ball. All members of a ball are linked with each other (triangle inequality, SAFE below the half angle), so
these links are counted, not compared. A bucket above BLOCK rows is cut: the members of its largest ball meet only the other rows,
block by block; other rows meet in pairs of blocks. Nothing is capped or left out.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different length are never linked.
Null ids link like others and name a component only if all its members' ids are null; repeated rows are copies. A very long vector needs a matrix of
(bits x length) doubles in each task. An empty table gives no rows. Only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwise.llm.common import SEED, maybe_broadcast, scratch_table, small_batches
from clickwise.llm.components import components

THRESHOLD = 0.95
EPSILON = 4.0
#: Chance that two vectors exactly at the threshold meet in no table (less for nearer ones).
MISS = 0.005
#: Mean rows of a bucket that the key width aims at, and rows above which a bucket is cut into blocks.
BUCKET = 128
BLOCK = 1024
#: Rows of the sample in which centres of large groups are looked for, and how many of them make a group.
SAMPLE = 8192
GROUP = 8
#: Tables whose buckets are shuffled at once (bounds the disk that they need).
TABLES_AT_ONCE = 4
SAFE = 1e-6


@lru_cache(maxsize=2)
def rotation(bits: int, dim: int, seed: int = SEED) -> np.ndarray:
    """(bits x dim), orthonormal columns; a Python worker keeps the last ones."""
    q, r = np.linalg.qr(np.random.default_rng([seed, bits, dim]).standard_normal((bits, dim)))
    return q * np.sign(np.diag(r))


def layout(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(width of a key in bits, number of tables) for so many rows."""
    width = min(31, max(4, math.ceil(math.log2(max(rows, 1) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def code_bits(width: int, tables: int, dim: int) -> int:
    return max(-(-width * tables // 8) * 8, -(-dim // 8) * 8, 64)


def encode(unit: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mapped vectors, signs as booleans, correction factors)."""
    mapped = unit @ rotation(bits, unit.shape[1]).T
    return mapped, mapped > 0, np.abs(mapped).sum(axis=1) / math.sqrt(bits)


def _keys(signs: np.ndarray, width: int, tables: int) -> np.ndarray:
    return signs[:, :width * tables].reshape(len(signs), tables, width) @ (1 << np.arange(width, dtype=np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls and with lists of one length, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(sample: np.ndarray, half: float) -> np.ndarray:
    """Centres of the sample's large groups: in the order of the sample, the first rows that no centre covers
    and around which at least GROUP uncovered rows lie."""
    free, out = np.ones(len(sample), bool), []
    for start in range(0, len(sample), 512):
        near = sample[start:start + 512] @ sample.T >= half
        for i in np.flatnonzero(free[start:start + 512]):
            mine = near[i] & free
            if free[start + i] and mine.sum() >= GROUP:
                out.append(sample[start + i])
                free &= ~mine
    return np.array(out).reshape(len(out), sample.shape[1])


def _same_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            return root
    return root


_LINKED = pa.schema([("cls", pa.binary()), ("n", pa.int64()), ("root", pa.binary())])
_LINKED_SQL = "cls binary, n long, root binary"


def _compare(threshold: float):
    """The task of one block pair of a bucket: rows with links, how many, and the first row of their group here."""

    def compare(group: pa.Table) -> pa.Table:
        # sort rows so that the outcome does not depend on the order of arrival
        group = group.combine_chunks().sort_by("cls")
        col = {c: group.column(c).combine_chunks() if group.num_rows else None for c in group.column_names}
        side, table = col["side"].to_numpy(), int(col["table"][0].as_py())
        keys = _matrix(col["keys"]).astype(np.int64)[:, :table]
        copies, ball = col["copies"].to_numpy(), col["ball"].fill_null(-1).to_numpy()
        signs = np.unpackbits(np.frombuffer(b"".join(col["code"].to_pylist()), np.uint8).reshape(len(side), -1), axis=1)
        unit, factor, bits = _unit(_matrix(col["vec"])), col["factor"].to_numpy(), signs.shape[1]
        mapped = (unit @ rotation(bits, unit.shape[1]).T).astype(np.float32)
        code = (signs.astype(np.float32) * 2 - 1) / math.sqrt(bits)
        bound = EPSILON * np.sqrt(np.maximum(0, 1 - factor ** 2) / factor ** 2 / (bits - 1))
        rows, columns = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        links, a_all, b_all = np.zeros(len(side), np.int64), [], []
        for s in range(0, len(rows), 256):
            i = rows[s:s + 256]
            by_row = (code[i] @ mapped[columns].T) / factor[i, None] + bound[i, None]
            by_column = (mapped[i] @ code[columns].T) / factor[None, columns] + bound[None, columns]
            maybe = (np.minimum(by_row, by_column) >= threshold) & ((ball[i, None] != ball[None, columns]) | (ball[i, None] < 0))
            maybe &= (side[i, None] != 2) | (i[:, None] < columns[None, :])
            x, y = np.nonzero(maybe)
            a, b = i[x], columns[y]
            for e in range(0, len(a), 1 << 14):
                p, q = a[e:e + (1 << 14)], b[e:e + (1 << 14)]
                ok = np.einsum("ij,ij->i", unit[p], unit[q]) >= threshold
                p, q = p[ok], q[ok]
                first = ~(keys[p] == keys[q]).any(axis=1)
                p, q = p[first], q[first]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                a_all.append(p)
                b_all.append(q)
        if not a_all:
            return _LINKED.empty_table()
        root = _same_roots(len(side), np.concatenate(a_all), np.concatenate(b_all))
        some = np.flatnonzero(links)
        return pa.table([col["cls"].take(pa.array(some)), pa.array(links[some]), col["cls"].take(pa.array(root[some]))], schema=_LINKED)

    return compare


def _coded(classes: DataFrame, dim: int, width: int, tables: int, threshold: float) -> DataFrame:
    """Vectors of one length with code, factor, keys and ball (the centre's number; null: none)."""
    spark, bits = classes.sparkSession, code_bits(width, tables, dim)
    half = math.cos(math.acos(threshold) / 2) + SAFE
    picked = classes.orderBy(F.xxhash64(F.lit(SEED), "cls"), "cls").limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    centres = spark.sparkContext.broadcast(_centres(_unit(_matrix(picked)), half))
    schema = pa.schema([("cls", pa.binary()), ("code", pa.binary()), ("factor", pa.float64()), ("keys", pa.list_(pa.int32())), ("ball", pa.int32())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            unit = _unit(_matrix(b.column(1)))
            _, signs, factor = encode(unit, bits)
            keys = _keys(signs, width, tables).astype(np.int32)
            ball = np.full(len(unit), -1, np.int32)
            if len(centres.value):
                near = unit @ centres.value.T
                best = near.argmax(axis=1)
                ball = np.where(near[np.arange(len(unit)), best] >= half, best, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in np.packbits(signs, axis=1)], pa.binary()), pa.array(factor),
                 pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), keys.reshape(-1)),
                 pa.array(ball, mask=ball < 0)], schema=schema)

    coded = classes.select("cls", "vec").mapInArrow(code, "cls binary, code binary, factor double, keys array<int>, ball int")
    return scratch_table(coded.join(classes, "cls"), "codes")


def _blocks(rows: DataFrame, tables: list[int]) -> DataFrame:
    """One row for each vector, table and block pair that it takes part in: side 2 meets all, 0 meets 1."""
    at = F.array(*[F.lit(t) for t in tables])
    entries = rows.withColumn("table", F.explode(at)).withColumn("key", F.expr("keys[table]"))
    by_ball = entries.groupBy("table", "key", "ball").agg(F.count(F.lit(1)).alias("_n"))
    large = by_ball.groupBy("table", "key").agg(
        F.sum("_n").alias("_rows"), F.max(F.when(F.col("ball").isNotNull(), F.struct("_n", "ball"))).alias("_top")).where(f"_rows > {BLOCK}")
    large = scratch_table(large.select(
        F.col("table").alias("_table"), F.col("key").alias("_key"), F.col("_top.ball").alias("_ball"),
        F.expr(f"cast(ceil(coalesce(_top._n, 0) / {BLOCK}) AS int)").alias("_inner"),
        F.expr(f"cast(greatest(ceil((_rows - coalesce(_top._n, 0)) / {BLOCK}), 1) AS int)").alias("_outer")), "large-buckets")
    e = entries.join(maybe_broadcast(large), (F.col("table") == F.col("_table")) & (F.col("key") == F.col("_key")), "left")
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), "cls"), F.when(F.col("ball") == F.col("_ball"), F.col("_inner")).otherwise(F.col("_outer"))).cast("int")
    # numbers of the block pairs of a bucket: outer x outer (i <= j), then inner x outer
    pairs = F.expr("""CASE
        WHEN _outer IS NULL THEN array(struct(0 AS pair, 2 AS side))
        WHEN ball <=> _ball AND ball IS NOT NULL THEN transform(sequence(0, _outer - 1), j -> struct(_outer * _outer + _place * _outer + j AS pair, 0 AS side))
        ELSE concat(transform(sequence(0, _outer - 1), j -> struct(least(_place, j) * _outer + greatest(_place, j) AS pair,
                                                                   IF(_place = j, 2, IF(_place < j, 0, 1)) AS side)),
                    IF(_inner > 0, transform(sequence(0, _inner - 1), i -> struct(_outer * _outer + i * _outer + _place AS pair, 1 AS side)),
                       array())) END""")
    return (e.withColumn("_place", place).withColumn("_p", F.explode(pairs))
            .select("table", "key", F.col("_p.pair").alias("pair"), F.col("_p.side").alias("side"), "cls", "vec", "code", "factor", "keys", "ball", "copies"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                 miss: float = MISS) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows at cosine >= threshold), component_id (smallest vec_id reachable), kept."""
    spark = vectors.sparkSession
    small_batches(spark)
    vec = F.col(vec_col)
    if not isinstance(vectors.schema[vec_col].dataType.elementType, (T.FloatType, T.DoubleType)):
        vec = vec.cast("array<double>")
    usable = F.expr("size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).withColumn("_ok", F.coalesce(usable, F.lit(False)))
    # equal vectors are one class: its key is the digest of the components
    cls = F.unhex(F.md5(F.array_join(F.transform("vec", lambda x: F.hex(x.cast("string").cast("binary"))), ",").cast("binary")))
    rows = scratch_table(rows.withColumn("cls", F.when(F.col("_ok"), cls)).drop("_ok"), "vectors")
    first = F.min(F.struct(F.col("vec_id").isNull().alias("null"), F.col("vec_id").alias("id")))
    classes = scratch_table(rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), first.alias("rep")), "vector-classes")

    linked, links = [], []
    lengths = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]  # the lengths of vectors in use
    for dim in sorted(lengths):
        same = classes.where(F.size("vec") == dim)
        width, tables = layout(same.count(), threshold, miss)
        coded = _coded(same.select("cls", "vec", "copies"), dim, width, tables, threshold)
        balls = scratch_table(coded.where("ball IS NOT NULL").groupBy("ball").agg(F.sum("copies").alias("_m"), F.min("cls").alias("root")), "balls")
        in_ball = coded.select("cls", "ball", "copies").join(F.broadcast(balls), "ball")  # at most SAMPLE / GROUP balls
        linked.append(in_ball.select("cls", (F.col("_m") - F.col("copies")).alias("n")))
        links.append(in_ball.select(F.col("cls").alias("a"), F.col("root").alias("b")))
        for t in range(0, tables, TABLES_AT_ONCE):
            found = scratch_table(_blocks(coded, list(range(t, min(t + TABLES_AT_ONCE, tables)))).groupBy("table", "key", "pair")
                                  .applyInArrow(_compare(threshold), _LINKED_SQL), "linked")
            linked.append(found.select("cls", "n"))
            links.append(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))

    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    all_linked, all_links = linked[0], links[0]
    for x, y in zip(linked[1:], links[1:]):
        all_linked, all_links = all_linked.unionByName(x), all_links.unionByName(y)
    roots = components(all_links).select(F.col("node").alias("_node"), "root")
    sums = all_linked.groupBy(F.col("cls").alias("_cls")).agg(F.sum("n").alias("_n"))
    named = scratch_table(classes.select("cls", "copies", "rep").join(roots, F.col("cls") == F.col("_node"), "left")
                          .join(sums, F.col("cls") == F.col("_cls"), "left")
                          .select("cls", (F.col("copies") - 1 + F.coalesce("_n", F.lit(0))).alias("n_links"), "rep",
                                  F.coalesce("root", "cls").alias("root")), "named")
    reps = named.groupBy("root").agg(F.min("rep.id").alias("_first"))
    of_class = named.join(reps, "root").select(F.col("cls").alias("_cls"), "n_links", "_first")
    alone = F.col("cls").isNull()
    return (rows.join(of_class, F.col("cls") == F.col("_cls"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(alone, F.col("vec_id")).otherwise(F.col("_first")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
