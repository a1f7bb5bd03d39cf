"""Prefix trie of conversations from padded turn-id matrices.

Every conversation is one row: the 128-bit ids of its turns (role and text), one after another. The rows are range-sharded in
the order of these sequences (ties by conv_id), so the members of a node - a distinct sequence of first turns - are neighbours.

1. In a shard the ids form a matrix, padded at the right. numpy.lexsort orders its rows, a column at a time for those rows
   that reach it; the masks of the columns that change from one row to the next, OR-accumulated over the columns, mark at
   each depth where a node starts, and ``reduceat`` sums each node's members. Sums over subtrees run from the deepest column up.
2. A node that holds neither the first nor the last row of its shard is whole there. The others lie on two paths a shard
   (the boundary rows). Their parts are recombined by the same code: the paths are rows again, with the parts as weights. There are two
   paths a shard, so their number is set by the number of shards, not by the data.
3. The ids of the conversations that end at a boundary node come as one ready-made run a shard, and are hashed run after run.

Conversations are ordered by turn, null first; equal turn numbers by the id of the turn (a hash), so repeated rows are turns next to
each other. Null roles and texts are empty. A row without a conv_id belongs to no conversation. A very long text is read for its id and its
length only; a conversation is one row of about 24 bytes a turn in one task, so a very long one is bounded by that. An empty table gives no rows.
Only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.llm.common import maybe_broadcast, scratch_table, small_batches

ID_BYTES = 16
#: the key of the root, which has no turns
ROOT = hashlib.blake2b(digest_size=ID_BYTES).digest()


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, turns (array of (id in hex, code points), in order)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length keeps (role, text) apart from other cuts of the same letters
    token = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    t = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), token.alias("id"), F.length(text).alias("chars")).alias("t"))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_openings(seqs: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """Rebuild each conversation c: the first h turns of conversation c - c % ``every`` (all if fewer, none if absent), then its
    own turns after its first h; h = crc32(decimal c) % ``heads``. At most 2 * ``every`` conversations share one head."""
    first = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    same = Window.partitionBy("_first")
    s = (seqs.withColumn("_first", first).withColumn("_h", h)
         .withColumn("_head", F.max(F.when(F.col("conv_id") == F.col("_first"), F.expr(f"slice(turns, 1, {heads - 1})"))).over(same)))
    own = F.expr("slice(turns, _h + 1, greatest(size(turns) - _h, 0))")
    return s.select("conv_id", F.concat(F.coalesce(F.expr("slice(_head, 1, _h)"), F.expr("slice(turns, 1, 0)")), own).alias("turns"))


class _Level:
    """The nodes of one depth: their first rows, the parent's place among the nodes above, and what is summed."""

    def __init__(self, start, end, parent, n, least, chars, children, leaves, saved):
        self.start, self.end, self.parent = start, end, parent
        self.n, self.least, self.chars, self.children, self.leaves, self.saved = n, least, chars, children, leaves, saved
        self.open = np.zeros(len(start), bool)


class _Matrix:
    """Turn ids of sorted rows, kept as the columns of a padded matrix without its padding: row r's turns are
    flat[first[r]:first[r + 1]]."""

    def __init__(self, seqs: list[bytes], conv: np.ndarray):
        lengths = np.array([len(s) // ID_BYTES for s in seqs], np.int64)
        flat = np.frombuffer(b"".join(seqs), ">u8").astype(np.uint64).reshape(-1, 2)
        first = np.concatenate([[0], np.cumsum(lengths)])
        order = self._sorted(flat, first, lengths, conv)
        self.order, self.length, self.conv = order, lengths[order], conv[order]
        self.flat, self.first = flat, first[:-1][order]

    @staticmethod
    def _sorted(flat, first, lengths, conv) -> np.ndarray:
        """Rows in the order of their sequences, a prefix before what continues it, then by conv_id: a column at a time, the
        rows that are still tied and reach it."""
        order = np.lexsort((conv, lengths))  # settles rows without turns
        group = np.zeros(len(order), np.int64)  # rows of a group are equal so far
        live, d = np.arange(len(order)), 0
        while len(live):
            rows = order[live]
            has = lengths[rows] > d
            at = first[rows] + d
            hi, lo = (np.where(has, flat[np.where(has, at, 0), c], 0) if len(flat) else np.zeros(len(rows), np.uint64) for c in (0, 1))
            g = group[live]
            by = np.lexsort((conv[rows], lo, hi, has, g))
            order[live] = rows[by]
            has, hi, lo, g = has[by], hi[by], lo[by], g[by]
            new = np.ones(len(by), bool)
            new[1:] = (g[1:] != g[:-1]) | (has[1:] != has[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            group[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
            alone = new & np.append(new[1:], True)
            live = live[has & ~alone]
            d += 1
        return order

    def levels(self, n, least, children, leaves, saved, chars) -> list[_Level]:
        """The nodes of each depth from 0. The arguments are weights of the rows: ``n`` and ``least`` (smallest conv_id) of a
        row at every depth, or functions of the rows and a depth; so are the closed ``children``, ``leaves`` and ``saved``."""
        rows = np.arange(len(self.length))
        new = np.zeros(len(rows), bool)
        new[:1] = True
        node = np.zeros(len(rows), np.int64)
        out, d = [], 0
        while len(rows):
            start = np.flatnonzero(new)
            parent = node[start]
            node = np.cumsum(new) - 1
            level = _Level(rows[start], rows[np.append(start[1:], len(rows)) - 1], parent,
                           np.add.reduceat(n(rows, d), start), np.minimum.reduceat(least(rows, d), start), chars(rows[start], d),
                           np.add.reduceat(children(rows, d), start), np.add.reduceat(leaves(rows, d), start),
                           np.add.reduceat(saved(rows, d), start))
            out.append(level)
            on = self.length[rows] > d
            r = rows[on]
            pair = self.flat[self.first[r] + d] if len(r) else self.flat[:0]
            differs = np.ones(len(r), bool)
            # the masks of all columns so far, OR-accumulated: a change stays a change, and a row between that ends is one
            differs[1:] = np.any(pair[1:] != pair[:-1], axis=1) | (np.diff(r) > 1)
            acc = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))[on]  # where the node above begins
            differs[1:] |= acc[1:] != acc[:-1]
            rows, new, node, d = r, differs, node[on], d + 1
        return out


def _sum_up(levels: list[_Level], final: bool) -> None:
    """Add what each node gives to its parent, from the deepest level up. Unless ``final``, open nodes give nothing yet."""
    for d in range(len(levels) - 1, -1, -1):
        x = levels[d]
        known = np.ones(len(x.start), bool) if final else ~x.open
        leaf = known & (x.children == 0)
        x.leaves = x.leaves + leaf
        x.saved = x.saved + np.where(known, (x.n - 1) * x.chars, 0)
        if d:
            up = levels[d - 1]
            np.add.at(up.children, x.parent[known], 1)
            np.add.at(up.leaves, x.parent[known], x.leaves[known])
            np.add.at(up.saved, x.parent[known], x.saved[known])


_NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = pa.schema([(c, pa.int64()) for c in _NUMBERS] + [("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary())])
_PATH = pa.struct([("seq", pa.binary()), ("chars", pa.list_(pa.int64()))]
                  + [(c, pa.list_(pa.int64())) for c in ("n", "least", "children", "leaves", "saved")])
_SHARD = pa.schema([*_NODE, ("path", _PATH), ("run", pa.struct([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())]))])
_NODE_SQL = ", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string, key binary, parent_key binary"
_ARRAYS = ", ".join(f"{c}: array<long>" for c in ("chars", "n", "least", "children", "leaves", "saved"))
_SHARD_SQL = f"{_NODE_SQL}, path struct<seq: binary, {_ARRAYS}>, run struct<key: binary, first: long, ids: binary>"


def _keys(seq: bytes) -> list[bytes]:
    """The key of every prefix of a sequence, the root's first."""
    h, out = hashlib.blake2b(digest_size=ID_BYTES), [ROOT]
    for i in range(0, len(seq), ID_BYTES):
        h.update(seq[i:i + ID_BYTES])
        out.append(h.copy().digest())
    return out


def _shard_rows(conv: np.ndarray, seqs: list[bytes], chars: list[np.ndarray], room: int = 4096) -> Iterator[pa.RecordBatch]:
    m = _Matrix(seqs, conv)
    last = len(conv) - 1
    flat_chars = np.concatenate(chars) if chars else np.zeros(0, np.int64)
    one, none = (lambda r, d: np.ones(len(r), np.int64)), (lambda r, d: np.zeros(len(r), np.int64))
    levels = m.levels(one, lambda r, d: m.conv[r], none, none, none,
                      lambda r, d: flat_chars[m.first[r] + d - 1] if d else np.zeros(len(r), np.int64))
    for x in levels:
        x.open = (x.start == 0) | (x.end == last)
    _sum_up(levels, final=False)

    # the boundary paths: of the first row, and of the last where it leaves the first row's path
    paths, keys = [], {}
    for row in dict.fromkeys((0, last)):
        seq = seqs[m.order[row]]
        keys[row] = _keys(seq)
        part = {c: [] for c in ("chars", "n", "least", "children", "leaves", "saved")}
        for d in range(len(seq) // ID_BYTES + 1):
            x = levels[d]
            i = 0 if row == 0 else len(x.start) - 1
            mine = row == 0 or x.start[i] > 0  # else the first row's path has it
            for c in part:
                value = int(getattr(x, c)[i])
                part[c].append(value if mine or c in ("chars", "least") else 0)
        paths.append({"seq": seq, **part})
    yield pa.RecordBatch.from_arrays([pa.nulls(len(paths), f.type) for f in _NODE]
                                     + [pa.array(paths, _PATH), pa.nulls(len(paths), _SHARD.field("run").type)], schema=_SHARD)

    # where a node's own conversations end: the rows at its start that are no longer than its depth
    for d, x in enumerate(levels):
        ends = m.length[x.start] == d
        key = [keys[0][d] if s == 0 else keys[last][d] if e == last else None for s, e in zip(x.start.tolist(), x.end.tolist())]
        up = levels[d - 1] if d else None
        nodes, runs = [], []
        above = [None] * len(x.start) if up is None else [
            keys[0][d - 1] if up.start[p] == 0 else keys[last][d - 1] if up.end[p] == last else None for p in x.parent.tolist()]
        for i, (s, e) in enumerate(zip(x.start.tolist(), x.end.tolist())):
            own = np.searchsorted(m.length[s:e + 1] > d, True) if ends[i] else 0
            ids = ",".join(map(str, m.conv[s:s + own].tolist())).encode()
            if x.open[i]:
                if own:
                    runs.append({"key": key[i], "first": int(m.conv[s]), "ids": ids})
            else:
                parent = None if above[i] is not None else int(up.least[x.parent[i]])
                nodes.append((int(x.least[i]), d, parent, int(x.n[i]), int(x.children[i]), int(x.leaves[i]), int(x.saved[i]),
                              hashlib.sha256(ids).hexdigest(), None, above[i]))
            if len(nodes) >= room:
                yield _node_batch(nodes, _SHARD)
                nodes = []
        if nodes:
            yield _node_batch(nodes, _SHARD)
        if runs:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(runs), f.type) for f in _NODE]
                                             + [pa.nulls(len(runs), _PATH), pa.array(runs, _SHARD.field("run").type)], schema=_SHARD)


def _node_batch(nodes: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*nodes), _NODE)]
    return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(nodes), f.type) for f in schema][len(_NODE):], schema=schema)


def _recombine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All boundary paths (two a shard) -> the boundary nodes with their keys."""
    paths = [p for b in batches for p in b.column(0).to_pylist()]
    if not paths:
        return
    m = _Matrix([p["seq"] for p in paths], np.arange(len(paths)))
    rows = [paths[i] for i in m.order]

    def part(c):
        return lambda r, d: np.array([rows[i][c][d] for i in r.tolist()], np.int64)
    levels = m.levels(part("n"), part("least"), part("children"), part("leaves"), part("saved"), part("chars"))
    _sum_up(levels, final=True)
    above, key = [], []
    for d, x in enumerate(levels):
        own = [ROOT] if d == 0 else [
            hashlib.blake2b(rows[s]["seq"][:d * ID_BYTES], digest_size=ID_BYTES).digest() for s in x.start.tolist()]
        key.append(own)
        above = levels[d - 1] if d else None
        nodes = [(int(x.least[i]), d, None if above is None else int(above.least[x.parent[i]]), int(x.n[i]), int(x.children[i]),
                  int(x.leaves[i]), int(x.saved[i]), None, own[i], None) for i in range(len(own))]
        yield _node_batch(nodes, _NODE)


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ids) with the runs of a key one after another -> (key, SHA-256 of all ids, comma-joined)."""
    schema = pa.schema([("run_key", pa.binary()), ("sha", pa.string())])
    key, digest = None, None
    for b in batches:
        out = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(1)):
            if k != key:
                if key is not None:
                    out.append({"run_key": key, "sha": digest.hexdigest()})
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_buffer())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"run_key": key, "sha": digest.hexdigest()}], schema=schema)


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv_id, turns as of :func:`sequences`): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (code points of turns that are stored once instead of n_convs times, over the subtree)
    and ends_sha256 (of the decimal conv_ids that end at the node, ascending)."""
    spark = seqs.sparkSession
    small_batches(spark)
    flat = seqs.select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("seq"), F.col("turns.chars").alias("chars"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seqs_, chars = [], [], []
        for b in batches:
            conv.append(b.column(0).to_numpy())
            seqs_ += b.column(1).to_pylist()
            values, offsets = b.column(2).flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(b.column(2)).to_numpy()))
            chars += [values[s:e].astype(np.int64) for s, e in zip(offsets[:-1], offsets[1:])]
        if seqs_:
            yield from _shard_rows(np.concatenate(conv), seqs_, chars)

    found = scratch_table(flat.repartitionByRange(parts, "seq", "conv_id").mapInArrow(shard, _SHARD_SQL), "trie")
    # two rows a shard: bounded by the number of shards
    edge = found.where("path IS NOT NULL").select("path").repartition(1).mapInArrow(_recombine, _NODE_SQL)
    runs = found.where("run IS NOT NULL").select(F.col("run.key").alias("run_key"), F.col("run.first").alias("first"), F.col("run.ids").alias("ids"))
    hashes = (runs.repartition(parts, "run_key").sortWithinPartitions("run_key", "first").select("run_key", "ids")
              .mapInArrow(_hash_runs, "run_key binary, sha string"))
    edge = scratch_table(edge.join(hashes, F.col("key") == F.col("run_key"), "left")
                         .withColumn("ends_sha256", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest()))).drop("run_key", "sha"), "trie-edge")
    names = maybe_broadcast(edge.select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv")))
    whole = found.where("depth IS NOT NULL").drop("path", "run")
    joined = whole.join(names, F.col("parent_key") == F.col("_key"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_conv"))
    out = [*_NUMBERS, "ends_sha256"]
    return joined.select(*out).unionByName(edge.select(*out))
