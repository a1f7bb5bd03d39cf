"""Time-gap features of the rows of one task, by numpy: what :mod:`clickwise.operators.gaps` runs on each hash partition of a leading key.

The rows are sorted by the ordinal once; a stable sort by each key set's group numbers then gives that key set's order. Kept for a key set are
the row's place in it, the sorted minute ordinals and the statistics of its groups, so a task holds its narrow rows and some 30 bytes a row and key set,
never the wide result, which leaves batch by batch.

Sums are whole numbers. The gaps to the next and to the last row are the same numbers of a group seen from either end, so they share their statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _whole(column: pa.ChunkedArray) -> pa.Array:
    c = column.combine_chunks()
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return pc.add(c, pa.scalar(0.0, c.type)) if pa.types.is_floating(c.type) else c  # -0.0 and 0.0 are one value


def group_numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """A number from 0 for each distinct value, -1 for null, and how many values there are."""
    d = _whole(column).dictionary_encode()
    return d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary)


def distinct_counts(table: pa.Table) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct values of the first column, and for each of the others how many distinct non-null values come with each."""
    keys = _whole(table.column(0)).dictionary_encode()
    key, many = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(keys.dictionary)
    out = []
    for i in range(1, table.num_columns):
        value, size = group_numbers(table.column(i))
        known = value >= 0
        pairs = np.unique(key[known] * size + value[known])
        out.append(np.bincount(pairs // max(size, 1), minlength=many).astype(np.int64))
    return keys.dictionary, out


def means(table: pa.Table) -> tuple[pa.Array, list[pa.Array]]:
    """The distinct values of the first column, and for each of the others the mean of the non-null values that come with each."""
    keys = _whole(table.column(0)).dictionary_encode()
    key, many = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(keys.dictionary)
    out = []
    for i in range(1, table.num_columns):
        c = _whole(table.column(i))
        known = pc.is_valid(c).to_numpy(zero_copy_only=False)
        value = pc.fill_null(c, 0).to_numpy(zero_copy_only=False).astype(np.float64)
        n = np.bincount(key[known], minlength=many)
        out.append(pa.array(np.bincount(key[known], value[known], many) / np.maximum(n, 1), mask=n == 0))
    return keys.dictionary, out


def ordered(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """The rows in the order of the columns: nulls first, NaN last."""
    keys = []
    for c in map(_whole, columns):
        t = c.type
        if not (pa.types.is_integer(t) or pa.types.is_floating(t)):
            c = pc.rank(c, null_placement="at_start", tiebreaker="dense")
        known = pc.is_valid(c).to_numpy(zero_copy_only=False)
        keys += [known, pc.fill_null(c, 0).to_numpy(zero_copy_only=False)]
    return np.lexsort(keys[::-1])


class KeySet:
    """Places and group statistics of the rows under one key set; ``d`` and ``known`` are the minute ordinals in row order and which are not null."""

    def __init__(self, numbers: list[tuple[np.ndarray, int]], order: np.ndarray, d: np.ndarray, known: np.ndarray, gaps: tuple[int, ...]):
        n = len(order)
        group, size = numbers[0][0].copy(), numbers[0][1] + 1
        self.live = group >= 0
        group += 1
        for g, many in numbers[1:]:
            if size * (many + 1) >= 2**62:
                values, group = np.unique(group, return_inverse=True)
                size = len(values)
            self.live &= g >= 0
            group = group * (many + 1) + g + 1
            size *= many + 1
        rows = order[np.argsort(group[order], kind="stable")]
        sorted_ = group[rows]
        new = np.ones(n, bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], n)
        self.group = (np.cumsum(new) - 1).astype(np.int32)
        self.place = np.empty(n, np.int32 if n < 2**31 else np.int64)
        self.place[rows] = np.arange(n)
        self.d, self.known = d[rows], known[rows]
        self.stats = {g: self._stats(g) for g in gaps}

    def _stats(self, gap: int) -> tuple[np.ndarray, ...]:
        """Count, sum, largest and smallest gap of each group."""
        n = len(self.d)
        ok = np.zeros(n, bool)
        diff = np.zeros(n, np.int64)
        if n > gap:
            ok[:-gap] = (self.group[gap:] == self.group[:-gap]) & self.known[gap:] & self.known[:-gap]
            diff[:-gap] = self.d[gap:] - self.d[:-gap]
        return (np.add.reduceat(ok.astype(np.int64), self.first), np.add.reduceat(np.where(ok, diff, 0), self.first),
                np.maximum.reduceat(np.where(ok, diff, _LOW), self.first), np.minimum.reduceat(np.where(ok, diff, _HIGH), self.first))

    def columns(self, rows: slice, name: str, wanted: set[str], whole: pa.DataType) -> dict[str, pa.Array]:
        """The wanted features of some rows; ``whole``: the type of a gap."""
        place, live = self.place[rows].astype(np.int64), self.live[rows]
        group = self.group[place]
        a, z = self.first[group], self.last[group]
        reach = max(self.stats) + 1
        d, ok = {}, {}
        for k in range(-reach, reach + 1):
            at = place + k
            there = live & (at >= a) & (at < z)
            at = np.where(there, at, 0)
            d[k], ok[k] = self.d[at], there & self.known[at]

        def gap(*ends: tuple[int, int]) -> pa.Array:
            """The first of the gaps (from, to) less the second, if there is one."""
            (a0, a1), *rest = ends
            value, good = d[a1] - d[a0], ok[a1] & ok[a0]
            for b0, b1 in rest:
                value, good = value - (d[b1] - d[b0]), good & ok[b1] & ok[b0]
            made = pa.array(value, mask=~good)
            return made if whole == pa.int64() else made.cast(whole)
        out = {}
        for g, (count, total, high, low) in self.stats.items():
            made = {}
            for to, ends in (("next", (0, g)), ("last", (-g, 0))):
                base = f"ts_{name}_{g}_diff_{to}"
                if base in wanted:
                    out[base] = gap(ends)
                for kind in ("count", "mean", "max", "min"):
                    if f"{base}_{kind}" not in wanted:
                        continue
                    if kind not in made:
                        n = count[group]
                        none = ~live | (n == 0)
                        if kind == "count":
                            made[kind] = pa.array(n, mask=~live)
                        elif kind == "mean":
                            made[kind] = pa.array(total[group] / np.maximum(n, 1), mask=none)
                        else:
                            value = pa.array(np.where(none, 0, (high if kind == "max" else low)[group]), mask=none)
                            made[kind] = value if whole == pa.int64() else value.cast(whole)
                    out[f"{base}_{kind}"] = made[kind]
            for c, ends in ((f"ts_s_next_{name}_{g}_next_1", ((g, g + 1), (0, 1))), (f"ts_s_next_{name}_{g}_last_1", ((0, 1), (-g, 1 - g))),
                            (f"ts_s_last_{name}_{g}_next_1", ((g - 1, g), (-1, 0))), (f"ts_s_last_{name}_{g}_last_1", ((-1, 0), (-g - 1, -g)))):
                if c in wanted:
                    out[c] = gap(*ends)
        return out


def _key_sets(table: pa.Table, key_sets: list[list[str]], order: list[str], date: str, gaps: tuple[int, ...]) -> list[tuple[str, KeySet]]:
    numbers = {k: group_numbers(table[k]) for ks in key_sets for k in ks}
    rows, when = ordered([table[c] for c in order]), _whole(table[date])
    d = pc.fill_null(when, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    known = pc.is_valid(when).to_numpy(zero_copy_only=False)
    return [("_".join(ks), KeySet([numbers[k] for k in ks], rows, d, known, gaps)) for ks in key_sets]


def _widened(b: pa.RecordBatch, at: int, sets: list[tuple[str, KeySet]], whole: pa.DataType, kept: list[str], features: list[str]) -> pa.RecordBatch:
    """The kept columns of a batch, whose first row is row ``at`` of the task, and its features."""
    found, wanted = {}, set(features)
    for name, s in sets:
        found |= s.columns(slice(at, at + b.num_rows), name, wanted, whole)
    return pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), *(found[c] for c in features)], names=[*kept, *features])


def task(key_sets: list[list[str]], order: list[str], date: str, gaps: tuple[int, ...], kept: list[str], features: list[str]):
    """The function of one task: batches in, the ``kept`` columns and the ``features`` out, row by row in the order of arrival."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        whole, sets = table.schema.field(date).type, _key_sets(table, key_sets, order, date, gaps)
        del table
        at = 0
        for i, b in enumerate(held):
            held[i] = None
            yield _widened(b, at, sets, whole, kept, features)
            at += b.num_rows
    return run


def packed_task(key_sets: list[list[str]], order: list[str], date: str, gaps: tuple[int, ...], kept: list[str], features: list[str], schema: pa.Schema):
    """As :func:`task`, for packed rows: a task holds them packed, beside the columns that the places and statistics need."""
    needed = list(dict.fromkeys([*(k for ks in key_sets for k in ks), *order, date]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [rows for b in batches for rows in b.column(1)]
        if not held:
            return
        table = pa.Table.from_batches([unpacked(rows, schema).select(needed) for rows in held])
        whole, sets = table.schema.field(date).type, _key_sets(table, key_sets, order, date, gaps)
        del table
        at, some = 0, []
        for i, rows in enumerate(held):
            some.append(unpacked(rows, schema))
            held[i] = None
            if i + 1 < len(held) and sum(b.num_rows for b in some) < BATCH_ROWS:
                continue
            for b in pa.Table.from_batches(some).combine_chunks().to_batches(BATCH_ROWS):
                yield _widened(b, at, sets, whole, kept, features)
                at += b.num_rows
            some = []
    return run


#: Rows of a batch that leaves a task, bytes of rows that go to one partition at once (about, before packing), and the least and the most for all.
BATCH_ROWS, PACKED_BYTES, LEAST_BYTES, MOST_BYTES = 10_000, 256 << 10, 16 << 20, 64 << 20


def packing(to: str, addresses: np.ndarray, schema: pa.Schema):
    """Deals rows out by the number in column ``to`` and packs those of one number, by columns and compressed, into one row
    (``addresses`` at that number, the packed rows). What an exchange moves is then a fraction of the rows themselves."""
    most = min(MOST_BYTES, max(LEAST_BYTES, len(addresses) * PACKED_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size >= most:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        target = table[to].to_numpy()
        order = np.argsort(target, kind="stable")
        starts = np.flatnonzero(np.diff(target[order], prepend=-1))
        table = table.select(schema.names).cast(schema).take(order)
        rows = []
        for a, z in zip(starts, [*starts[1:], len(order)]):
            plain = table.slice(a, z - a).combine_chunks().to_batches()[0].serialize()
            rows.append(plain.size.to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(addresses[target[order][starts]], pa.int32()), pa.array(rows, pa.binary())], names=["to", "rows"])
    return run


def unpacked(rows: pa.BinaryScalar, schema: pa.Schema) -> pa.RecordBatch:
    held = rows.as_buffer()
    return pa.ipc.read_record_batch(pa.decompress(held[8:], int.from_bytes(held[:8].to_pybytes(), "little"), "zstd"), schema)


def addresses(tasks: int) -> np.ndarray:
    """For each number below ``tasks`` an integer whose hash sends it to that partition of as many. Only the balance depends on it."""
    found, start = np.full(tasks, -1, np.int32), 0
    while (found < 0).any():
        v = np.arange(start, start + 8 * tasks, dtype=np.uint32)
        k = v * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)
        h = np.uint32(42) ^ k  # Murmur3 of four bytes, Spark's seed
        h = (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(4)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
        part = h.view(np.int32) % tasks
        for p, i in zip(*np.unique(part, return_index=True)):
            if found[p] < 0:
                found[p] = v[i]
        start += 8 * tasks
    return found
