"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and length >= max(6, 4 q) that no neighbouring word
extends keeping the period. It holds a whole aligned block of B = 2**k words, and the same block again q words later,
for the one k whose distances [ceil((2 B - 1) / 3), ceil((4 B - 1) / 3)) contain q. So:

1. The suffix array of the texts is built by prefix doubling. After step k the suffixes that start with the same B words are a
   group of neighbours, so every aligned block has its interval of the suffix array, and the group numbers name the block.
2. For each block that occurs again in its text, a wavelet tree over the suffix array counts and finds the occurrences in the
   neighbouring window (range successor). They form an arithmetic progression, so count, first and second give all.
3. Each member of a progression gives a candidate period. Of three members or more only the two can be right at which the
   stretch of the progression's own step, around the block, ends as it does around the occurrence. Candidates are extended to
   both sides by the group numbers (doubling), kept if long enough, and of equal stretches the smallest period stays.

A text without a repeated sequence of four words has no run and is left at the first look (every run repeats one).

Words are ``[^\\x20\\x09-\\x0D]+``, compared inside a text by a 64-bit hash. Null and empty texts have no words and no runs;
ties between runs go to the smallest start, then the smallest period. Repeated rows and null ids are handled row by row. A very long
text is handled whole, alone in its group: memory is about 4 bytes x words x log2(words). An empty table gives no rows. Only the id and
text columns are read, so other columns cannot clash; all work is done where the rows are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import small_batches
from clickwise.llm.words import Words, groups, keys, mix64

LEAST_WORDS = 6
LEAST_EXPONENT = 4
_ANY = 4  # words that every run repeats
_TEXT = keys(1, 17)[0]


class WaveletTree:
    """Counts and order statistics of the values in ranges of a permutation (one bit vector a level, highest bit first)."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.before = [], []
        for level in range(self.bits - 1, -1, -1):
            one = (values >> level) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)  # zeros before each place
            np.cumsum(~one, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[~one], values[one]])

    def count_below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """For each range [lo, hi): how many values are smaller than ``bound``."""
        lo, hi, found = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        over = bound >= 1 << self.bits
        whole = hi - lo
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            lo0, hi0 = self.before[i][lo], self.before[i][hi]
            one = (bound >> level) & 1 == 1
            found += np.where(one, hi0 - lo0, 0)
            lo = np.where(one, lo - lo0 + self.zeros[i], lo0)
            hi = np.where(one, hi - hi0 + self.zeros[i], hi0)
        return np.where(over, whole, found)

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """For each range: its k-th smallest value (k from 0, within the range)."""
        lo, hi, k, value = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for i, level in enumerate(range(self.bits - 1, -1, -1)):
            lo0, hi0 = self.before[i][lo], self.before[i][hi]
            n0 = hi0 - lo0
            one = k >= n0
            value += np.where(one, 1 << level, 0)
            k = np.where(one, k - n0, k)
            lo = np.where(one, lo - lo0 + self.zeros[i], lo0)
            hi = np.where(one, hi - hi0 + self.zeros[i], hi0)
        return value


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by ``key``, for each row the place of the first row with its key)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.maximum.accumulate(np.where(np.diff(k, prepend=~k[:1]) != 0, np.arange(len(k)), 0))
    name = np.empty(len(k), np.int32)
    name[order] = first
    return order, name


class _Texts:
    """Suffix array and group numbers of several texts' words; a group never spans texts."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        n = len(words)
        self.first, self.text = first, np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.end = first[1:][self.text]
        _, name = _named(mix64(mix64(words + self.text.astype(np.uint64) * _TEXT) ^ words))
        # names[k]: equal for two places of a text whose next 2**k words are equal (none past the end is)
        self.names = [name]
        at = np.arange(n)
        while True:
            step = 1 << (len(self.names) - 1)
            name = self.names[-1]
            size = np.bincount(name, minlength=n)
            if n == 0 or size.max() == 1:
                break
            tied = np.flatnonzero(size[name] > 1)
            # past the end of a text: a value of its own below all others, nearer ends first
            beyond = tied + step
            inside = beyond < self.end[tied]
            second = np.where(inside, name[np.minimum(beyond, n - 1)].astype(np.int64) + n + 1, self.end[tied] - tied)
            by = np.lexsort((second, name[tied]))
            rows, group, value = tied[by], name[tied][by], second[by]
            new = np.ones(len(rows), bool)
            new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
            start = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, np.arange(len(rows)), 0))
            place = group + np.arange(len(rows)) - start  # place in the suffix array
            fresh = name.copy()
            fresh[rows] = place[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
            self.names.append(fresh)
        order = np.empty(n, np.int64)
        order[self.names[-1]] = at  # all names differ at the end: they are the places
        self.suffixes = order

    def groups_of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of every place's group among the suffixes at step k (past the last step all are alone)."""
        name = self.names[min(k, len(self.names) - 1)]
        return name, np.bincount(name, minlength=len(name))[name]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j > i on (the same text)."""
        run = np.zeros(len(i), np.int64)
        last = len(self.names) - 1
        room = self.end[np.minimum(i, len(self.end) - 1)] - j
        for k in range(last, -1, -1):
            again = True
            while again:
                can = run + (1 << k) <= room
                a, b = np.where(can, i + run, 0), np.where(can, j + run, 0)
                same = can & (self.names[k][a] == self.names[k][b])
                run += np.where(same, 1 << k, 0)
                again = k == last and bool(same.any())
        return run

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words before i and before j > i (the same text)."""
        run = np.zeros(len(i), np.int64)
        last = len(self.names) - 1
        room = i - self.first[self.text[np.minimum(i, len(self.text) - 1)]]
        for k in range(last, -1, -1):
            again = True
            while again:
                can = run + (1 << k) <= room
                a, b = np.where(can, i - run - (1 << k), 0), np.where(can, j - run - (1 << k), 0)
                same = can & (self.names[k][a] == self.names[k][b])
                run += np.where(same, 1 << k, 0)
                again = k == last and bool(same.any())
        return run


def _candidates(t: _Texts) -> tuple[np.ndarray, np.ndarray]:
    """Places (block starts) and distances that may be a run's period."""
    tree = WaveletTree(t.suffixes)
    places, periods = [], []
    k = 1
    while k < len(t.names) and 1 << k <= np.diff(t.first).max(initial=0):
        block = 1 << k
        low, high = (2 * block + 1) // 3, (4 * block + 1) // 3  # ceil((2 B - 1) / 3), ceil((4 B - 1) / 3)
        lo, size = t.groups_of(k)
        own = np.arange(len(lo)) - t.first[t.text]
        p = np.flatnonzero((own % block == 0) & (size > 1) & (np.arange(len(lo)) + low + block <= t.end))
        a, b = lo[p].astype(np.int64), (lo[p] + size[p]).astype(np.int64)
        before = tree.count_below(a, b, p + low)
        count = tree.count_below(a, b, np.minimum(p + high, t.end[p])) - before
        p, a, b, before, count = (x[count > 0] for x in (p, a, b, before, count))
        head = tree.kth(a, b, before)
        places.append(p)
        periods.append(head - p)
        m = count > 1
        p, a, b, before, count, head = (x[m] for x in (p, a, b, before, count, head))
        step = tree.kth(a, b, before + 1) - head
        two = count == 2
        places.append(p[two])
        periods.append((head + step - p)[two])
        # three or more: one progression. The stretch with this step around the block, and that around the occurrences,
        # must end (or begin) alike, as a period longer than the block shifts one onto the other
        p, step, count, head = (x[~two] for x in (p, step, count, head))
        here, there = t.forward(p, p + step), t.forward(head, head + step)
        after = head + there - (p + here)
        here, there = t.backward(p, p + step), t.backward(head, head + step)
        early = head - there - (p - here)
        for d in (after, early, head - p):
            ok = (d >= low) & (d < high) & ((p + d - head) % step == 0) & (p + d >= head) & (p + d <= head + (count - 1) * step)
            places.append(p[ok])
            periods.append(d[ok])
        k += 1
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, ordered; text i has the word hashes words[first[i]:first[i + 1]]."""
    t = _Texts(words, first)
    p, q = _candidates(t)
    left = t.backward(p, p + q)
    length = left + q + t.forward(p, p + q)
    start = p - left
    ok = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * q)
    start, length, q = start[ok], length[ok], q[ok]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    # the same stretch with several periods: the smallest stays (the others are its multiples)
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    text = t.text[start]
    order = np.lexsort((q, start))
    text, start, length, q = text[order], start[order], length[order], q[order]
    return text, start - first[text], length, q


def _repeats(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts in which some sequence of four words occurs twice."""
    n = len(words)
    if n < _ANY:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    m = n - _ANY + 1
    h = text[:m].astype(np.uint64) + np.uint64(1)
    for j in range(_ANY):
        h = mix64(h ^ words[j:m + j])
    whole = text[:m] == text[_ANY - 1:]
    at = np.flatnonzero(whole)
    order = np.argsort(h[at])
    s = h[at][order]
    return np.unique(text[at[order[1:]][s[1:] == s[:-1]]])


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
    [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period) and ``collapsed``, the text's
    words joined by one space without those that a run holds after its first ``period`` words."""
    small_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, found, collapsed = [], [], []
            for group in groups(b.column(1).to_pylist()):
                w = Words(group, lower=False)
                first = w.first
                some = _repeats(w.hash, first)
                sizes = np.diff(first)
                runs: dict[int, list] = {}
                if len(some):
                    part = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
                    text, start, length, period = runs_of(w.hash[part], np.concatenate([[0], np.cumsum(sizes[some])]))
                    for i, s, k, q in zip(some[text].tolist(), start.tolist(), length.tolist(), period.tolist()):
                        runs.setdefault(i, []).append({"start": s, "length": k, "period": q})
                for i, raw in enumerate(group):
                    mine = runs.get(i, [])
                    kept = raw.split()
                    if mine:
                        gone = np.zeros(len(kept) + 1, np.int64)
                        for r in mine:
                            gone[r["start"] + r["period"]] += 1
                            gone[r["start"] + r["length"]] -= 1
                        gone = np.cumsum(gone)
                        kept = [x for x, g in zip(kept, gone.tolist()) if not g]
                    counts.append(int(sizes[i]))
                    found.append(mine)
                    collapsed.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(found, _FOUND.field("runs").type),
                                              pa.array(collapsed, pa.string())], schema=_FOUND)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        find, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of :func:`periodic_runs`: doc_id, n_runs, the longest run (ties: smallest start, then period), its exponent in
    thousandths, and the SHA-256 of all runs and of the collapsed text."""
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
                    (-F.col("_best.less")).alias("length"), F.col("_best.period").alias("period"),
                    F.expr("1000 * -_best.less div _best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id and text) with a periodic tail in about a tenth of the texts, chosen by h = crc32(decimal id): where h % 10 = 0
    and there are n > 0 words, word i >= a becomes word a + (i - a) % p, with g = h div 10, a = g % n and
    p = 1 + (n - a) div (3 + g % 8). A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    tail = F.expr("array_join(transform(_w, (w, i) -> IF(i < _a, w, _w[int(_a + (i - _a) % _p)])), ' ')")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    d = d.withColumn("_g", F.expr("_h div 10")).withColumn("_a", F.expr("IF(size(_w) > 0, _g % size(_w), NULL)"))
    d = d.withColumn("_p", F.expr("1 + (size(_w) - _a) div (3 + _g % 8)"))
    return d.select("doc_id", F.when(F.col("_a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))
