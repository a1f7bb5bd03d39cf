"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwise.llm import runs
from clickwise.llm.common import documents
from clickwise.llm.words import mix64
from .conftest import SCHEMA, odd_texts

SF = "/root/testdata/sf0.001"


def plain(words):
    w, found = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int), {}
    for q in range(1, len(w) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])))
        for i, j in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, k, q) for (s, k), q in found.items())


def sample(rng):
    kind = rng.randrange(7)
    if kind == 0:
        return [rng.randrange(2) for _ in range(rng.randrange(120))]
    if kind == 1:
        return [0] * rng.randrange(80)
    if kind == 2:
        block = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        return [rng.randrange(9) for _ in range(rng.randrange(20))] + (block * rng.randrange(3, 9))[:rng.randrange(1, 200)]
    if kind == 3:
        return ([0] * rng.randrange(1, 12) + [1] + [0] * rng.randrange(5)) * rng.randrange(2, 8) + [0] * rng.randrange(30)
    if kind == 4:
        a, b = [0], [0, 1]
        for _ in range(8):
            a, b = b, b + a
        return b[:rng.randrange(100)] * 2
    if kind == 5:
        return ([0, 1] * rng.randrange(1, 6) + [2]) * rng.randrange(1, 6) + [3]
    return [rng.randrange(50) for _ in range(rng.randrange(100))]


def test_all_runs_of_many_texts_are_found():
    rng = random.Random(1)
    for _ in range(150):
        texts = [sample(rng) for _ in range(8)]
        first = np.cumsum([0] + [len(t) for t in texts])
        words = mix64(np.array(sum(texts, []), np.uint64) + np.uint64(1 << 40))
        text, *found = runs.runs_of(words, first)
        some = set(runs._repeats(words, first).tolist())
        for i, t in enumerate(texts):
            want = plain(t)
            assert [tuple(int(x[j]) for x in found) for j in np.flatnonzero(text == i)] == want
            assert i in some or not want


def test_wavelet_tree_counts_and_orders():
    rng = np.random.default_rng(2)
    values = rng.permutation(777)
    tree = runs.WaveletTree(values)
    lo = rng.integers(0, 776, 300)
    hi = lo + 1 + rng.integers(0, 777 - lo)
    bound, k = rng.integers(0, 1100, 300), rng.integers(0, 1 << 30, 300) % (hi - lo)
    assert tree.count_below(lo, hi, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
    assert tree.kth(lo, hi, k).tolist() == [int(np.sort(values[a:b])[x]) for a, b, x in zip(lo, hi, k)]


def plain_row(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain(w)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    s, k, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(found), s, k, q, None if k is None else 1000 * k // q,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(docs):
    return runs.run_digests(runs.periodic_runs(runs.with_periodic_tails(docs)))


def test_query_rows_equal_the_plain_ones(spark):
    docs = documents(spark, SF).where("length(text) < 12000")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows_of(docs).collect()}
    assert got == {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in docs.collect()}
    assert sum(r[0] for r in got.values()) > 0


def test_odd_rows_have_their_values(make, spark):
    texts = [t for t in odd_texts()] + ["a b " * 400, "x\x0by\x0cx\ry x y x y", "é é é é é é", "a a a a a", "a b " * 9]
    ids = list(range(len(texts)))
    ids[3] = None
    ids[6] = ids[5]
    docs = make(texts, ids, extra=True)
    got = sorted((str(r["doc_id"]), *(str(r[c]) for c in COLUMNS)) for r in rows_of(docs).collect())
    assert got == sorted((str(i), *map(str, plain_row(i, t))) for i, t in zip(ids, texts))
    assert rows_of(spark.createDataFrame([], SCHEMA)).count() == 0


def test_operator_returns_runs_and_text(make):
    r = runs.periodic_runs(make(["say it it it it it it now", None])).orderBy("doc_id").collect()
    assert [tuple(x) for x in r[0]["runs"]] == [(1, 6, 1)] and r[0]["collapsed"] == "say it now" and r[0]["n_words"] == 8
    assert (r[1]["runs"], r[1]["collapsed"], r[1]["n_words"]) == ([], "", 0)


@pytest.mark.parametrize("tail", [0, 1])
def test_a_long_uniform_text_has_one_run(tail):
    words = np.zeros(100_000, np.uint64)
    if tail:
        words[-1] = 1
    text, start, length, period = runs.runs_of(words, np.array([0, len(words)]))
    assert (text.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [100_000 - tail], [1])


def test_rewriting_reads_only_id_and_text(make):
    assert runs.with_periodic_tails(make(["a"], extra=True)).columns == ["doc_id", "text"]
    assert make(["a b"]).withColumn("doc_id", F.lit(None).cast("long")).transform(runs.with_periodic_tails).first()["text"] == "a b"
