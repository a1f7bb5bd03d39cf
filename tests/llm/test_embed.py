"""Near vectors against all pairs: DuckDB's rows, vectors around the threshold, large groups and odd ones."""

import duckdb
import numpy as np
import pytest

from clickwise.llm import embed, registry

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(ids, vectors, threshold=0.95):
    x = [None if v is None else np.array([np.nan if c is None else c for c in v], np.float64) for v in vectors]
    use = [i for i, v in enumerate(x) if v is not None and len(v) and np.isfinite(v).all() and np.abs(v).sum() > 0]
    links, a, b = np.zeros(len(ids), int), [], []
    for d in {len(x[i]) for i in use}:
        some = np.array([i for i in use if len(x[i]) == d])
        u = np.array([x[i] / np.abs(x[i]).max() for i in some])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        p, q = np.nonzero(u @ u.T >= threshold)
        p, q = some[p[p != q]], some[q[p != q]]
        np.add.at(links, p, 1)
        a.append(p)
        b.append(q)
    root = embed._same_roots(len(ids), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(ids))
    first = {}
    for i, r in enumerate(root.tolist()):
        if ids[i] is not None:
            first[r] = min(first.get(r, ids[i]), ids[i])
    comp = [first.get(r) for r in root.tolist()]
    return links, [(i, int(n), c, i is not None and i == c) for i, n, c in zip(ids, links, comp)]


def rows_of(df, **kw):
    return sorted((tuple(r) for r in embed.near_vectors(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def noisy(rng, centre, cosine):
    out = rng.standard_normal(len(centre))
    out -= out @ centre * centre
    return cosine * centre + np.sqrt(1 - cosine ** 2) * out / np.linalg.norm(out)


def unit(rng, dim):
    v = rng.standard_normal(dim)
    return v / np.linalg.norm(v)


def test_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = registry.QUERIES["op13_embeddings"](spark, SF)
    want = con.sql(registry.ORACLE["op13_embeddings"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.fixture(scope="module")
def groups():
    """Pairs just above and below the threshold, chains, and a group with a third of all rows, some far from its centre."""
    rng = np.random.default_rng(4)
    out = [unit(rng, 48) for _ in range(900)]
    for k in range(300):
        out.append(noisy(rng, out[k], 0.951 if k % 2 else 0.945))
    chain = unit(rng, 48)
    for _ in range(12):
        out.append(chain)
        chain = noisy(rng, chain, 0.97)
    hot = unit(rng, 48)
    out += [noisy(rng, hot, c) * rng.uniform(0.1, 9) for c in rng.uniform(0.90, 1, 700)]
    out += [hot] * 40
    return [np.asarray(v, np.float32).astype(float).tolist() for v in out]


def test_links_around_the_threshold_and_in_a_large_group(spark, groups, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK", 50)  # cut buckets as on a large table
    ids = list(range(5, 5 + len(groups)))
    df = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, groups)], SCHEMA).repartition(5)
    links, want = plain(ids, groups)
    got = rows_of(df, miss=1e-5)
    assert got == sorted(want, key=str)
    found = sum(r[1] for r in rows_of(df))
    assert 0.995 <= found / links.sum() <= 1


def test_blocks_do_not_change_the_rows(spark, groups, monkeypatch):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(groups)], SCHEMA)
    whole = rows_of(df)
    monkeypatch.setattr(embed, "BLOCK", 33)
    assert rows_of(df.repartition(7)) == whole


def test_estimates_are_unbiased_and_within_their_bounds():
    rng = np.random.default_rng(6)
    dim, bits = 48, 96
    x = np.array([unit(rng, dim) for _ in range(1500)])
    y = np.array([noisy(rng, v, c) for v, c in zip(x, rng.uniform(-1, 1, len(x)))])
    mapped, signs, a = embed.encode(x, bits)
    q, _, _ = embed.encode(y, bits)
    estimate = ((signs * 2.0 - 1) / np.sqrt(bits) * q).sum(axis=1) / a
    error = estimate - (x * y).sum(axis=1)
    bound = embed.EPSILON * np.sqrt((1 - a ** 2) / a ** 2 / (bits - 1))
    assert abs(error.mean()) < 4 * error.std() / np.sqrt(len(x))
    assert (np.abs(error) > bound).mean() < 0.002


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    vectors = [None, [], [0.0, 0.0, 0.0], [1.0, None, 2.0], [nan, 1.0, 2.0], [inf, 1.0, 1.0], v, v, [2.0, 4.0, 6.0], [1e-30, 2e-30, 3e-30],
               [-1.0, -2.0, -3.0], [1.0, 2.0], [2.0, 4.01], [7.0], [3.0], [-3.0], [1.0, 2.0, 3.0, 0.0]]
    ids = [*range(len(vectors) - 1), None]
    ids[7] = 6  # a repeated row
    df = spark.createDataFrame([(i, x, 0) for i, x in zip(ids, vectors)], SCHEMA)
    for c in ("cls", "n", "key", "table", "side", "code", "copies", "ball"):
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("x"))
    assert rows_of(df) == sorted(plain(ids, [None if x is None else [c for c in x] for x in vectors])[1], key=str)
    assert rows_of(spark.createDataFrame([], SCHEMA)) == []


def test_long_vectors_and_wide_types(spark):
    rng = np.random.default_rng(8)
    x = [unit(rng, 1024) for _ in range(40)]
    x += [noisy(rng, v, 0.96) for v in x[:20]]
    x = [np.round(v * 1000).astype(int).tolist() for v in x]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id int, embedding array<int>")
    assert rows_of(df) == sorted(plain(list(range(len(x))), x)[1], key=str)


def test_more_tables_for_more_rows():
    for rows in (1, 10_000, 10**9):
        width, tables = embed.layout(rows)
        agree = (1 - np.arccos(0.95) / np.pi) ** width
        assert (1 - agree) ** tables <= embed.MISS
        assert rows / 2 ** width <= 2 * embed.BUCKET
