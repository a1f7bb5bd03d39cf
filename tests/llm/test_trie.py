"""The trie of conversations against a plain one, on DuckDB's rows and on odd turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from clickwise.llm import registry, trie

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [v[3:] for v in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[x] for x in kids[k])
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = trie.prefix_trie(trie.with_shared_openings(trie.sequences(df)))
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str)


def test_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = registry.QUERIES["op12_trie"](spark, SF)
    want = con.sql(registry.ORACLE["op12_trie"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def many(rng, n=450):
    rows = []
    for c in range(n):
        if c == 100:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 8, 30]) if c % 7 else 4):
            turn = t if rng.random() > .02 else None
            rows.append((c, turn, rng.choice(["u", "a", None]) if c % 7 else "u", rng.choice(["x", "yy", None, "zé"]) if c % 7 else "same"))
    return rows


@pytest.mark.parametrize("shards", [1, 3, 8, 23])
def test_any_number_of_shards_gives_the_plain_trie(spark, shards):
    rows = many(random.Random(3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        assert rows_of(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, None, None, None), (2, 3, "", "x" * 200_000), (3, 1, "u", "é中"),
            (None, 1, "u", "lost"), (-7, 2, "u", "neg"), (-7, None, "a", "first"), (900, 1, "ab", "c"), (901, 1, "a", "bc"), (10**15, 5, "u", "")]
    rows += [(c, t, "u", "same") for c in range(1000, 1040) for t in range(3)]
    rows += [(5000, t, "u", str(t % 3)) for t in range(700)]
    assert rows_of(spark, rows) == plain([r for r in rows if r[0] != -7] + [r for r in rows if r[0] == -7])


def test_no_turns_no_nodes_and_clashing_columns(spark):
    assert rows_of(spark, []) == []
    df = spark.createDataFrame([(1, 0, "u", "a", 9, 9)], SCHEMA + ", key long, turns long")
    assert trie.prefix_trie(trie.sequences(df)).count() == 2


def test_conversations_without_turns_belong_to_the_root(spark):
    rows = [(c, t, "u", f"{c}") for c in range(201, 260) for t in range(2)]  # conversation 200 is absent: heads are empty
    got = rows_of(spark, rows)
    assert got == plain(rows)
    root = [r for r in got if r[1] == 0]
    assert len(root) == 1 and root[0][3] == 59 and root[0][7] != hashlib.sha256(b"").hexdigest()
