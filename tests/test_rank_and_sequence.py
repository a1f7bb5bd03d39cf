"""Exact rank / prefix scans are independent of bucketing; the parity run equals brute force."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickwise.operators import rank
from clickwise.operators import sequence as seq
from clickwise.operators import topk


def test_global_rank_is_partition_independent(spark):
    rows = [(i, random.Random(i).randint(0, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, s int")
    want = {r["id"]: r["p"] for r in
            df.select("id", (F.row_number().over(Window.orderBy("s", "id")) - 1).alias("p")).collect()}
    for nb in (1, 3, 17, 64):
        got = {r["id"]: r["pos"] for r in rank.global_rank(df, ["s", "id"], F.col("s"), n_buckets=nb).collect()}
        assert got == want


def test_running_scan_sum_and_xor_per_group(spark):
    rows = [(g, i, (i * 7) % 5) for g in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, i int, v long")
    out = rank.running_scan(df, [("v", "sum", "s"), ("v", "xor", "x")], ["i"], F.col("i"), ["g"], n_buckets=6,
                            few_groups=False)
    for r in out.collect():
        vals = [(k * 7) % 5 for k in range(r["i"] + 1)]
        x = 0
        for v in vals:
            x ^= v
        assert r["s"] == sum(vals) and r["x"] == x


def _brute_longest(types):
    best = 0
    for i in range(len(types)):
        counts = {}
        for j in range(i, len(types)):
            counts[types[j]] = counts.get(types[j], 0) + 1
            if all(c % 2 == 0 for c in counts.values()):
                best = max(best, j - i + 1)
    return best


def test_parity_run_equals_brute_force(spark):
    rng = random.Random(7)
    rows, expected = [], {}
    for u in range(12):
        seq_types = [rng.choice("abcd") for _ in range(rng.randint(1, 30))]
        expected[u] = _brute_longest(seq_types)
        rows += [(u, t, ty) for t, ty in enumerate(seq_types)]
    df = spark.createDataFrame(rows, "user_id int, t int, ty string")
    bit = F.expr("shiftleft(1, ascii(ty) - 97)")
    got = {r["user_id"]: r["longest"] for r in
           seq.longest_even_run(df, "user_id", bit, ["t"], F.col("t"), n_buckets=4).collect()}
    assert got == expected
    # the scratchpad's own example string
    s = "aabcbccdbd"
    one = spark.createDataFrame([(0, i, c) for i, c in enumerate(s)], "user_id int, t int, ty string")
    assert seq.longest_even_run(one, "user_id", bit, ["t"], F.col("t")).first()["longest"] == _brute_longest(s)


def test_top_k_per_group_matches_plain_window(spark):
    rows = [(i % 4 if i % 3 else 0, i, float((i * 37) % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, id int, v double")
    got = {(r["g"], r["id"], r["rank"]) for r in
           topk.top_k_per_group(df, ["g"], 5, [F.col("v").desc(), F.col("id")], "id", salts=7).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    want = {(r["g"], r["id"], r["rank"]) for r in
            df.withColumn("rank", F.row_number().over(w)).where("rank <= 5").collect()}
    assert got == want
