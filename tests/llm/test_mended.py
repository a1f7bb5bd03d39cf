"""Cases that once failed, each against its defined result."""

import random
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwise.llm import exact, pack, pii, rans, tokens
from .conftest import SCHEMA, rows


def test_rows_without_an_order_are_packed_last(spark, make):
    docs = make([f"word{i} two" for i in range(20)]).withColumn("place", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") * 3 - 9))
    got = pack.pack_pieces(docs, 64, order=F.col("place")).toPandas()
    assert set(got.doc_id) == set(range(20))
    assert sorted(got.sequence_id) == list(range(len(got)))
    for _, g in got.groupby("length"):
        ids = g.sort_values("sequence_id").doc_id.tolist()
        given = [i for i in ids if i % 2 == 0]
        assert ids[:len(given)] == given == sorted(given)


def test_null_and_repeated_ids_are_spread_over_the_buckets(spark):
    df = spark.createDataFrame(rows([f"w{i} x" for i in range(4000)], [None if i % 3 == 0 else 7 if i % 3 == 1 else i for i in range(4000)]), SCHEMA)
    got = pack.pack_pieces(df, 64)
    assert got.agg(F.count_distinct("sequence_id"), F.count("*")).first()[:] == (got.count(),) * 2
    key = F.xxhash64(F.lit(1), F.col("doc_id"), pack.text_key(F.col("text")))
    sizes = [r["count"] for r in df.groupBy(F.shiftrightunsigned(key, 60)).count().collect()]
    assert max(sizes) < 2 * 4000 / 16


def test_repeated_rows_with_clashing_names_go_once(spark, make):
    docs = make(["a", "a", "b", None, ""], [1, 1, 2, 3, 3]).withColumns({c: F.lit(1) for c in ("_t", "_T2", "__t", "_position", "_run", "_best")})
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns and left.count() == 3


def test_mixing_stage_with_a_column_of_its_own_name(spark, make):
    import corpus_pipeline
    docs = make([f"text {i}" for i in range(9)]).withColumns({c: F.lit(1) for c in ("_position", "_id2", "position", "text_key")})
    got = corpus_pipeline.mix_stage(spark, docs, "")
    assert got.columns == docs.columns and got.count() == 9


def test_decoding_some_units_at_a_time_gives_the_lattice_result(monkeypatch):
    monkeypatch.setattr(pii, "DECODED_AT_ONCE", 5)
    rng = random.Random(2)
    w = np.random.default_rng(2).normal(-0.05, 0.12, (pii.DIMENSIONS, len(pii.KINDS)))
    found = 0
    for _ in range(60):
        text = "".join(rng.choice(["12 ", "345-", "+1 (2", "a.b@c", "de", " . ", "10.0.0.1 ", "4111 1111", "x@y.zz ", ") ", "77"]) for _ in range(rng.randrange(1, 25)))
        for units in pii.windows(text):
            want = pii.Lattice(text, units).best(w)
            assert pii.best_segments(text, units, w) == want
            found += len(want)
    assert found > 20


def test_a_long_text_of_numbers_is_decoded_in_bounded_memory():
    text = " ".join(str(i * 7919 % 100_000) for i in range(12_000))
    w = np.full((pii.DIMENSIONS, len(pii.KINDS)), -0.01)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pii.all_spans(text, w)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # KB


@pytest.mark.parametrize("as_bytes", [False, True])
def test_token_ids_of_known_and_new_pieces(as_bytes):
    texts = ["the cat, sat.", None, "", "zzqx the. zzqx,", "é ü the"]
    given = [t.encode() if as_bytes and t is not None else t for t in texts]
    tok, _ = tokens._tokenizer(None)
    want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for _ in range(2):
        assert [x.tolist() for x in tokens.encode_texts(given)] == want


def test_counts_beside_the_blocks_make_the_table(spark, make, tmp_path):
    texts = [f"w{i % 7} the cat {i}" for i in range(200)] + [None, ""]
    table = rans.write_tokens(make(texts), f"file://{tmp_path}/set", block_tokens=64)
    ids, n = np.unique(np.concatenate(list(tokens.encode_texts(texts))), return_counts=True)
    assert (table.freq == rans.Table(dict(zip(ids.tolist(), n.tolist()))).freq).all()


def boilerplate(n, seed=3):
    """Texts with 400 words in common and 76 of their own: about 0.72 alike, below the threshold."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(400)]
    return [" ".join(common[:200] + [f"o{rng.randrange(10**9)}" for _ in range(38)] + common[200:] + [f"o{rng.randrange(10**9)}" for _ in range(38)])
            for _ in range(n)]


def test_similar_texts_among_a_common_passage_are_linked(make):
    from clickwise.llm import minhash
    from .test_operators import near_plain
    rng = random.Random(8)
    texts = boilerplate(40)
    for t in list(texts[:12]):
        w = t.split()
        for _ in range(rng.randrange(1, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(w[:rng.randrange(440, len(w))]))
    common = texts[0].split()[:200]
    texts += [" ".join(common + [f"q{rng.randrange(10**9)}" for _ in range(k)]) for k in range(0, 60, 5)]
    want, _ = near_plain(texts, 4)
    got = minhash.near_groups(make(texts), 4).toPandas().sort_values("doc_id")
    assert got.component_id.tolist() == want
