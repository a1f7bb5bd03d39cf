"""The pipeline's stages on odd rows, on an empty table, and whole on a small corpus."""

import corpus_pipeline as cp
from clickwise.llm import common, tokens
from .conftest import SCHEMA

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for i, (_, stage) in enumerate(cp.STAGES[:-1]):
        docs = common.scratch_table(stage(spark, docs, SF), "t")
        assert docs.columns == odd.columns


def test_stages_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_mixing_keeps_every_row_and_packing_every_token(spark):
    docs = common.documents(spark, SF)
    mixed = common.scratch_table(cp.mix_stage(spark, docs, SF), "t")
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    pieces = cp.pack_stage(spark, mixed, SF).toPandas()
    assert pieces["length"].sum() == sum(map(len, tokens.encode_texts([r["text"] for r in docs.collect()])))
    written = mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index")
    place = {r["doc_id"]: i for i, r in enumerate(written.collect())}
    one = pieces[pieces["length"] == 64].sort_values("sequence_id")
    assert one.doc_id.map(place).is_monotonic_increasing


def test_run_is_whole(spark):
    got = cp.run(spark, SF).toPandas()
    assert len(got) and sorted(got.sequence_id) == list(range(len(got)))
    assert (got.groupby("doc_id")["length"].sum() == got.groupby("doc_id")["doc_tokens"].first()).all()
