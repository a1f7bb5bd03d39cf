"""The training-data pipeline over ``documents``: quality, exact copies, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. :func:`run` writes each stage's rows as Parquet and reads them again for the next one.

Null and empty texts: kept or not by their score, one of them stays, alone in its near group, mixed and packed like
others. Extra columns go through unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwise.llm import exact, minhash, mix, pack, quality
from clickwise.llm.common import documents, maybe_broadcast, scratch_table, text_key
from clickwise.llm.registry import REST_WEIGHT, TARGETS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 go."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact.drop_exact(docs, keep="smallest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the smallest doc_id stays."""
    return minhash.drop_near(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture (file by file, row by row)."""
    places = (mix.mix_rows(docs, TARGETS, REST_WEIGHT).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
              .agg(F.min("position").alias("_position")))
    places = maybe_broadcast(scratch_table(places, "places"))
    placed = docs.join(places, docs["doc_id"].eqNullSafe(places["_id"]) & (text_key(docs["text"]) == places["_key"]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = places["_position"]  # docs may have a column of that name
    return placed.repartitionByRange(parts, at).sortWithinPartitions(at).select(*[docs[c] for c in docs.columns])


def _written_order(docs: DataFrame) -> Column | None:
    """Number of the file and the row in it; null for rows that are not from files (then a hash orders them)."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return None
    number = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1)
    return F.expr("0L") + F.coalesce(F.try_to_number(number, F.lit("9999999999")), F.lit(0)).cast("long") * F.lit(1 << 32) + F.col("_metadata.row_index")


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of equal length; in each bucket of a length they follow the mixture's order."""
    return pack.pack_pieces(docs, length=4096, order=_written_order(docs))


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
          ("mixing", mix_stage), ("packing", pack_stage)]
#: A classifier, a tokenizer and hashed permutations are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch_table(docs, f"stage-{i}")
    return docs
