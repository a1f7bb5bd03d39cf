"""The training-data queries over whole tables, with production parameters, and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickwise.llm import embed, exact, minhash, mix, pack, pii, quality, rans, runs, secrets, shard, simhash, trie
from clickwise.llm.common import documents, scratch_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_shard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_rows(documents(spark, sf_dir), shards=40)


_NEAR_SQL = """
    WITH RECURSIVE lowered AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM lowered),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM sets
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN named USING (doc_id)"""


@register("op2_minhash", _NEAR_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir), width=4).drop("text_key", "component_key")


@register("op3_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
    WINDOW same AS (PARTITION BY t)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir), keep="largest").drop("text_key")


@register("op4_pack")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_pieces(documents(spark, sf_dir), length=4096)


@register("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.tag_rows(documents(spark, sf_dir))


@register("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scratch_table(simhash.neighbour_fingerprints(documents(spark, sf_dir)), "fingerprints")
    return simhash.neighbours_in_radius(found, every=20, radius=3)


@register("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_rows(documents(spark, sf_dir))


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_rows(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_files(documents(spark, sf_dir))


#: Target shares of the sources; all others share the rest.
TARGETS = {"src0": 20} | {f"src{i}": 4 for i in range(1, 20)}
REST_WEIGHT = 4


@register("op10_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_rows(documents(spark, sf_dir), TARGETS, REST_WEIGHT).drop("text_key")


@register("op11_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(runs.with_periodic_tails(documents(spark, sf_dir))))


_CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


@register("op12_trie", f"""
    WITH t AS (
        SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    o AS (SELECT conv_id, turns, {_CRC32_SQL} % 6 AS h FROM t),
    rebuilt AS (
        SELECT o.conv_id, list_concat(CASE WHEN d.conv_id IS NULL OR h = 0 THEN [] ELSE d.turns[1:h] END, o.turns[h + 1:]) AS s
        FROM o LEFT JOIN t d ON d.conv_id = o.conv_id - o.conv_id % 100),
    prefixes AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM rebuilt),
    nodes AS (
        SELECT depth, s[1:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = depth), '') AS ends
        FROM prefixes GROUP BY depth, s[1:depth]),
    kids AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth - 1, p[1:depth - 1]),
    counted AS (
        SELECT n.*, coalesce(k.n_children, 0) AS n_children,
               CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.p[n.depth].text) END AS saved
        FROM nodes n LEFT JOIN kids k ON n.depth = k.depth AND n.p = k.p),
    up AS (SELECT unnest(range(0, depth + 1)) AS depth, p AS whole, n_children, saved FROM counted),
    sums AS (SELECT depth, whole[1:depth] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY depth, whole[1:depth])
    SELECT c.conv_id, c.depth, a.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
           sha256(c.ends) AS ends_sha256
    FROM counted c JOIN sums s ON c.depth = s.depth AND c.p = s.p LEFT JOIN nodes a ON a.depth = c.depth - 1 AND a.p = c.p[1:c.depth - 1]""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie.prefix_trie(trie.with_shared_openings(trie.sequences(turns)))

@register("op13_embeddings", """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    ok AS (
        SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach AS (
        SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM named LEFT JOIN counted USING (vec_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
