"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark.llm import bpe, html_text, jpeg, katz, langid, mixing, multi_index, partition_join, pii, pivots, runs, simhash, toxicity
from hazardspark.llm.common import Query, share, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_progressive_jpeg")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as a progressive JPEG, its payload read back from the file, and the picture's statistics."""
    out = jpeg.round_trip(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "feature",
    )


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and what they decode to, as digests."""
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_html_consensus")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, share(F.col("doc_id"), 4) != 2)
    return langid.predict(docs, model).withColumn("held_out", F.coalesce(share(F.col("doc_id"), 4) == 2, F.lit(False)))


@query(
    "op5_pivot_top_k",
    """
    WITH v AS (
      SELECT vec_id, min([floor(64 * x::DOUBLE) FOR x IN embedding]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op6_mix_sources", mixing.mix_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated probability and whether the mix keeps it."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("m_tokens").alias("n_tokens"), F.col("m_topic").alias("topic"),
        F.round("m_probability", 6).alias("probability"), F.col("m_kept").alias("kept"),
    )


@query("op7_katz_backoff")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the model of six sevenths of them, and under the base model."""
    return katz.score(table(spark, sf_dir, "documents"), share(F.col("doc_id"), 7) == 2)


@query("op8_toxicity_chain")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of each category and whether it is rejected."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_simhash_anchors")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=4)


@query("op10_pii_boosting")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and selected spans of personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query(
    "op11_multi_index_negatives",
    """
    WITH v AS (
      SELECT vec_id, min({'v': [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding],
        'label': CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT)}) AS r
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id
    ), s AS (
      SELECT a.vec_id AS anchor_id, a.r.label = b.r.label AS same, b.vec_id,
        CAST(list_dot_product(CAST(a.r.v AS DOUBLE[]), CAST(b.r.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.r.v) = len(b.r.v)
    ), p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
      vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every vector whose id is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


@query("op12_suffix_tree_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, a tenth of them with a periodic tail, and what is left when they collapse."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string"))
    out = runs.find(docs, least=24, exponent=3, loop=F.when(h % 10 == 0, F.floor(h / 10)))
    # The greatest exact length / period, then the least start and period.
    better = lambda a, b: F.when(a.length * b.period != b.length * a.period, b.length * a.period - a.length * b.period).when(
        a.start != b.start, a.start - b.start
    ).otherwise(a.period - b.period)
    best = F.try_element_at(F.array_sort("runs", lambda a, b: F.signum(better(a, b)).cast("int")), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_partition_join")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of five-word shingles and component of every document, by links of similarity 0.8."""
    return partition_join.join(table(spark, sf_dir, "documents"), size=5, percent=80)
