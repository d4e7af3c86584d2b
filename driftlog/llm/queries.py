"""The registered queries of the llm operators: thin calls over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.llm import importance, langmodel, lloyd, mixing, neardup, pieces, quality, secrets, suffixes, tokenids, toxicity, urls, vectors
from driftlog.llm.common import doc_mod, shared_path, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality.BASE_STATS, "base_failed", "kept", "rule")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_checked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_pieces", "ids_crc32", "lossless", "ids")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "cluster_id", "cluster_size", "kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenids.write_ids(table(spark, sf_dir, "documents"), shared_path(spark, "token-ids"))
    return tokenids.read_ids(spark, path, digest=True)


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmodel.lm_scores(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "secret")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(doc_mod("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT_FOLD, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "offending")


def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_sentencepiece, op3_url_filters, op4_minhash_neardup, op5_mixing,
        op6_token_ids, op7_lm_scores, op8_secret_scan, op9_toxicity, op10_embedding_neardup,
        op11_centroid_clustering, op12_suffix_dedup, op13_importance_resampling,
    )
}
