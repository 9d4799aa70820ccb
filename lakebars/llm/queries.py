"""The registered queries of this subpackage; their SQL is in :mod:`lakebars.llm.oracle`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm import (centroids, conversations, decontam, embed_dups, lang_id, line_dedup, lm_score, mixing, oracle, private_data,
                          quality, simhash, substring_dedup, token_counts)
from lakebars.llm.common import prepare, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dups.embedding_groups(table(spark, sf_dir, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.dedup_lines(docs)
    return left.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "source", "classifier", "host_prior", "path_prior", "posterior", "kept")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_score.score_documents(table(spark, sf_dir, "documents"))
    rounded = {c: F.round(c, 6) for c in ("log_score", "mean_log_score")}   # sums depend on the order in the last digits
    return scores.withColumns(rounded)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, docs, keep=["doc_id", "source"])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), "contaminated")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", centroids.centroid_digest(F.col("centroid"))).drop("centroid")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged, lost_col="lost")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.private_spans(table(spark, sf_dir, "documents"))
    counts = {f"n_{kind}": private_data.counted(F.col("base"), k) for k, kind in enumerate(private_data.KINDS)}
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()],
                        F.sha2(private_data.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        private_data.spelled(F.col("spans")).alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_embedding_dedup, op3_line_dedup, op4_token_counts, op5_quality, op6_lm_scores, op7_mixing,
    op8_decontamination, op9_language_id, op10_substring_dedup, op11_centroids,
    op12_conversations, op13_pii)}


def queries() -> dict:
    def prepared(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return f(spark, sf_dir)
        return run

    return {name: prepared(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
