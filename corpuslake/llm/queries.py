"""Queries over the dealt operators, one per operator; ``ORACLE`` has their SQL where there is one."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.llm import (
    bpe_stream,
    centroid_clusters,
    embedding_groups,
    fill_in_middle,
    fingerprints,
    language_filters,
    main_text,
    mixing,
    path_templates,
    pseudonyms,
    repeated_passages,
    simhash_groups,
    toxicity,
)
from corpuslake.llm.oracle import ORACLE  # noqa: F401
from corpuslake.llm.vocabularies import byte_bpe
from corpuslake.llm.words import held_out

QUERIES = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = fingerprints.fingerprint_report(_table(spark, sf_dir, "documents"))
    return report.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.fingerprint_text(F.col("fp_a"), F.col("fp_b")).alias("fingerprint"),
        fingerprints.fingerprint_text(F.col("edited_a"), F.col("edited_b")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )


@_query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


@_query
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_passages.without_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash_groups.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


@_query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("pii_spans", lambda span: span["kind"])
    counts = [
        (F.size("pii_spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in pseudonyms.KINDS
    ]
    return found.select("doc_id", "text", F.size("pii_spans").cast("long").alias("n_replaced"), *counts)


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )


@_query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.digests(_table(spark, sf_dir, "documents"), byte_bpe())


@_query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_filters.identify(docs, language_filters.fit(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@_query
def op9_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups.embedding_groups(_table(spark, sf_dir, "embeddings"))


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_shard")


@_query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_templates.judge(_table(spark, sf_dir, "pages"))


@_query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(_table(spark, sf_dir, "documents"))


@_query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.clusters(_table(spark, sf_dir, "embeddings"))
