"""The document pipeline: each stage reads what the one before it wrote as Parquet."""

from pyspark.sql import DataFrame, SparkSession

from corpuslake.llm import bpe_stream, language_filters, mixing, pseudonyms, simhash_groups
from corpuslake.llm.vocabularies import byte_bpe
from corpuslake.sources.scratch import scratch_path

# A document stays if its best language explains at least this share of its n-grams.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known; the filters are learnt from these same documents."""
    return language_filters.known_language(docs, language_filters.fit(docs), LEAST_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return simhash_groups.one_of_each_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the place of personal numbers, dates and addresses."""
    return pseudonyms.pseudonymise(docs, spans=None)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights; a document comes at most three times."""
    return mixing.mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the text decoded from them reduced to its sha256."""
    return bpe_stream.encoded_documents(docs, byte_bpe())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mix", mix),
    ("bpe", bpe),
]

# Feistel pseudonyms, XXH64 fingerprints and byte-pair encoding are beyond SQL; tests hold
# the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
