"""Operator inputs derived from the benchmark tables, whole tables throughout.

Two versions of a page list, failed fetches, NaN vectors and the like do not
occur in the tables; they are marked in by arithmetic on the row ids.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.functions.text import collapse_whitespace, url_key
from corpuslake.operators.common import hashed

TITLES = ("h1",)
BODIES = ("article",)
BASE_URL = "https://"
FILTERS = {"extensions": (".HTML",), "exclude": ("page=",), "include": ("/en/",)}
MODEL = "all-mini_v2"
PROJECT = "corpus"
CHANGE_TS = "2024-03-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sitemap_texts(spark, sf_dir) -> DataFrame:
    """``source, value``: sitemap elements; every tenth page is listed again, later."""
    day = F.lpad((1 + F.col("page_id") % 28).cast("string"), 2, "0")

    def element(month):
        stamp = F.concat(F.lit(f"2024-{month}-"), day, F.lit("T00:30:00+02:00"))
        return F.concat(
            F.lit("<url> <loc> "), "url", F.lit(" </loc> <lastmod>"), stamp, F.lit("</lastmod></url>")
        )

    again = F.when(F.col("page_id") % 10 == 0, element("02")).otherwise("")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("source"), F.concat(element("01"), again).alias("value")
    )


def snapshots(spark, sf_dir) -> DataFrame:
    """``snapshot_id, id, url, last_updated``: three versions of the page list."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        url_key("url").alias("id"),
        "url",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int")).alias("day"),
    )
    n = F.col("page_id")

    def version(number, listed, day):
        return F.struct(F.lit(number).alias("v"), listed.alias("listed"), day.alias("d"))

    versions = F.array(
        version(0, F.lit(True), F.col("day")),
        version(1, n % 7 != 0, F.col("day")),
        version(2, n % 11 != 0, F.date_add("day", F.when(n % 5 == 0, 1).otherwise(0))),
    )
    return (
        pages.select("id", "url", F.inline(versions))
        .where("listed")
        .select(F.col("v").alias("snapshot_id"), "id", "url", F.col("d").alias("last_updated"))
    )


def snapshot(spark, sf_dir, version: int) -> DataFrame:
    return snapshots(spark, sf_dir).where(F.col("snapshot_id") == version).drop("snapshot_id")


def crawl(spark, sf_dir) -> DataFrame:
    """``url, html``: some pages missing (failed fetch), some empty."""
    html = F.when(F.col("page_id") % 17 == 0, "").otherwise(F.col("html"))
    return (
        table(spark, sf_dir, "pages").where("page_id % 13 <> 0").select("url", html.alias("html"))
    )


def page_list(spark, sf_dir) -> DataFrame:
    return snapshot(spark, sf_dir, 0)


def corpus(spark, sf_dir) -> DataFrame:
    """``id, url, last_updated, extracted_content, doc_id``: documents as enriched pages."""
    docs = hashed(table(spark, sf_dir, "documents"), "doc_id")
    return docs.select(
        F.md5(F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")).alias(
            "last_updated"
        ),
        collapse_whitespace("text").alias("extracted_content"),
        "doc_id",
    )


def vectors(spark, sf_dir) -> DataFrame:
    """``vec_id, embedding``: some with NaN, some with an infinity."""

    def spoil(x, i):
        spoiled = F.when((i == 0) & (F.col("vec_id") % 19 == 0), F.lit(float("nan")))
        spoiled = spoiled.when((i == 1) & (F.col("vec_id") % 23 == 0), F.lit(float("inf")))
        spoiled = spoiled.when((i == 2) & (F.col("vec_id") % 23 == 0), F.lit(float("-inf")))
        return spoiled.otherwise(x).cast("float")

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", spoil).alias("embedding")
    )


def embedded_rows(spark, sf_dir) -> DataFrame:
    """Embedded chunks: each document whole, with a dense and a sparse vector and entities."""
    vecs = vectors(spark, sf_dir)
    n = table(spark, sf_dir, "embeddings").agg(F.count("*")).scalar()
    sparse = F.when(
        F.col("doc_id") % 23 != 0,
        F.create_map((F.col("doc_id") % 1000).cast("int"), F.col("n_chars") / F.lit(8.0)),
    ).otherwise(F.create_map().cast("map<int,double>"))
    entities = F.when(
        F.col("doc_id") % 2 == 0,
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("url"), F.concat(F.lit("entity:"), "lang")),
    )
    docs = table(spark, sf_dir, "documents").withColumn("vec_id", F.col("doc_id") % n)
    return docs.join(vecs, "vec_id").select(
        F.concat(F.md5(F.col("doc_id").cast("string")), F.lit("_1")).alias("unique_id"),
        F.col("source").alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")).alias(
            "last_updated"
        ),
        "text",
        F.md5(F.col("doc_id").cast("string")).alias("general_id"),
        "embedding",
        sparse.alias("bm25_sparse_vector"),
        entities.alias("entities"),
        "vec_id",
        "doc_id",
    )


def with_broken_vectors(rows: DataFrame) -> DataFrame:
    """Some vectors get a null element and so cannot be cleaned."""
    broken = F.transform(
        "embedding", lambda x, i: F.when(~((i == 3) & (F.col("vec_id") % 29 == 0)), x)
    )
    return rows.withColumn("embedding", broken)


def merge_old(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").where("doc_id % 6 <> 0").select("doc_id", "lang", "source")


def merge_new(spark, sf_dir) -> DataFrame:
    source = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("new:"), "source"))
    return (
        table(spark, sf_dir, "documents")
        .where("doc_id % 2 = 0")
        .select("doc_id", "lang", source.alias("source"), F.col("n_chars").alias("size"))
    )


def registry(spark, sf_dir) -> DataFrame:
    """Three chunk ids per page."""
    ids = page_list(spark, sf_dir).select("id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    return ids.select(F.concat_ws("_", "id", "n").alias("unique_id"))


def file_names(spark, sf_dir) -> DataFrame:
    """``doc_id, file_name``: collection names of several kinds, one per document."""
    n = F.col("doc_id") % 4
    name = (
        F.when(n == 0, F.concat(F.lit("documents-"), F.col("n_chars"), F.lit("chunksize.json")))
        .when(n == 1, F.concat(F.lit("sentsplit_documents-"), F.col("n_chars"), F.lit("sentences.json")))
        .when(n == 2, F.concat(F.lit("recursive-vectors-"), F.col("n_chars"), F.lit(f"chunksize-{MODEL}-sparse.json")))
        .otherwise(F.concat(F.lit("notes-"), "lang", F.lit(".json")))
    )
    return table(spark, sf_dir, "documents").select("doc_id", name.alias("file_name"))
