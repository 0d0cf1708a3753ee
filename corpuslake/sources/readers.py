"""Readers for every input the corpus is fed from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake import schemas
from corpuslake.operators.changes import from_keyed_maps


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything on its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """``source, value``: one row per sitemap file, gzip or plain."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), "value"
    )


def read_keyed_maps(spark: SparkSession, path: str) -> DataFrame:
    """``id, url, last_updated`` from JSON objects keyed by id, one object per line."""
    return from_keyed_maps(spark.read.text(path))


def read_change_sets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHANGE_SET).option("multiLine", True).json(path)


_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose quoted fields may hold line breaks (HTML); empty fields come back null."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def read_enriched_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.PAGES)


def from_json_documents(rows: DataFrame) -> DataFrame:
    """Documents parsed from JSON: sparse indices back from strings to integers."""
    indices = F.transform_keys("sparse_values", lambda k, _: k.cast("int"))
    return rows.withColumn("sparse_values", indices)


def read_documents(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Stored documents.  JSON may be one object per line or one array per file."""
    if fmt == "parquet":
        return spark.read.schema(schemas.DOCUMENTS).parquet(path)
    return from_json_documents(spark.read.schema(schemas.DOCUMENTS_JSON).json(path))


def read_document_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of documents."""
    return from_json_documents(
        spark.read.schema(schemas.DOCUMENTS_JSON).option("multiLine", True).json(path)
    )


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """``unique_id`` from JSON arrays of strings, one array per line."""
    ids = F.from_json("value", "array<string>")
    return spark.read.text(path).select(F.explode(ids).alias("unique_id"))


def list_files(spark: SparkSession, prefix: str, suffix: str) -> DataFrame:
    """``file_path, length`` of every file below a prefix with a suffix; no content read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", True)
        .load(prefix)
    )
    return files.select(F.col("path").alias("file_path"), "length")


def read_collections(spark: SparkSession, folder: str, model: str) -> DataFrame:
    """Documents of every collection in a folder whose name holds the model name.

    Adds ``file_name``, the name of the collection each document came from.
    """
    pattern = f"{folder}/*{model}*.json"
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*chunksize[^/]*\.json)", 1)
    if not path_exists(spark, pattern):
        return empty(spark, schemas.DOCUMENTS).withColumn("file_name", F.lit(""))
    found = spark.read.schema(schemas.DOCUMENTS_JSON).json(pattern)
    return from_json_documents(found.select("*", name.alias("file_name")))


def empty(spark: SparkSession, schema) -> DataFrame:
    """No rows, and the optimizer knows: a join with them moves nothing."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


def read_or_empty(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A stored table, or no rows of its schema when it was never written."""
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).format(fmt).load(path)
