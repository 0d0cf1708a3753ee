"""Writers, the counterparts of ``readers``."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.operators.changes import to_change_sets, to_keyed_maps
from corpuslake.operators.documents import collection_name

ENTRIES_PER_FILE = 50_000  # sitemap protocol limit, also our bound for JSON objects


def shards_for(rows: int, per_shard: int = ENTRIES_PER_FILE) -> int:
    return max(1, -(-rows // per_shard))


def write_sitemaps(entries: DataFrame, path: str, column: str = "value") -> None:
    """Gzip sitemap files of at most ``ENTRIES_PER_FILE`` entries."""
    entries.select(column).write.option("maxRecordsPerFile", ENTRIES_PER_FILE).text(
        path, compression="gzip"
    )


def append_snapshot(pages: DataFrame, path: str, snapshot_id: int) -> str:
    """Adds one snapshot partition and returns its path; older ones stay for the diff.

    The partition is replaced as a whole, so a repeated run is harmless.
    """
    target = f"{path}/snapshot_id={int(snapshot_id)}"
    pages.select("id", "url", "last_updated").write.mode("overwrite").parquet(target)
    return target


def write_keyed_maps(pages: DataFrame, path: str) -> None:
    to_keyed_maps(pages, shards_for(pages.count())).write.text(path)


def write_change_sets(feed: DataFrame, path: str, per_document: int = ENTRIES_PER_FILE) -> int:
    """Change-set JSON documents, one per file; nothing is written for an empty feed.  Returns the row count.

    The readers take a file as one document, so that pretty-printed ones work too.
    """
    rows = feed.count()
    if rows:
        sets = to_change_sets(feed, shards_for(rows, per_document))
        sets.write.option("maxRecordsPerFile", 1).json(path, mode="append")
    return rows


def write_enriched_csv(pages: DataFrame, path: str) -> None:
    pages.write.csv(path, header=True, quote='"', escape='"', mode="overwrite")


def write_increment(pages: DataFrame, path: str, batch_id: str) -> str:
    """Only the new and updated pages of a run, as partition ``batch_id``."""
    target = f"{path}/batch_id={batch_id}"
    pages.write.mode("overwrite").parquet(target)
    return target


def write_documents(documents: DataFrame, path: str, model: str) -> None:
    """Documents as Parquet partitioned by type, chunk size and model."""
    parts = {
        "doc_type": F.col("metadata.doc_type"),
        "chunk_size": F.col("metadata.chunk_size"),
        "embedding_model": F.lit(model),
    }
    documents.withColumns(parts).write.mode("overwrite").partitionBy(*parts).parquet(path)


def write_collection(
    documents: DataFrame, folder: str, model: str, chunk_size: int, doc_type: str = C.DOC_TYPE
) -> str:
    """Documents as a JSON collection of gzip files under its conventional name."""
    target = f"{folder}/{collection_name(doc_type, chunk_size, model)}"
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(target, compression="gzip")
    return target


def write_bm25(terms: DataFrame, params: DataFrame, path: str, force: bool = False) -> None:
    """Statistics are created once; ``force`` replaces them."""
    mode = "overwrite" if force else "errorifexists"
    terms.write.mode(mode).parquet(f"{path}/terms")
    params.write.mode(mode).parquet(f"{path}/params")


def write_id_lists(ids: DataFrame, path: str, per_list: int = ENTRIES_PER_FILE) -> None:
    """Distinct ids as JSON arrays of bounded length, one per line."""
    distinct = ids.select("unique_id").distinct()
    shard = F.pmod(F.xxhash64("unique_id"), F.lit(shards_for(ids.count(), per_list)))
    lists = distinct.groupBy(shard.alias("shard")).agg(F.collect_list("unique_id").alias("ids"))
    lists.select(F.to_json("ids")).write.text(path)
