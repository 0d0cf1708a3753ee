"""Keyed upserts and deletes as joins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.functions.text import parent_id
from corpuslake.operators.common import keep_last, union_all


def upsert_keep_values(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """Null-preserving upsert: a null in a new row keeps the old value.

    Columns are the union of both sides; keys compare as strings.
    """
    shared = [c for c in old.columns if c in new.columns and c != key]
    only_new = [c for c in new.columns if c not in old.columns]
    left = old.withColumn(key, F.col(key).cast("string")).alias("o")
    right = new.withColumn(key, F.col(key).cast("string")).alias("n")
    joined = left.join(right, key, "full_outer")
    columns = [
        key
        if c == key
        else (F.coalesce(f"n.{c}", f"o.{c}") if c in shared else F.col(f"o.{c}")).alias(c)
        for c in old.columns
    ]
    return joined.select(*columns, *[F.col(f"n.{c}") for c in only_new])


def update_keep_values(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """The new rows of ``upsert_keep_values`` alone, in the columns of ``new``; old rows without a new one are not read on."""
    shared = [c for c in new.columns if c in old.columns and c != key]
    before = old.select(F.col(key).cast("string").alias(key), F.struct(*shared).alias("_old"))
    joined = new.withColumn(key, F.col(key).cast("string")).join(before, key, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_old.{c}")).alias(c) if c in shared else F.col(c) for c in new.columns]
    )


def upsert_replace(new: DataFrame, old: DataFrame, key: str = "unique_id", order=None) -> DataFrame:
    """A new row replaces the old one; of several new rows the last by ``order`` stays."""
    last = keep_last(new, key, order).select(*old.columns) if order else new
    return old.join(last.select(key), key, "left_anti").unionByName(last)


def index_of(values: str = "values", metadata: str = "metadata") -> Column:
    """What tells apart the indexes a vector can belong to: type, dimension and chunk size."""
    return F.struct(F.col(f"{metadata}.doc_type"), F.size(values), F.col(f"{metadata}.chunk_size"))


def vector_rank() -> Column:
    """Which of several records of one index and id is the last: by date, then by the hash of text and vector."""
    return F.struct(F.col("metadata.date").alias("at"), F.xxhash64("metadata.text", "values").alias("mark"))


def last_vectors(new: DataFrame) -> DataFrame:
    """One record per index and id, so that collections of several chunk sizes stay side by side.

    The last stays: by date, then by the hash of text and vector; equal records count once.
    The choice is made on narrow columns, the vectors are only joined.
    """
    keyed = new.select("*", index_of().alias("_index"), vector_rank().alias("_rank"))
    last = keyed.groupBy("id", "_index").agg(F.max("_rank").alias("_last"))
    one = keyed.join(last, ["id", "_index"]).where(F.col("_rank").eqNullSafe(F.col("_last")))
    return one.dropDuplicates(["id", "_index"]).select(*new.columns)


def upsert_vectors(new: DataFrame, old: DataFrame) -> DataFrame:
    """Replace by index and id; of several new rows of one id in an index the last stays."""
    one = last_vectors(new).withColumn("_index", index_of())
    kept = old.select("*", index_of().alias("_index")).join(one.select("id", "_index"), ["id", "_index"], "left_anti")
    return kept.select(*old.columns).unionByName(one.select(*old.columns))


def new_vectors_only(documents: DataFrame, index: DataFrame, asked: Column) -> DataFrame:
    """Documents whose id the asked index (type, dimension, chunk size) does not hold yet."""
    held = index.select(F.col("id").alias("unique_id"), index_of().alias("_index"))
    keyed = documents.select("*", asked.alias("_index"))
    return keyed.join(held, ["unique_id", "_index"], "left_anti").drop("_index")


def matched_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.join(old.select(key), key, "left_semi")


def unmatched_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.join(old.select(key), key, "left_anti")


def upsert_counts(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """One row: updated, added, total after the upsert."""
    sides = (
        old.select(key, F.lit(1).alias("o"), F.lit(0).alias("n"))
        .unionByName(new.select(key, F.lit(0).alias("o"), F.lit(1).alias("n")))
        .groupBy(key)
        .agg(F.max("o").alias("o"), F.max("n").alias("n"))
    )
    return sides.agg(
        F.count_if((F.col("o") == 1) & (F.col("n") == 1)).alias("updated"),
        F.count_if((F.col("o") == 0) & (F.col("n") == 1)).alias("added"),
        F.count("*").alias("total"),
    )


def chunk_ids_of(ids: DataFrame, registry: DataFrame, key: str = "unique_id") -> DataFrame:
    """Registry rows whose page id is listed: an equi-join on the id inside the chunk id."""
    listed = ids.select(F.col("id").alias("_page"))
    return (
        registry.withColumn("_page", parent_id(key)).join(listed, "_page", "left_semi").drop("_page")
    )


def delete_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed."""
    return rows.join(keys.select(key), key, "left_anti")


def delete_chunks_of(rows: DataFrame, ids: DataFrame, key: str = "unique_id") -> DataFrame:
    """Chunk-keyed rows whose page id is not listed."""
    listed = ids.select(F.col("id").alias("_page"))
    return rows.withColumn("_page", parent_id(key)).join(listed, "_page", "left_anti").drop("_page")


def deletion_counts(rows: DataFrame, keys: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Rows a delete removes, in total or by a grouping column."""
    gone = rows.join(keys.select(key), key, "left_semi")
    grouped = gone.groupBy(by) if by else gone.groupBy()
    return grouped.agg(F.count("*").alias("deleted"))


def register_ids(registry: DataFrame, documents: DataFrame) -> DataFrame:
    """Registry united with the ids of documents."""
    return registry.select("unique_id").union(documents.select("unique_id")).distinct()


def distinct_ids(documents: DataFrame) -> DataFrame:
    return documents.select("unique_id").distinct()


def append(new: DataFrame, old: DataFrame) -> DataFrame:
    return union_all(old, new)


def new_documents_only(documents: DataFrame, index: DataFrame, index_key: str = "id") -> DataFrame:
    """Documents whose id the index does not hold yet."""
    held = index.select(F.col(index_key).alias("unique_id"))
    return documents.join(held, "unique_id", "left_anti")
