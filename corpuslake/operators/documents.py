"""Embedded chunks -> documents -> vector records."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.functions.embedding import embed_text
from corpuslake.functions.vectors import clean_vector, is_valid_vector, sparse_pair

_ENTITY_MAP = "map<string,string>"


def embed_chunks(
    chunks: DataFrame, load_model: Callable[[], object], text: str = "text"
) -> DataFrame:
    """Adds ``embedding``; rows the model fails on are dropped."""
    return chunks.withColumn("embedding", embed_text(F.col(text), load_model)).dropna(
        subset=["embedding"]
    )


def text_mark(model: str, text: str = "text") -> Column:
    """What a vector is made from: hash of the model's name and the text."""
    return F.sha2(F.concat(F.lit(f"{model}\0"), F.col(text)), 256)


def with_known_vectors(chunks: DataFrame, known: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Adds ``mark`` and ``_held``, the vector that ``known`` (``mark, values``) has for it, or null.

    Equal marks have equal vectors, so any one of them will do.
    """
    held = known.where(F.col("mark").isNotNull()).groupBy("mark").agg(F.first("values").alias("_held"))
    return chunks.withColumn("mark", text_mark(model, text)).join(held, "mark", "left")


def embed_unknown(matched: DataFrame, load_model: Callable[[], object], text: str = "text") -> DataFrame:
    """``_held`` becomes ``embedding``; the model sees only texts without one.  Rows the model fails on are dropped."""
    asked = F.when(F.col("_held").isNull(), F.col(text))
    found = matched.withColumn("_new", embed_text(asked, load_model))
    return found.withColumn("embedding", F.coalesce("_held", "_new")).drop("_held", "_new").dropna(subset=["embedding"])


def embed_changed_chunks(
    chunks: DataFrame, known: DataFrame, load_model: Callable[[], object], model: str, text: str = "text"
) -> DataFrame:
    """Adds ``embedding`` and ``mark``; the model sees only texts without a vector in ``known`` (``mark, values``)."""
    return embed_unknown(with_known_vectors(chunks, known, model, text), load_model, text)


def _column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def generate_documents(
    chunks: DataFrame, doc_type: str = C.DOC_TYPE, chunk_size: int | None = None, keep: tuple = ()
) -> DataFrame:
    """``unique_id, values, sparse_values, metadata``, and the columns to keep.

    Which fallback applies is decided by the columns present: ``id`` before
    ``general_id`` before ``'unknown'``; a random id without ``unique_id``; a
    date only with ``last_updated``.
    """
    size = F.col("chunk_size") if chunk_size is None else F.lit(chunk_size)
    general_id = _column_or(chunks, "id", _column_or(chunks, "general_id", F.lit("unknown")))
    metadata = F.struct(
        _column_or(chunks, "url", F.lit("")).alias("url"),
        _column_or(chunks, "text", F.lit("")).alias("text"),
        general_id.alias("general_id"),
        size.cast("int").alias("chunk_size"),
        F.lit(doc_type).alias("doc_type"),
        _column_or(chunks, "last_updated", F.lit(None)).cast("date").alias("date"),
        _column_or(chunks, "entities", F.lit(None)).cast(_ENTITY_MAP).alias("entities"),
    )
    no_vector = F.array().cast("array<float>")
    no_weights = F.create_map().cast("map<int,double>")
    return chunks.select(
        _column_or(chunks, "unique_id", F.uuid()).alias("unique_id"),
        _column_or(chunks, "embedding", no_vector).cast("array<float>").alias("values"),
        _column_or(chunks, "bm25_sparse_vector", no_weights).alias("sparse_values"),
        metadata.alias("metadata"),
        *keep,
    )


def overlay(base: Column, top: Column) -> Column:
    """Merge of two string maps where ``top`` wins."""
    top = F.coalesce(top, F.create_map().cast(_ENTITY_MAP))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k)), top)


def merged_metadata(metadata: str = "metadata") -> Column:
    """Flat ``map<string,string>`` of the metadata with the entities laid over it."""
    names = ("url", "text", "general_id", "chunk_size", "doc_type", "date")
    pairs = [
        F.struct(F.lit(n).alias("key"), F.col(f"{metadata}.{n}").cast("string").alias("value"))
        for n in names
    ]
    absent_date = lambda p: (p["key"] != "date") | p["value"].isNotNull()
    base = F.map_from_entries(F.filter(F.array(*pairs), absent_date))
    return overlay(base, F.col(f"{metadata}.entities"))


def valid_documents(documents: DataFrame) -> DataFrame:
    return documents.where(is_valid_vector(F.col("values")))


def quarantined_documents(documents: DataFrame) -> DataFrame:
    """Documents left out of an upload because their vector cannot be cleaned."""
    return documents.where(~is_valid_vector(F.col("values")))


def upload_records(documents: DataFrame, project: str, chunk_size: int | None = None) -> DataFrame:
    """``id, values, sparse_values, metadata``: cleaned vectors, stamped metadata."""
    size = F.col("metadata.chunk_size") if chunk_size is None else F.lit(chunk_size)
    metadata = (
        F.col("metadata")
        .withField("chunk_size", size.cast("int"))
        .withField("project", F.lit(project))
    )
    return valid_documents(documents).select(
        F.col("unique_id").alias("id"),
        clean_vector("values").alias("values"),
        sparse_pair(F.col("sparse_values")).alias("sparse_values"),
        metadata.alias("metadata"),
    )


def flat_records(rows: DataFrame, chunk_size: int, doc_type: str, project: str) -> DataFrame:
    """Upload records from flat rows; metadata is ``map<string,string>``.

    Absent text fields become ''.  Every further column joins the metadata
    under its own name and wins there.
    """
    own = ("unique_id", "values", "url", "last_updated", "text")
    fields = [
        (name, _column_or(rows, name, F.lit("")).cast("string"))
        for name in ("url", "last_updated", "text")
    ]
    fields += [
        ("chunk_size", F.lit(str(chunk_size))),
        ("doc_type", F.lit(doc_type)),
        ("project", F.lit(project)),
    ]
    kinds = dict(rows.dtypes)

    def as_text(name):
        nested = kinds[name].startswith(("struct", "array", "map"))
        return F.to_json(name) if nested else F.col(name).cast("string")

    def as_map(pairs):
        flat = [part for name, value in pairs for part in (F.lit(name), value)]
        return F.create_map(*flat).cast(_ENTITY_MAP)

    extra = [(name, as_text(name)) for name in rows.columns if name not in own]
    values = _column_or(rows, "values", F.array().cast("array<float>"))
    sparse = F.col("sparse_values") if "sparse_values" in rows.columns else None
    pair = F.lit(None) if sparse is None else sparse_pair(sparse)
    return rows.where(is_valid_vector(values)).select(
        _column_or(rows, "unique_id", F.lit("")).alias("id"),
        clean_vector(values).alias("values"),
        overlay(as_map(fields), as_map(extra)).alias("metadata"),
        pair.alias("sparse_values"),
    )


def reduced_records(documents: DataFrame, chunk_size: int, doc_type: str) -> DataFrame:
    """Dense-only records whose metadata is text, general_id, chunk_size, doc_type."""
    return documents.select(
        F.col("unique_id").alias("id"),
        "values",
        F.struct(
            F.col("metadata.text").alias("text"),
            F.col("metadata.general_id").alias("general_id"),
            F.lit(chunk_size).alias("chunk_size"),
            F.lit(doc_type).alias("doc_type"),
        ).alias("metadata"),
    )


def collection_name(doc_type: str, chunk_size, model: str) -> str:
    """Name of a stored document collection."""
    return C.COLLECTION_NAME.format(doc_type=doc_type, chunk_size=chunk_size, model=model)


def with_name_columns(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds ``doc_type`` and ``chunk_size`` read from a collection name; raises if absent.

    ``doc_type`` is the first dash-separated part, ``chunk_size`` the first part
    holding the word chunksize.
    """
    parts = F.split(name, "-")
    sized = F.filter(parts, lambda p: F.contains(p, F.lit("chunksize")))
    size = F.replace(F.get(sized, F.lit(0)), F.lit("chunksize"), F.lit("")).cast("int")
    problem = F.concat(F.lit("no chunk size in file name: "), F.col(name))
    return files.withColumn("doc_type", F.get(parts, F.lit(0))).withColumn(
        "chunk_size", F.coalesce(size, F.raise_error(problem).cast("int"))
    )


def with_name_class(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds ``doc_type`` sentence/token and ``chunk_size``; other names are skipped."""
    sentence = F.regexp_extract(name, C.DOCUMENT_FILE_PATTERN, 1) != ""
    return files.where(F.col(name).rlike(C.DOCUMENT_FILE_PATTERN)).select(
        *files.columns,
        F.when(sentence, "sentence").otherwise("token").alias("doc_type"),
        F.regexp_extract(name, C.DOCUMENT_FILE_PATTERN, 2).cast("int").alias("chunk_size"),
    )


def index_name(model: Column, doc_type: Column, values: Column, chunk_size: Column) -> Column:
    """Name of the index a vector belongs to."""
    return F.format_string(
        C.INDEX_NAME, F.replace(model, F.lit("_"), F.lit("-")), doc_type, F.size(values), chunk_size
    )


def index_stats(records: DataFrame, model: str) -> DataFrame:
    """Vector count by index name."""
    name = index_name(
        F.lit(model), F.col("metadata.doc_type"), F.col("values"), F.col("metadata.chunk_size")
    )
    return records.groupBy(name.alias("index_name")).agg(F.count("*").alias("vectors"))
