"""Schemas of the tables and interchange files."""

from pyspark.sql import types as T


def _s(name, kind=T.StringType()):
    return T.StructField(name, kind)


SITEMAP = T.StructType([_s("id"), _s("url"), _s("last_updated", T.DateType())])

PAGE_REF = T.StructType([_s("url"), _s("last_updated")])
KEYED_MAP = T.MapType(T.StringType(), PAGE_REF)

CHANGE_SET = T.StructType(
    [
        _s("removed", KEYED_MAP),
        _s("modified", KEYED_MAP),
        _s("added", KEYED_MAP),
        _s("timestamp", T.TimestampType()),
    ]
)

CHANGES = T.StructType(
    [
        _s("change_type"),
        _s("id"),
        _s("url"),
        _s("last_updated", T.DateType()),
        _s("change_ts", T.TimestampType()),
    ]
)

CRAWL = T.StructType([_s("url"), _s("html")])

PAGES = T.StructType(
    [
        _s("id"),
        _s("url"),
        _s("last_updated", T.DateType()),
        _s("html_content"),
        _s("extracted_title"),
        _s("extracted_content"),
    ]
)

CHUNKS = T.StructType(
    [
        _s("unique_id"),
        _s("url"),
        _s("last_updated", T.DateType()),
        _s("text"),
        _s("len", T.IntegerType()),
        _s("general_id"),
        _s("chunk_size", T.IntegerType()),
    ]
)

BM25_TERMS = T.StructType(
    [
        _s("term"),
        _s("term_idx", T.LongType()),
        _s("df", T.LongType()),
        _s("idf", T.DoubleType()),
    ]
)

BM25_PARAMS = T.StructType(
    [
        _s("n_docs", T.LongType()),
        _s("avgdl", T.DoubleType()),
        _s("k1", T.DoubleType()),
        _s("b", T.DoubleType()),
        _s("epsilon", T.DoubleType()),
        _s("avg_idf", T.DoubleType()),
    ]
)

# Stored statistics: what each batch adds to or takes from the corpus, and the parameters
# of the last refresh, which is made with the batches up to ``as_of``.
TERM_DELTAS = T.StructType([_s("term"), _s("term_idx", T.LongType()), _s("df", T.LongType())])
SIZE_DELTAS = T.StructType([_s("n_docs", T.LongType()), _s("n_tokens", T.LongType())])
STORED_PARAMS = T.StructType([*BM25_PARAMS.fields, _s("as_of", T.IntegerType())])

# The newest change applied per page; ``built``: its page was found in the crawl.
CHANGE_STATE = T.StructType(
    [
        _s("id"),
        _s("change_type"),
        _s("change_ts", T.TimestampType()),
        _s("last_updated", T.DateType()),
        _s("built", T.BooleanType()),
    ]
)

SPARSE_MAP = T.MapType(T.IntegerType(), T.DoubleType())

METADATA = T.StructType(
    [
        _s("url"),
        _s("text"),
        _s("general_id"),
        _s("chunk_size", T.IntegerType()),
        _s("doc_type"),
        _s("date", T.DateType()),
        _s("entities", T.MapType(T.StringType(), T.StringType())),
    ]
)

DOCUMENTS = T.StructType(
    [
        _s("unique_id"),
        _s("values", T.ArrayType(T.FloatType())),
        _s("sparse_values", SPARSE_MAP),
        _s("metadata", METADATA),
    ]
)

# ``mark`` is the hash of model and text that the vector was made from.
STORED_DOCUMENTS = T.StructType([*DOCUMENTS.fields, _s("mark")])

# JSON object keys are strings, so stored documents carry string indices.
DOCUMENTS_JSON = T.StructType(
    [
        _s("unique_id"),
        _s("values", T.ArrayType(T.FloatType())),
        _s("sparse_values", T.MapType(T.StringType(), T.DoubleType())),
        _s("metadata", METADATA),
    ]
)

SPARSE_PAIR = T.StructType(
    [
        _s("indices", T.ArrayType(T.IntegerType())),
        _s("values", T.ArrayType(T.DoubleType())),
    ]
)

VECTORS = T.StructType(
    [
        _s("id"),
        _s("values", T.ArrayType(T.FloatType())),
        _s("sparse_values", SPARSE_PAIR),
        _s(
            "metadata",
            T.StructType(METADATA.fields + [_s("project")]),
        ),
    ]
)

UNIQUE_IDS = T.StructType([_s("unique_id")])
