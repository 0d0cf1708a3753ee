"""Fixed values.  Results depend on these exact strings and numbers."""

# Sitemap entry pattern, matched with "." covering newlines.
ENTRY_PATTERN = r"<url>\s*<loc>(.*?)</loc>\s*<lastmod>(.*?)</lastmod>"

# Sitemap filter defaults.
EXCLUDED_EXTENSIONS = (".jpg", ".pdf", ".jpeg", ".png")
EXCLUDED_SUBSTRINGS = ("view",)
INCLUDED_SUBSTRINGS = ("/en/",)

# Page text: ordered selectors (tag, tag.class or tag#id) and placeholders.
TITLE_SELECTORS = ("h2.documentFirstHeading", "h2")
BODY_SELECTORS = ("div#parent-fieldname-text", "div#content-core")
TITLE_PLACEHOLDER = "Title not found"
BODY_PLACEHOLDER = "Main content not found"

# Chunking: separators from coarse to fine, size, overlap rule, minimum length.
SEPARATORS = ("\n\n", "\n", " ", "")
CHUNK_SIZE = 256
SMALL_CHUNK_LIMIT = 256
SMALL_CHUNK_OVERLAP = 50
LARGE_CHUNK_OVERLAP = 200
MIN_CHUNK_LENGTH = 50
DOC_TYPE = "recursive"

# BM25 parameters; avgdl fallback for statistics that lack one.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
BM25_DEFAULT_AVGDL = 1.0

# Names of stored collections, of document files and of indexes.
COLLECTION_NAME = "{doc_type}-vectors-{chunk_size}chunksize-{model}-sparse.json"
DOCUMENT_FILE_PATTERN = r"(sentsplit_)?documents-(\d+)(chunksize|sentences|-)"
INDEX_NAME = "%s-%s-dim%d-chunk%d"

# Vectors: NaN replacement and the metrics an index may carry.
NAN_REPLACEMENT = 0.1
FLOAT32_MAX = 3.4028234663852886e38
METRICS = ("cosine", "dotproduct", "euclidean")
