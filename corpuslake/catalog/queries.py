"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the benchmark tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake import schemas
from corpuslake.catalog import fixtures as fx
from corpuslake.functions import vectors as V
from corpuslake.functions.embedding import HashingEmbedder
from corpuslake.functions.html import extract_text
from corpuslake.functions.text import chunk_overlap, local_date, parent_id, tokens, url_key
from corpuslake.operators import bm25, changes, chunks, documents, enrich, merge, reports, sitemap
from corpuslake.operators.common import keep_last, union_all
from corpuslake.plans import jobs
from corpuslake.sources import readers, snapshots, writers
from corpuslake.sources.lake import Lake
from corpuslake.sources.scratch import checkpointed, scratch_path, stored
from corpuslake.streaming.feed import start_change_feed

QUERIES = {}
DIM = 64
SETTINGS = jobs.Settings(
    titles=fx.TITLES, bodies=fx.BODIES, load_model=lambda: HashingEmbedder(DIM), project=fx.PROJECT
)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# -- sitemaps --------------------------------------------------------------------


def _entries(spark, d):
    return sitemap.parse_entries(fx.sitemap_texts(spark, d))


@query
def sitemap_process(spark, d):
    return sitemap.process_sitemap(fx.sitemap_texts(spark, d), fx.BASE_URL, **fx.FILTERS)


@query
def sitemap_funnel(spark, d):
    return sitemap.sitemap_funnel(fx.sitemap_texts(spark, d), fx.BASE_URL, **fx.FILTERS)


@query
def sitemap_pattern(spark, d):
    """Elements of other names, found by a pattern of their own; two counts and the page list."""
    texts = fx.sitemap_texts(spark, d).withColumn(
        "value", F.replace(F.replace("value", F.lit("loc>"), F.lit("place>")), F.lit("lastmod>"), F.lit("day>"))
    )
    pattern = r"<place>(.*?)</place>.*?<day>(.*?)</day>"
    pages = sitemap.process_sitemap(texts, fx.BASE_URL, pattern=pattern, **fx.FILTERS)
    funnel = sitemap.sitemap_funnel(texts, fx.BASE_URL, pattern=pattern, **fx.FILTERS)
    return pages.withColumn("safe", funnel.select("safe").scalar())


@query
def sitemap_parse(spark, d):
    return _entries(spark, d)


@query
def sitemap_parse_strict(spark, d):
    return sitemap.parse_entries(fx.sitemap_texts(spark, d), mode="strict")


@query
def sitemap_gzip_scan(spark, d):
    path = scratch_path(spark, "sitemaps")
    writers.write_sitemaps(fx.sitemap_texts(spark, d), path)
    return sitemap.parse_entries(readers.read_sitemaps(spark, f"{path}/*.gz")).select("url", "lastmod")


@query
def local_dates(spark, d):
    return _entries(spark, d).select("source", "pos", local_date("lastmod").alias("last_updated"))


@query
def url_keys(spark, d):
    return fx.table(spark, d, "pages").select("page_id", url_key("url").alias("id"))


@query
def filter_extension(spark, d):
    return _entries(spark, d).where(sitemap.not_excluded_extension((".HTML",))).select("url", "lastmod")


@query
def filter_exclude(spark, d):
    return _entries(spark, d).where(sitemap.not_excluded_substring(("page=",))).select("url", "lastmod")


@query
def filter_include(spark, d):
    return _entries(spark, d).where(sitemap.included_substring(("/en/",))).select("url", "lastmod")


@query
def safe_split(spark, d):
    safe, unsafe = sitemap.split_safe(_entries(spark, d), fx.BASE_URL)
    return (
        safe.withColumn("is_safe", F.lit(True))
        .union(unsafe.withColumn("is_safe", F.lit(False)))
        .select("url", "lastmod", "is_safe")
    )


@query
def dedupe_last(spark, d):
    return sitemap.key_entries(_entries(spark, d), ["source", "pos"])


# -- snapshots and change sets ------------------------------------------------------


def _pair(spark, d):
    return fx.snapshot(spark, d, 1), fx.snapshot(spark, d, 2)


def _feed(spark, d):
    return changes.changes(*_pair(spark, d), change_ts=fx.CHANGE_TS)


@query
def latest_version(spark, d):
    return changes.version_by_age(fx.snapshots(spark, d), 0)


@query
def previous_version(spark, d):
    return changes.version_by_age(fx.snapshots(spark, d), 1)


@query
def snapshot_sink(spark, d):
    path = scratch_path(spark, "snapshots")
    for version in (0, 1, 2):
        writers.append_snapshot(fx.snapshot(spark, d, version), path, version)
    return changes.version_by_age(spark.read.parquet(path), 1)


@query
def keyed_map_scan(spark, d):
    path = scratch_path(spark, "keyed-maps")
    writers.write_keyed_maps(fx.page_list(spark, d), path)
    return readers.read_keyed_maps(spark, path)


@query
def diff_removed(spark, d):
    return changes.removed(*_pair(spark, d))


@query
def diff_modified(spark, d):
    return changes.modified(*_pair(spark, d))


@query
def diff_added(spark, d):
    return changes.added(*_pair(spark, d))


@query
def diff_full(spark, d):
    return changes.diff(*_pair(spark, d))


@query
def change_counts(spark, d):
    return changes.change_counts(changes.diff(*_pair(spark, d)))


@query
def change_message(spark, d):
    counts = changes.change_counts(changes.diff(*_pair(spark, d)))
    return counts.select(reports.change_message(path="changes").alias("message"))


@query
def key_intersection(spark, d):
    return changes.common_keys(*_pair(spark, d))


@query
def key_difference(spark, d):
    return changes.missing_keys(*_pair(spark, d))


@query
def ids_to_delete(spark, d):
    return changes.ids_to_delete(_feed(spark, d))


@query
def pages_to_fetch(spark, d):
    return changes.pages_to_fetch(_feed(spark, d))


@query
def change_set_files(spark, d):
    path = scratch_path(spark, "changes")
    writers.write_change_sets(checkpointed(_feed(spark, d)), path)
    return changes.from_change_sets(readers.read_change_sets(spark, path))


@query
def change_set_many_files(spark, d):
    """Three times of change and few entries to a document: many documents, none lost."""
    path = scratch_path(spark, "changes")
    later = F.make_dt_interval((F.length("url") % 3).cast("int"))
    feed = _feed(spark, d).withColumn("change_ts", F.col("change_ts") + later)
    writers.write_change_sets(checkpointed(feed), path, per_document=20)
    return changes.from_change_sets(readers.read_change_sets(spark, path))


@query
def change_set_json(spark, d):
    docs = changes.to_change_sets(_feed(spark, d), shards=16)
    text = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    parsed = text.select(F.from_json("value", schemas.CHANGE_SET).alias("c")).select("c.*")
    return changes.from_change_sets(parsed)


@query
def diff_snapshots_job(spark, d):
    path = scratch_path(spark, "snapshots")
    for version in (0, 1, 2):
        writers.append_snapshot(fx.snapshot(spark, d, version), path, version)
    report = jobs.diff_snapshots(spark.read.parquet(path), scratch_path(spark, "changes"), fx.CHANGE_TS)
    return report.drop("message")


def _stored_snapshots(spark, d):
    path = scratch_path(spark, "snapshots")
    for version in (0, 1, 2):
        snapshots.write_snapshot(fx.snapshot(spark, d, version), path, version, digits=1)
    return path


@query
def diff_stored_job(spark, d):
    """The snapshot job over bucketed snapshots."""
    report = jobs.diff_stored_snapshots(spark, _stored_snapshots(spark, d), scratch_path(spark, "changes"), fx.CHANGE_TS)
    return report.drop("message")


@query
def diff_changed_buckets(spark, d):
    """All changes, from the buckets whose digests differ."""
    found = snapshots.diff_changed_buckets(spark, _stored_snapshots(spark, d), 1, 2)
    return found.where("change_type <> 'unchanged'")


# -- pages --------------------------------------------------------------------------


def _enriched(spark, d, **kw):
    return enrich.enrich_pages(fx.page_list(spark, d), fx.crawl(spark, d), fx.TITLES, fx.BODIES, **kw)


@query
def page_lookup(spark, d):
    return enrich.lookup_html(fx.page_list(spark, d), fx.crawl(spark, d))


@query
def page_lookup_latest(spark, d):
    pages = fx.table(spark, d, "pages")
    fetches = pages.select("url", "html", F.lit(1).alias("fetched_at")).union(
        pages.select("url", F.concat(F.lit("old "), "url"), F.lit(0))
    )
    return enrich.lookup_html(fx.page_list(spark, d), fetches, latest_by="fetched_at")


@query
def drop_null_html(spark, d):
    found = enrich.lookup_html(fx.page_list(spark, d), fx.crawl(spark, d))
    return enrich.drop_null_html(found).select("id", "url")


@query
def extract_title(spark, d):
    text = extract_text(F.col("html"), fx.TITLES, fx.BODIES)
    return fx.table(spark, d, "pages").select("page_id", text["extracted_title"].alias("extracted_title"))


@query
def extract_body(spark, d):
    text = extract_text(F.col("html"), ("no-such-tag",), fx.BODIES)
    return fx.table(spark, d, "pages").select(
        "page_id", text["extracted_content"].alias("extracted_content")
    )


@query
def extract_table(spark, d):
    found = enrich.lookup_html(fx.page_list(spark, d), fx.crawl(spark, d))
    return enrich.add_extracted(found, fx.TITLES, fx.BODIES).drop("html_content")


@query
def placeholder_filter(spark, d):
    """Default selectors match no page, so only failed and empty fetches stay."""
    found = enrich.lookup_html(fx.page_list(spark, d), fx.crawl(spark, d))
    return enrich.drop_placeholders(enrich.add_extracted(found)).drop("html_content")


@query
def null_audit(spark, d):
    return enrich.null_audit(enrich.lookup_html(fx.page_list(spark, d), fx.crawl(spark, d)))


@query
def enrich_pages(spark, d):
    return _enriched(spark, d)


@query
def enrich_pages_update(spark, d):
    return _enriched(spark, d, drop_null=True)


@query
def enriched_csv_scan(spark, d):
    path = scratch_path(spark, "enriched-csv")
    writers.write_enriched_csv(_enriched(spark, d), path)
    return readers.read_enriched_csv(spark, path)


@query
def enriched_sink(spark, d):
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    lake.begin("load")
    lake.append("pages", _enriched(spark, d))
    lake.commit("load")
    return lake.read("pages")


@query
def increment_sink(spark, d):
    path = scratch_path(spark, "increments")
    writers.write_increment(changes.pages_to_fetch(_feed(spark, d)), path, "2024-03")
    return spark.read.parquet(path)


@query
def read_or_empty(spark, d):
    absent = readers.read_or_empty(spark, scratch_path(spark, "absent"), schemas.SITEMAP)
    return union_all(fx.page_list(spark, d), absent)


@query
def listing_scan(spark, d):
    path = scratch_path(spark, "listing")
    for name in ("a", "b"):
        fx.table(spark, d, "labels").coalesce(1).write.json(f"{path}/json-{name}")
        fx.table(spark, d, "labels").coalesce(1).write.csv(f"{path}/csv-{name}")
    files = readers.list_files(spark, path, ".json")
    return files.agg(F.count("*").alias("files"), F.count_if(F.col("length") > 0).alias("non_empty"))


# -- chunks ---------------------------------------------------------------------------


@query
def chunk_documents(spark, d):
    return chunks.chunk_pages(fx.corpus(spark, d), min_length=0)


@query
def chunk_min_length(spark, d):
    return chunks.chunk_pages(fx.corpus(spark, d)).select("unique_id", "len")


@query
def chunk_multi_size(spark, d):
    return chunks.chunk_pages(fx.corpus(spark, d), sizes=(128, 256, 512)).select(
        "unique_id", "chunk_size", "len", "text"
    )


@query
def chunk_raw_text(spark, d):
    """Uncollapsed text, so line breaks split before blanks do."""
    raw = fx.table(spark, d, "documents").select(
        F.md5(F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("extracted_content")
    )
    return chunks.chunk_pages(raw, min_length=0).select("unique_id", "len", "text")


def _words_in(text):
    return len(text.split())


@query
def chunk_token_length(spark, d):
    """Chunks of at most 96 tokens, 50 of them shared with the one before; a token is a word."""
    return chunks.chunk_pages(fx.corpus(spark, d), sizes=(96,), min_length=0, length=_words_in).select(
        "unique_id", "chunk_size", "text"
    )


@query
def chunk_null_text(spark, d):
    """Pages without text give no chunk."""
    some = F.when(F.col("doc_id") % 7 != 0, F.col("extracted_content"))
    pages = fx.corpus(spark, d).withColumn("extracted_content", some)
    return chunks.chunk_pages(pages).select("unique_id", "len")


@query
def chunk_stats(spark, d):
    rows = chunks.chunk_pages(fx.corpus(spark, d), sizes=(128, 256))
    stats = chunks.chunk_stats(rows)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_len", "median_len")})


@query
def overlap_rule(spark, d):
    return fx.table(spark, d, "documents").select(
        "doc_id", chunk_overlap(F.col("n_chars").cast("int")).alias("overlap")
    )


# -- BM25 -------------------------------------------------------------------------------


def _bm25(spark, d):
    return bm25.build_bm25(fx.corpus(spark, d), "extracted_content", "doc_id")


def _chunks_and_bm25(spark, d):
    """Chunks of the corpus, its terms and parameters, and where weights are made: by page, in parts of like size."""
    pages = stored(fx.corpus(spark, d))
    terms, params = bm25.build_bm25(pages, "extracted_content", "doc_id")
    parts = bm25.parts_of(pages, "extracted_content")
    page = F.xxhash64(parent_id("unique_id"))
    where = {"place": [F.pmod(page, F.lit(parts)).cast("int")], "parts": parts}
    return chunks.chunk_pages(pages), terms, params, where


@query
def tokenize(spark, d):
    return bm25.tokenize(fx.table(spark, d, "documents"), "text", "doc_id").select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "term"
    )


@query
def term_freq(spark, d):
    rows = chunks.chunk_pages(fx.corpus(spark, d)).select("unique_id", "text")
    return bm25.term_frequency(rows).select("unique_id", "term", "tf", "doc_len")


@query
def doc_freq(spark, d):
    return bm25.document_frequency(fx.corpus(spark, d), "extracted_content")


@query
def average_length(spark, d):
    row = bm25.average_length(fx.corpus(spark, d), "extracted_content")
    return row.withColumn("avgdl", F.round("avgdl", 6))


@query
def vocabulary_set(spark, d):
    return bm25.vocabulary(fx.table(spark, d, "documents"), "text")


@query
def bm25_vocab(spark, d):
    return _bm25(spark, d)[0].select("term", "term_idx")


@query
def bm25_idf(spark, d):
    return _bm25(spark, d)[0].select("term", "df", F.round("idf", 6).alias("idf"))


@query
def bm25_params(spark, d):
    params = _bm25(spark, d)[1]
    return params.withColumns({c: F.round(c, 6) for c in ("avgdl", "avg_idf")})


@query
def bm25_sink(spark, d):
    path = scratch_path(spark, "bm25")
    writers.write_bm25(*_bm25(spark, d), path)
    terms = readers.read_or_empty(spark, f"{path}/terms", schemas.BM25_TERMS)
    return terms.withColumn("idf", F.round("idf", 6))


@query
def bm25_sparse(spark, d):
    rows, terms, params, where = _chunks_and_bm25(spark, d)
    weights = bm25.sparse_weights(rows, terms, params, **where)
    return weights.withColumn("score", F.round("score", 6))


@query
def bm25_sparse_defaults(spark, d):
    """Statistics without parameters: k1 1.5, b 0.75, avgdl 1."""
    rows, terms, _, where = _chunks_and_bm25(spark, d)
    weights = bm25.sparse_weights(rows, terms, None, **where)
    return weights.withColumn("score", F.round("score", 6))


@query
def bm25_sparse_vectors(spark, d):
    """Vectors as maps, unpacked again."""
    rows, terms, params, where = _chunks_and_bm25(spark, d)
    vectors = bm25.add_sparse_vectors(rows.select("unique_id", "text"), terms, params, **where)
    return vectors.select(
        "unique_id", F.explode("bm25_sparse_vector").alias("term_idx", "score")
    ).withColumn("score", F.round("score", 6))


@query
def bm25_fallback_vocabulary(spark, d):
    """Statistics of the documents applied to another text set that brings its own words."""
    idf = bm25.document_frequency(fx.table(spark, d, "benchmark"), "text").withColumn(
        "idf", F.round(1.0 / F.col("df"), 6)
    )
    return bm25.fallback_terms(fx.table(spark, d, "documents"), "text", idf)


# -- vectors and documents -------------------------------------------------------------------


def _documents(spark, d):
    return documents.generate_documents(fx.embedded_rows(spark, d), C.DOC_TYPE, C.CHUNK_SIZE)


def _unpacked(df, key, column, **extra):
    return df.select(key, F.posexplode(column).alias("pos", "value")).select(
        key, "pos", F.col("value").cast("double").alias("value")
    )


@query
def vector_clean(spark, d):
    clean = fx.vectors(spark, d).select("vec_id", V.clean_vector("embedding").alias("v"))
    return _unpacked(clean, "vec_id", "v")


@query
def sparse_format(spark, d):
    pairs = fx.embedded_rows(spark, d).select(
        "unique_id", V.sparse_pair(F.col("bm25_sparse_vector")).alias("s")
    )
    return pairs.select(
        "unique_id", F.explode(F.arrays_zip("s.indices", "s.values")).alias("e")
    ).select("unique_id", F.col("e.indices").alias("idx"), F.col("e.values").alias("weight"))


@query
def sparse_omitted_if_empty(spark, d):
    return documents.upload_records(_documents(spark, d), fx.PROJECT).select(
        "id", F.col("sparse_values").isNotNull().alias("has_sparse")
    )


@query
def invalid_vectors(spark, d):
    rows = fx.with_broken_vectors(fx.embedded_rows(spark, d))
    docs = documents.generate_documents(rows, C.DOC_TYPE, C.CHUNK_SIZE)
    good = documents.upload_records(docs, fx.PROJECT).select("id", F.lit("uploaded").alias("outcome"))
    bad = documents.quarantined_documents(docs).select(
        F.col("unique_id").alias("id"), F.lit("quarantined").alias("outcome")
    )
    return good.union(bad)


@query
def metric_scores(spark, d):
    """Each vector against the mean vector of its label, under the three metrics."""
    vecs = fx.table(spark, d, "embeddings")
    parts = vecs.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centre = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("c")
    )
    joined = vecs.join(centre, "label")
    return joined.select(
        "vec_id",
        *[
            F.round(V.metric_score(F.col("embedding"), F.col("c"), metric), 4).alias(metric)
            for metric in C.METRICS
        ],
    )


@query
def embed_chunks(spark, d):
    rows = chunks.chunk_pages(fx.corpus(spark, d)).select("unique_id", "text")
    vectors = documents.embed_chunks(rows, lambda: HashingEmbedder(DIM))
    values = _unpacked(vectors, "unique_id", "embedding")
    return values.where("value <> 0").withColumn("value", F.round("value", 4))


@query
def generate_documents(spark, d):
    return _documents(spark, d).select(
        "unique_id",
        "metadata.url",
        "metadata.text",
        "metadata.general_id",
        "metadata.chunk_size",
        "metadata.doc_type",
        "metadata.date",
        F.size("values").alias("dim"),
        F.size("sparse_values").alias("n_sparse"),
    )


@query
def document_fallbacks(spark, d):
    """Rows without page id, text or date columns."""
    rows = fx.embedded_rows(spark, d).select("unique_id", "embedding")
    docs = documents.generate_documents(rows, C.DOC_TYPE, C.CHUNK_SIZE)
    return docs.select(
        "unique_id",
        "metadata.url",
        "metadata.text",
        "metadata.general_id",
        F.col("metadata.date").isNull().alias("no_date"),
    )


@query
def entities_merge(spark, d):
    return _documents(spark, d).select(
        "unique_id", F.explode(documents.merged_metadata()).alias("name", "value")
    )


@query
def upload_records(spark, d):
    rows = documents.upload_records(_documents(spark, d), fx.PROJECT)
    return rows.select(
        "id",
        F.size("values").alias("dim"),
        F.element_at("values", 1).cast("double").alias("first_value"),
        F.element_at("sparse_values.indices", 1).alias("first_idx"),
        "metadata.text",
        "metadata.chunk_size",
        "metadata.project",
    )


@query
def flat_records(spark, d):
    rows = fx.embedded_rows(spark, d).select(
        "unique_id",
        F.col("embedding").alias("values"),
        "url",
        "text",
        "general_id",
        F.lit("override").alias("project"),
    )
    flat = documents.flat_records(rows, C.CHUNK_SIZE, C.DOC_TYPE, fx.PROJECT)
    return flat.select("id", F.explode("metadata").alias("name", "value"))


@query
def reduced_records(spark, d):
    rows = documents.reduced_records(_documents(spark, d), 128, "token")
    return rows.select("id", F.size("values").alias("dim"), "metadata.*")


@query
def filename_columns(spark, d):
    size = F.col("n_chars").cast("string")
    name = F.concat("lang", F.lit("-vectors-"), size, F.lit(f"chunksize-{fx.MODEL}-sparse.json"))
    names = fx.table(spark, d, "documents").select("doc_id", name.alias("file_name"))
    return documents.with_name_columns(names)


@query
def filename_classes(spark, d):
    return documents.with_name_class(fx.file_names(spark, d))


@query
def index_names(spark, d):
    name = documents.index_name(
        F.lit(fx.MODEL), F.col("metadata.doc_type"), F.col("values"), F.col("metadata.chunk_size")
    )
    return _documents(spark, d).select("unique_id", name.alias("index_name"))


@query
def index_stats(spark, d):
    records = documents.upload_records(_documents(spark, d), fx.PROJECT)
    return documents.index_stats(records, fx.MODEL)


def _document_summary(docs):
    return docs.select(
        "unique_id",
        "metadata.general_id",
        "metadata.text",
        F.size("values").alias("dim"),
        F.get(F.map_keys("sparse_values"), F.lit(0)).alias("first_idx"),
    )


@query
def document_json(spark, d):
    docs = _documents(spark, d)
    text = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    parsed = text.select(F.from_json("value", schemas.DOCUMENTS_JSON).alias("doc")).select("doc.*")
    return _document_summary(readers.from_json_documents(parsed))


@query
def document_array_scan(spark, d):
    path = scratch_path(spark, "doc-arrays")
    docs = _documents(spark, d)
    shard = F.pmod(F.xxhash64("unique_id"), F.lit(writers.shards_for(docs.count(), 500)))
    arrays = docs.groupBy(shard.alias("shard")).agg(F.collect_list(F.struct(*docs.columns)).alias("a"))
    arrays.select(F.to_json("a")).write.option("maxRecordsPerFile", 1).text(path)
    return _document_summary(readers.read_document_arrays(spark, path))


@query
def document_sink(spark, d):
    path = scratch_path(spark, "documents")
    writers.write_documents(_documents(spark, d), path, fx.MODEL)
    return _document_summary(readers.read_documents(spark, path, "parquet"))


@query
def model_folder_scan(spark, d):
    folder = scratch_path(spark, "collections")
    writers.write_collection(_documents(spark, d), folder, fx.MODEL, 256)
    writers.write_collection(_documents(spark, d), folder, "other", 128)
    found = readers.read_collections(spark, folder, fx.MODEL)
    return documents.with_name_columns(found).groupBy("file_name", "doc_type", "chunk_size").agg(
        F.count("*").alias("documents")
    )


# -- merges and deletes -------------------------------------------------------------------------


@query
def upsert_null_preserving(spark, d):
    new, old = fx.merge_new(spark, d), fx.merge_old(spark, d)
    return merge.upsert_keep_values(new, old, "doc_id")


@query
def upsert_replace(spark, d):
    """Every new row comes twice; the later one stays."""
    new, old = fx.merge_new(spark, d).drop("size"), fx.merge_old(spark, d)
    stale = new.withColumn("source", F.lit("stale")).withColumn("seq", F.lit(0))
    both = stale.unionByName(new.withColumn("seq", F.lit(1)))
    return merge.upsert_replace(both, old, "doc_id", ["seq"])


@query
def upsert_counts(spark, d):
    return merge.upsert_counts(fx.merge_new(spark, d), fx.merge_old(spark, d), "doc_id")


@query
def update_insert_split(spark, d):
    new, old = fx.merge_new(spark, d), fx.merge_old(spark, d)
    return (
        merge.matched_rows(new, old, "doc_id")
        .withColumn("kind", F.lit("update"))
        .union(merge.unmatched_rows(new, old, "doc_id").withColumn("kind", F.lit("insert")))
    )


@query
def append_concat(spark, d):
    return merge.append(fx.merge_new(spark, d), fx.merge_old(spark, d))


@query
def drop_incomplete(spark, d):
    old = _enriched(spark, d).withColumnRenamed("extracted_title", "t").drop("t")
    return enrich.drop_incomplete(old).select("id", "url", "extracted_content")


def _gone(spark, d):
    return changes.ids_to_delete(_feed(spark, d))


@query
def chunk_ids_by_page(spark, d):
    return merge.chunk_ids_of(_gone(spark, d), fx.registry(spark, d))


def _chunk_rows(spark, d):
    """Registry rows as documents in two collections."""
    ordinal = F.element_at(F.split("unique_id", "_"), -1).cast("int")
    name = F.when(ordinal == 1, "first.json").otherwise("rest.json")
    return fx.registry(spark, d).withColumn("ordinal", ordinal).withColumn("file_name", name)


@query
def delete_documents(spark, d):
    ids = merge.chunk_ids_of(_gone(spark, d), fx.registry(spark, d))
    return merge.delete_rows(_chunk_rows(spark, d), ids, "unique_id")


@query
def delete_documents_by_prefix(spark, d):
    return merge.delete_chunks_of(_chunk_rows(spark, d), _gone(spark, d))


@query
def deletion_counts(spark, d):
    ids = merge.chunk_ids_of(_gone(spark, d), fx.registry(spark, d))
    return merge.deletion_counts(_chunk_rows(spark, d), ids, "unique_id", "file_name")


@query
def delete_pages(spark, d):
    return merge.delete_rows(fx.page_list(spark, d), _gone(spark, d), "id")


@query
def registry_delete(spark, d):
    ids = merge.chunk_ids_of(_gone(spark, d), fx.registry(spark, d))
    return merge.delete_rows(fx.registry(spark, d), ids, "unique_id")


@query
def registry_union(spark, d):
    docs = fx.embedded_rows(spark, d)
    both = docs.select("unique_id").union(fx.registry(spark, d))
    return merge.register_ids(fx.registry(spark, d), both)


@query
def registry_sink(spark, d):
    path = scratch_path(spark, "ids")
    twice = fx.registry(spark, d).union(fx.registry(spark, d))
    writers.write_id_lists(twice, path, per_list=100)
    return readers.read_id_lists(spark, path)


@query
def distinct_ids(spark, d):
    docs = fx.embedded_rows(spark, d)
    return merge.distinct_ids(docs.select("unique_id").union(docs.select("unique_id")))


@query
def insert_only(spark, d):
    docs = fx.embedded_rows(spark, d).select("unique_id", "general_id", "doc_id")
    held = docs.where(F.col("doc_id") % 3 == 0).select(F.col("unique_id").alias("id"))
    return merge.new_documents_only(docs, held)


@query
def delete_vectors(spark, d):
    records = documents.upload_records(_documents(spark, d), fx.PROJECT).select("id", "metadata.text")
    gone = fx.table(spark, d, "labels").where("toxic = 1").select(
        F.concat(F.md5(F.col("doc_id").cast("string")), F.lit("_1")).alias("id")
    )
    return merge.delete_rows(records, gone, "id")


# -- jobs ------------------------------------------------------------------------------------------


def _loaded(spark, d, version=1):
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.initial_load(lake, fx.snapshot(spark, d, version), fx.crawl(spark, d), SETTINGS, batch_id="initial")
    return lake


def _updated(spark, d):
    lake = _loaded(spark, d)
    report = jobs.apply_changes(lake, _feed(spark, d), fx.crawl(spark, d), SETTINGS, batch_id="update")
    return lake, report


@query
def initial_load(spark, d):
    """Vectors after a first load."""
    lake = _loaded(spark, d, 0)
    return lake.read("vectors").select(
        "id", "metadata.general_id", "metadata.text", "metadata.project"
    )


@query
def incremental_pages(spark, d):
    """Page table after load and one change feed."""
    lake, _ = _updated(spark, d)
    return lake.read("pages").select("id", "url", "last_updated", "extracted_content")


@query
def incremental_vectors(spark, d):
    """Vector table after load and one change feed."""
    lake, _ = _updated(spark, d)
    return lake.read("vectors").select("id", "metadata.general_id", "metadata.text", "metadata.date")


@query
def initial_load_values(spark, d):
    """Dense vectors of the first load, component by component."""
    values = _unpacked(_loaded(spark, d, 0).read("vectors"), "id", "values")
    return values.where("value <> 0").withColumn("value", F.round("value", 4))


@query
def initial_load_sparse(spark, d):
    """Sparse vectors of the first load by term."""
    lake = _loaded(spark, d, 0)
    pairs = lake.read("vectors").select("id", F.inline(F.arrays_zip("sparse_values.indices", "sparse_values.values")))
    terms, _ = jobs.stored_bm25(lake)
    return bm25.name_terms(pairs, terms).select("id", "term", F.round("values", 6).alias("weight"))


@query
def incremental_values(spark, d):
    """Dense vectors after load and update; those of unchanged chunks were not made again."""
    lake, _ = _updated(spark, d)
    values = _unpacked(lake.read("vectors"), "id", "values")
    return values.where("value <> 0").withColumn("value", F.round("value", 4))


@query
def refreshed_bm25(spark, d):
    """Statistics refreshed from the changes of an update: as if made over all pages."""
    lake = _loaded(spark, d)
    jobs.apply_changes(lake, _feed(spark, d), fx.crawl(spark, d), SETTINGS, batch_id="update", refresh_bm25=True)
    terms, params = jobs.stored_bm25(lake)
    numbers = {"n_docs": params.select("n_docs").scalar()}
    numbers |= {c: F.round(params.select(c).scalar(), 6) for c in ("avgdl", "avg_idf")}
    return terms.select("term", "df", F.round("idf", 6).alias("idf"), *[v.alias(c) for c, v in numbers.items()])


def _feeds(spark, d):
    """Changes from version 0 to 1 and from 1 to 2, a day apart."""
    first = changes.changes(fx.snapshot(spark, d, 0), fx.snapshot(spark, d, 1), "2024-02-29 00:00:00")
    return first, _feed(spark, d)


@query
def late_change_sets(spark, d):
    """Pages after the newer of two change sets was applied before the older one."""
    lake = _loaded(spark, d, 0)
    older, newer = _feeds(spark, d)
    for n, feed in enumerate((newer, older)):
        jobs.apply_changes(lake, feed, fx.crawl(spark, d), SETTINGS, batch_id=f"b{n}")
    return lake.read("pages").select("id", "url", "last_updated", "extracted_content")


@query
def change_stream_late(spark, d):
    """The same two change sets, streamed file by file in the wrong order."""
    lake = _loaded(spark, d, 0)
    path, feed = scratch_path(spark, "changes"), scratch_path(spark, "feed")
    for changed in reversed(_feeds(spark, d)):
        writers.write_change_sets(checkpointed(changed), path)
        start_change_feed(spark, path, feed, lake, fx.crawl(spark, d), SETTINGS).awaitTermination()
    return lake.read("pages").select("id", "url", "last_updated", "extracted_content")


TWO_SIZES = replace(SETTINGS, chunk_sizes=(128, 256))


@query
def load_two_sizes(spark, d):
    """Vectors of two chunk sizes after one load."""
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.initial_load(lake, fx.snapshot(spark, d, 0), fx.crawl(spark, d), TWO_SIZES, batch_id="initial")
    return lake.read("vectors").select("id", "metadata.chunk_size", "metadata.text")


@query
def update_two_sizes(spark, d):
    """Vectors of two chunk sizes after load and update."""
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.initial_load(lake, fx.snapshot(spark, d, 1), fx.crawl(spark, d), TWO_SIZES, batch_id="initial")
    jobs.apply_changes(lake, _feed(spark, d), fx.crawl(spark, d), TWO_SIZES, batch_id="update")
    return lake.read("vectors").select("id", "metadata.chunk_size", "metadata.text")


@query
def empty_batch(spark, d):
    """A feed without changes leaves the registry as it was."""
    lake = _loaded(spark, d, 0)
    jobs.apply_changes(lake, _feed(spark, d).where("false"), fx.crawl(spark, d), SETTINGS, batch_id="empty")
    return lake.read("registry")


@query
def incremental_registry(spark, d):
    lake, _ = _updated(spark, d)
    return lake.read("registry")


@query
def run_report(spark, d):
    _, report = _updated(spark, d)
    return report.drop("batch_id")


@query
def change_stream(spark, d):
    """Page table after the change sets arrived as a stream."""
    lake = _loaded(spark, d)
    path = scratch_path(spark, "changes")
    writers.write_change_sets(checkpointed(_feed(spark, d)), path)
    started = start_change_feed(
        spark, path, scratch_path(spark, "feed"), lake, fx.crawl(spark, d), SETTINGS
    )
    started.awaitTermination()
    return lake.read("pages").select("id", "url", "last_updated", "extracted_content")


@query
def publish_vectors(spark, d):
    """Upsert of all documents over an index that holds some of them."""
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    docs = stored(_documents(spark, d))
    jobs.publish_vectors(lake, docs.where("metadata.url <> 'web'"), "older", "one", settled=True)
    jobs.publish_vectors(lake, docs, fx.PROJECT, "two", settled=True)
    return lake.read("vectors").select("id", "metadata.project", "metadata.text")


@query
def publish_new_vectors(spark, d):
    """Insert-only: rows already in the index keep their project."""
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    docs = stored(_documents(spark, d))
    older = docs.where(F.col("metadata.entities").isNotNull())
    jobs.publish_vectors(lake, older, "older", "one", settled=True)
    jobs.publish_new_vectors(lake, docs, C.CHUNK_SIZE, C.DOC_TYPE, "two", settled=True)
    return lake.read("vectors").select("id", "metadata.project", "metadata.text")


@query
def publish_repeated_then_delete(spark, d):
    """Insert-only of documents that come twice gives one vector each; a delete of their pages finds them."""
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    docs = stored(_documents(spark, d))
    jobs.publish_new_vectors(lake, docs.union(docs), C.CHUNK_SIZE, C.DOC_TYPE, "one")
    gone = fx.table(spark, d, "documents").where("doc_id % 5 = 0").select(
        F.lit("removed").alias("change_type"),
        F.md5(F.col("doc_id").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("date").alias("last_updated"),
        F.lit(fx.CHANGE_TS).cast("timestamp").alias("change_ts"),
    )
    jobs.apply_changes(lake, gone, fx.crawl(spark, d), SETTINGS, batch_id="two")
    return _unpacked(lake.read("vectors"), "id", "values")


@query
def load_repeated_fetches(spark, d):
    """A crawl that holds every page three times still gives one page a url: the latest fetch."""
    crawl = fx.crawl(spark, d).withColumn("fetched_at", F.lit(2))
    older = crawl.select("url", F.lit("<h1>old</h1>").alias("html"), F.lit(1).alias("fetched_at"))
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.initial_load(
        lake, fx.snapshot(spark, d, 0), crawl.union(older).union(crawl), SETTINGS, batch_id="initial"
    )
    return lake.read("pages").select("id", "extracted_content")


@query
def publish_two_sizes(spark, d):
    """Collections of two chunk sizes stay side by side; publishing one again changes nothing of the other."""
    folder, again = scratch_path(spark, "collections"), scratch_path(spark, "collections")
    docs = stored(_documents(spark, d))
    for size in (128, 256):
        writers.write_collection(docs, folder, fx.MODEL, size)
    writers.write_collection(docs.union(docs), again, fx.MODEL, 128)
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.publish_folder(lake, folder, fx.MODEL, fx.PROJECT, "one")
    jobs.publish_folder(lake, again, fx.MODEL, fx.PROJECT, "two")
    return lake.read("vectors").select("id", "metadata.project", "metadata.chunk_size")


@query
def publish_folder(spark, d):
    folder = scratch_path(spark, "collections")
    writers.write_collection(_documents(spark, d), folder, fx.MODEL, 128)
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.publish_folder(lake, folder, fx.MODEL, fx.PROJECT, "one")
    return lake.read("vectors").select("id", "metadata.project", "metadata.chunk_size")


@query
def clear_vectors(spark, d):
    lake = Lake(spark, scratch_path(spark, "lake"), hex_digits=1)
    jobs.publish_vectors(lake, checkpointed(_documents(spark, d)), fx.PROJECT, "one")
    cleared = jobs.clear_vectors(lake, fx.MODEL, "two")
    left = lake.read("vectors").agg(F.count("*").alias("n"))
    return cleared.withColumn("left", left.scalar())
