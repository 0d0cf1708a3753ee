"""The jobs users run, composed from the operators.

Expensive results (extracted pages, chunks, documents) are written once and
read back, so no plan runs the HTML parser, the splitter or the model twice.
"""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake import schemas
from corpuslake.functions.embedding import HashingEmbedder
from corpuslake.operators import bm25, changes, chunks, documents, enrich, merge, reports, sitemap
from corpuslake.operators.common import single
from corpuslake.sources import readers, snapshots, writers
from corpuslake.sources.lake import TABLES, Lake
from corpuslake.sources.scratch import checkpointed, scratch_path, stored, together


# Chunks of one task that makes documents.  It sorts their postings, so this bounds its memory.
MOST_CHUNKS, LEAST_CHUNKS = 16_384, 1_024


@dataclass(frozen=True)
class Settings:
    """What a corpus is made with."""

    titles: tuple = C.TITLE_SELECTORS
    bodies: tuple = C.BODY_SELECTORS
    chunk_sizes: tuple = (C.CHUNK_SIZE,)
    doc_type: str = C.DOC_TYPE
    model: str = "hashing-384"
    load_model: Callable[[], object] = field(default=HashingEmbedder)
    project: str = "default"
    most_failed: float = 0.1  # a run fails if the model gives no vector for a larger share of the chunks
    k1: float = C.BM25_K1
    b: float = C.BM25_B
    epsilon: float = C.BM25_EPSILON


# -- sitemaps ------------------------------------------------------------------


def take_snapshot(
    texts: DataFrame, base_url: str, path: str, snapshot_id: int, bucketed: bool = False, **filters
) -> DataFrame:
    """Processes sitemap texts into a new snapshot; returns the funnel counts.

    ``bucketed`` stores it with digests, for ``diff_stored_snapshots``.
    """
    write = snapshots.write_snapshot if bucketed else writers.append_snapshot
    write(sitemap.process_sitemap(texts, base_url, **filters), path, snapshot_id)
    named = {k: v for k, v in filters.items() if k not in ("order", "on_bad_date")}
    return sitemap.sitemap_funnel(texts, base_url, **named)


def _publish_changes(difference: DataFrame, change_path: str, change_ts, unchanged: int = 0) -> DataFrame:
    """Writes change sets and counts in one evaluation of the difference; one report row.

    The counts are taken where the feed is written.  ``unchanged`` rows were not compared.
    """
    spark = difference.sparkSession
    kinds = (*changes.CHANGE_TYPES, "unchanged")
    seen = Observation()
    watched = difference.observe(seen, *[F.count_if(F.col("change_type") == kind).alias(kind) for kind in kinds])
    feed_path = scratch_path(spark, "feed")
    changes.stamped(watched.where("change_type <> 'unchanged'"), change_ts).write.parquet(feed_path)
    written = writers.write_change_sets(spark.read.schema(schemas.CHANGES).parquet(feed_path), change_path)
    n = seen.get
    same = n["unchanged"] + unchanged
    before, after = (n["removed"] + n["modified"] + same, n["added"] + n["modified"] + same)
    numbers = {kind: n[kind] for kind in changes.CHANGE_TYPES}
    numbers |= {"total_before": before, "total_after": after, "net_change": after - before}
    counts = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in numbers.items()])
    detected = written > 0
    text = reports.change_message(path=change_path) if detected else F.lit("no changes detected")
    return counts.withColumn("changes_detected", F.lit(detected)).withColumn("message", text)


def diff_snapshots(snapshot_rows: DataFrame, change_path: str, change_ts=None) -> DataFrame:
    """Compares the two newest snapshots; one report row.

    Change-set documents are written only if something changed.  With fewer
    than two snapshots there is nothing to compare and nothing is written.
    """
    old = changes.version_by_age(snapshot_rows, 1)
    new = changes.version_by_age(snapshot_rows, 0)
    difference = changes.diff(new, new) if old.isEmpty() else changes.diff(old, new)
    return _publish_changes(difference, change_path, change_ts)


def diff_stored_snapshots(spark: SparkSession, path: str, change_path: str, change_ts=None) -> DataFrame:
    """``diff_snapshots`` of bucketed snapshots: buckets with equal digests are not read."""
    marks = snapshots.digests(spark, path)
    sizes = marks.groupBy("snapshot_id").agg(F.sum("rows").alias("rows")).orderBy(F.desc("snapshot_id")).limit(2)
    newest = sizes.collect()
    new, old = newest[0]["snapshot_id"], newest[-1]["snapshot_id"]
    of = [marks.where(F.col("snapshot_id") == n) for n in (old, new)]
    equal = of[1].join(snapshots.changed_buckets(*of), "bucket", "left_anti").agg(F.sum("rows")).first()[0]
    return _publish_changes(snapshots.diff_changed_buckets(spark, path, old, new), change_path, change_ts, equal or 0)


# -- corpus building blocks ------------------------------------------------------


def doc_order(pages: DataFrame) -> DataFrame:
    """Adds ``doc_order``, an integer that sorts like the md5 id."""
    return pages.withColumn("doc_order", F.conv(F.substring("id", 1, 15), 16, 10).cast("long"))


def stored_bm25(lake: Lake):
    """(terms ``term, term_idx, df, idf``; params) of the last refresh; both empty if there was none.

    The terms are summed up and stored once, as whoever looks words up reads them several times.
    """
    params = _one_row(lake.read("bm25_params"))
    until = F.col("batch") <= single(params, "as_of")
    terms = stored(bm25.summed_terms(lake.placed("bm25_terms").where(until)))
    return bm25.add_idf(terms, params), params.select(*schemas.BM25_PARAMS.fieldNames())


def _one_row(params: DataFrame) -> DataFrame:
    """The one row of parameters, brought here, so that no expression that needs one starts a job."""
    return params.sparkSession.createDataFrame(params.collect(), params.schema)


def append_deltas(lake: Lake, added: DataFrame, removed: DataFrame) -> None:
    """Appends what a batch changes in the statistics.

    The changes are kept for every batch, so a later refresh needs no page that did not change.
    """
    deltas = stored(bm25.term_deltas(doc_order(added), doc_order(removed), "extracted_content", "doc_order"))
    sizes = deltas.where(F.col("term").isNull()).select(F.col("df").alias("n_docs"), "n_tokens")
    together(
        lake.spark,
        lambda: lake.append("bm25_terms", bm25.with_new_ids(deltas, lake.read("bm25_terms"))),
        lambda: lake.append("bm25_sizes", sizes),
    )


def track_bm25(lake: Lake, added: DataFrame, removed: DataFrame, settings: Settings, refresh: bool):
    """Appends what a batch changes in the statistics; returns (terms, params) to weigh its chunks with.

    Weights come from the last refresh, which may be this batch's own.
    """
    append_deltas(lake, added, removed)
    if not refresh:
        return stored_bm25(lake)
    every = lake.read("bm25_terms").unionByName(lake.appended("bm25_terms"))
    terms = stored(bm25.summed_terms(every))
    all_sizes = lake.read("bm25_sizes").unionByName(lake.appended("bm25_sizes"))
    params = bm25.params_of(terms, all_sizes, settings.k1, settings.b, settings.epsilon)
    lake.append("bm25_params", params.withColumn("as_of", F.lit(lake.next_batch)))
    params = _one_row(lake.appended("bm25_params")).select(*schemas.BM25_PARAMS.fieldNames())
    return bm25.add_idf(terms, params), params


def build_documents(
    chunk_rows: DataFrame, terms: DataFrame, params: DataFrame, settings: Settings, known: DataFrame | None = None,
    place: list | None = None, parts: int | None = None,
):
    """Chunks -> documents with sparse and dense vectors, and the mark of what each vector was made from.

    ``known`` (``mark, values``) has vectors that need not be made again; they are found while
    the chunks are narrow.  Documents lie by ``place``, columns that chunk id and size determine,
    and with ``parts`` in so many tasks.
    """
    if known is not None:
        chunk_rows = stored(documents.with_known_vectors(chunk_rows, known, settings.model))
    size = F.col("chunk_size").cast("string")
    weighted = bm25.add_sparse_vectors(
        chunk_rows.withColumn("_key", F.concat_ws("|", "unique_id", size)), terms, params, key="_key", place=place, parts=parts
    ).drop("_key")
    if known is None:
        embedded = documents.embed_chunks(weighted, settings.load_model)
        embedded = embedded.withColumn("mark", documents.text_mark(settings.model))
    else:
        embedded = documents.embed_unknown(weighted, settings.load_model)
    made = documents.generate_documents(embedded, settings.doc_type, keep=("mark",))
    return made


def _embedded_enough(asked: int, given: int, settings: Settings) -> None:
    """Raises where a model that fails would leave the corpus (almost) empty; the counts come from the writes."""
    if given < (1 - settings.most_failed) * asked:
        raise RuntimeError(f"the model gave no vector for {asked - given} of {asked} chunks")


def _parts(lake: Lake, asked: int) -> int:
    """Tasks that make the documents of so many chunks: none gets many more than MOST_CHUNKS, whatever the corpus.

    Small batches are dealt to the usual partitions, but not to more than give each LEAST_CHUNKS.
    """
    usual = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-asked // MOST_CHUNKS), min(usual, -(-asked // LEAST_CHUNKS)))


def _append_documents(lake: Lake, asked: int, terms, params, settings: Settings, known=None) -> int:
    """Appends documents of the appended chunks; returns their number."""
    parts = _parts(lake, asked)
    place = [lake.place_of(F.col("unique_id"), parts)]
    made = build_documents(lake.appended("chunks"), terms, params, settings, known, place, parts)
    given = lake.append("documents", made, placed=True)
    _embedded_enough(asked, given, settings)
    return given


def _append_vectors(lake: Lake, settings: Settings) -> int:
    return lake.append("vectors", documents.upload_records(lake.appended("documents"), settings.project), placed=True)


def _append_ids(lake: Lake) -> int:
    return lake.append("registry", merge.distinct_ids(lake.appended("documents")))


# -- initial load ----------------------------------------------------------------


def initial_load(
    lake: Lake,
    page_list: DataFrame,
    crawl: DataFrame,
    settings: Settings = Settings(),
    *,
    batch_id: str,
) -> int | None:
    """Page list and crawl snapshot to all corpus tables, in one commit; the number of documents.

    Statistics are made unless the lake has some.  A batch that was applied before does nothing.
    """
    if not lake.begin(batch_id):
        return None
    before = lake.read("pages")
    first = lake.read("bm25_params").isEmpty()
    enriched = enrich.enrich_pages(page_list, crawl, settings.titles, settings.bodies)
    lake.append("pages", enriched)
    pages = lake.appended("pages")
    (terms, params), asked = together(
        lake.spark,
        lambda: track_bm25(lake, pages, before, settings, refresh=first),
        lambda: lake.append("chunks", chunks.chunk_pages(pages, settings.chunk_sizes), placed=True),
    )
    made = _append_documents(lake, asked, terms, params, settings)
    together(lake.spark, lambda: _append_vectors(lake, settings), lambda: _append_ids(lake))
    replaced = ["pages", "chunks", "documents", "registry", "vectors", "changes"]
    lake.commit(batch_id, replaced + (["bm25_params"] if first else []))
    return made


# -- incremental update ------------------------------------------------------------


def effective_changes(lake: Lake, latest: DataFrame, near) -> DataFrame:
    """Changes (the newest per page) without those that are not newer than what was applied before.

    Change sets may so come in any order and repeatedly: the state remembers the newest change
    of every page, also of removed ones.  An addition whose page the crawl did not have left
    the older state in place, so it does not keep an older change from taking effect; it then
    stays what is known, as ``newer``.
    """
    known = lake.read("changes", near).select(
        "id",
        changes.change_order().alias("_known"),
        (F.col("built") | (F.col("change_type") != "added")).alias("_done"),
        F.struct("change_type", "change_ts", "last_updated").alias("_state"),
    )
    joined = latest.join(known, "id", "left")
    late = F.coalesce(changes.change_order() <= F.col("_known"), F.lit(False))
    return joined.where(~(late & F.col("_done"))).withColumn("newer", F.when(late, F.col("_state"))).drop("_known", "_done", "_state")


def _removals(table: str, rows: DataFrame, counted) -> DataFrame:
    return rows.select(F.lit(table).alias("table"), "key", counted.alias("counted"))


def _replaced(table: str, rows: DataFrame) -> DataFrame:
    """Keys of rows that a batch appends: older rows with such a key give way, whether there are any or not."""
    return _removals(table, rows.select(TABLES[table].key_column().alias("key")), F.lit(False))


def apply_changes(
    lake: Lake,
    feed: DataFrame,
    crawl: DataFrame,
    settings: Settings = Settings(),
    *,
    batch_id: str,
    refresh_bm25: bool = False,
) -> DataFrame | None:
    """Applies a change feed to every table in one commit; returns the run report.

    Older rows are read only in buckets that hold a changed page, and none is written
    again.  A batch that was applied before, or that holds nothing new, changes nothing and
    returns None.  ``refresh_bm25`` makes new statistics over all pages from the changes.
    """
    if not lake.begin(batch_id):
        return None
    newest = checkpointed(changes.latest_changes(feed))
    if newest.isEmpty():
        return None
    near = lake.near(newest)
    latest = checkpointed(effective_changes(lake, newest, near))
    if latest.isEmpty():
        return None
    gone = changes.ids_to_delete(latest)

    # Pages: a page that was only added keeps old values where new ones are null.
    fresh = enrich.enrich_pages(
        changes.pages_to_fetch(latest), crawl, settings.titles, settings.bodies, drop_null=True
    )
    # Html is joined only for the few added pages that the table holds already.
    whole = lake.placed("pages", near)
    narrow = whole.select("id", "key", "extracted_content", F.col("html_content").isNull().alias("no_html"))
    old = narrow.join(latest.select("id", "change_type"), "id")
    old = checkpointed(old.withColumn("gone", F.col("change_type").isin("removed", "modified")))
    present = stored(old.where("not gone").select("id"))
    lake.append("pages", merge.update_keep_values(fresh, whole.join(present, "id", "left_semi")))
    pages = lake.appended("pages")
    renewed = old.where("not gone").join(pages.select("id"), "id", "left_semi")
    # Completeness is a rule for the whole page table; row-group null counts keep this scan small.
    unfinished = lake.placed("pages").where(
        F.col("html_content").isNull() | F.col("extracted_content").isNull()
    ).join(old.select("id"), "id", "left_anti")
    kept_open = old.where("not gone and (no_html or extracted_content is null)")
    kept_open = kept_open.join(pages.select("id"), "id", "left_anti")
    lost = [(old.where("gone"), True), (renewed, False), (unfinished, False), (kept_open, False)]
    no_longer = checkpointed(
        reduce(
            DataFrame.unionByName,
            [rows.select("id", "extracted_content", "key", F.lit(n).alias("counted")) for rows, n in lost],
        )
    )

    # Everything derived from pages that are gone; the registry says which chunks they had.
    def derived():
        ids = checkpointed(merge.chunk_ids_of(gone, lake.placed("registry", near)))
        chunk_ids = ids.select("unique_id")
        docs = lake.placed("documents", near).join(chunk_ids, "unique_id", "left_semi")
        vectors = lake.placed("vectors", near).join(chunk_ids.withColumnRenamed("unique_id", "id"), "id", "left_semi")
        old_chunks = lake.placed("chunks", near).join(chunk_ids, "unique_id", "left_semi")
        return ids, checkpointed(docs.select("key", "mark", "values")), vectors, old_chunks

    (ids, docs, vectors, old_chunks), asked, statistics = together(
        lake.spark,
        derived,
        lambda: lake.append("chunks", chunks.chunk_pages(pages, settings.chunk_sizes), placed=True),
        lambda: track_bm25(lake, pages, no_longer, settings, True) if refresh_bm25 else stored_bm25(lake),
    )
    yes = F.lit(True)
    gone_keys = [
        _removals("pages", no_longer, F.col("counted")),
        _removals("registry", ids, yes),
        _removals("documents", docs, yes),
        _removals("vectors", vectors, yes),
        _removals("chunks", old_chunks, yes),
        _removals("changes", latest.select(F.col("id").alias("key")), F.lit(False)),
        _replaced("chunks", lake.appended("chunks")),
    ]
    stated = latest.join(pages.select("id", F.lit(True).alias("built")), "id", "left")
    known = {c: F.coalesce(F.col(f"newer.{c}"), F.col(c)) for c in ("change_type", "change_ts", "last_updated")}
    stated = stated.withColumns(known | {"built": F.coalesce("built", F.lit(False))})
    made, deleted, *_ = together(
        lake.spark,
        lambda: _append_documents(lake, asked, *statistics, settings, docs.select("mark", "values")),
        lambda: lake.remove(reduce(DataFrame.unionByName, gone_keys)),
        lambda: lake.append("changes", stated),
        lambda: None if refresh_bm25 else append_deltas(lake, pages, no_longer),
    )
    new_docs = lake.appended("documents")
    new_keys = [
        _replaced("documents", new_docs),
        _replaced("vectors", new_docs.withColumnRenamed("unique_id", "id")),
        _replaced("registry", new_docs),
    ]
    together(
        lake.spark,
        lambda: lake.remove(reduce(DataFrame.unionByName, new_keys)),
        lambda: _append_vectors(lake, settings),
        lambda: _append_ids(lake),
    )
    report = checkpointed(run_report(latest, deleted, made, batch_id))
    lake.commit(batch_id, ["bm25_params"] if refresh_bm25 else [])
    report.write.mode("overwrite").parquet(f"{lake.root}/run_stats/run={batch_id_path(batch_id)}")
    return report


def batch_id_path(batch_id: str) -> str:
    """A batch id as one short path component."""
    plain = "".join(ch if ch.isalnum() or ch in "-_." else "-" for ch in batch_id)
    return f"{plain[-60:]}-{hashlib.md5(batch_id.encode('utf-8')).hexdigest()[:12]}"


def run_report(feed: DataFrame, deleted: dict, updated: int, batch_id: str) -> DataFrame:
    """One row: deletion counts and update count (both taken by the writes), change counts, message."""
    by_type = feed.agg(
        *[F.count_if(F.col("change_type") == kind).alias(kind) for kind in changes.CHANGE_TYPES]
    )
    numbers = {
        "deleted_vectors": deleted["vectors"],
        "deleted_documents": deleted["documents"],
        "removed_pages": deleted["pages"],
        "removed_unique_ids": deleted["registry"],
        "updated_items": updated,
    }
    row = by_type.select(*[F.lit(n).cast("long").alias(name) for name, n in numbers.items()], *changes.CHANGE_TYPES)
    return row.withColumn("message", reports.update_message()).withColumn("batch_id", F.lit(batch_id))


# -- publishing ----------------------------------------------------------------------


def _append_last(lake: Lake, records: DataFrame) -> None:
    """Appends one record per index and id."""
    lake.append("vectors", records, one_of=(F.col("id"), merge.index_of()), latest=merge.vector_rank())


def _register(lake: Lake, ids: DataFrame) -> None:
    lake.append("registry", ids.select("unique_id").distinct())


def publish_vectors(
    lake: Lake, docs: DataFrame, project: str, batch_id: str, settled: bool = False
) -> DataFrame | None:
    """Upserts documents into the vector table and registers their ids.

    The table itself is not read: records are appended, and their keys end older ones.
    The documents are read three times, so they are stored first unless they are
    ``settled``: files as they lie, cheap to read and the same each time.
    """
    if not lake.begin(batch_id):
        return None
    docs = docs if settled else stored(docs)
    updated = docs.count()
    if not updated:
        return None
    _append_last(lake, documents.upload_records(docs, project))
    _register(lake, docs)
    keys = [_replaced(table, lake.appended(table)) for table in ("vectors", "registry")]
    lake.remove(reduce(DataFrame.unionByName, keys))
    lake.commit(batch_id)
    ids = lake.read("registry").agg(F.count("*").alias("unique_ids"))
    return ids.select(F.lit(updated).cast("long").alias("updated_items"), "unique_ids")


def publish_new_vectors(
    lake: Lake, docs: DataFrame, chunk_size: int, doc_type: str, batch_id: str, settled: bool = False
) -> DataFrame | None:
    """Adds only documents the vector table does not hold; existing ones stay as they are.

    A document that comes repeatedly is added once.  All ids are registered, so that a later
    delete of their pages finds them.
    """
    if not lake.begin(batch_id):
        return None
    docs = docs if settled else stored(docs)
    held = lake.read("vectors", lake.near(docs, "unique_id"))
    asked = F.struct(F.lit(doc_type), F.size("values"), F.lit(chunk_size))
    fresh = merge.new_vectors_only(docs, held, asked)
    reduced = documents.reduced_records(fresh, chunk_size, doc_type)
    metadata = F.struct(
        *[
            (F.col(f"metadata.{f.name}") if f.name in ("text", "general_id", "chunk_size", "doc_type") else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schemas.VECTORS["metadata"].dataType.fields
        ]
    )
    no_sparse = F.lit(None).cast(schemas.SPARSE_PAIR).alias("sparse_values")
    rows = reduced.select("id", "values", no_sparse, metadata.alias("metadata"))
    _append_last(lake, rows)
    _register(lake, docs)
    lake.remove(_replaced("registry", lake.appended("registry")))
    lake.commit(batch_id)
    return lake.read("vectors").agg(F.count("*").alias("vectors"))


def publish_folder(lake: Lake, folder: str, model: str, project: str, batch_id: str):
    """Publishes every stored collection of a model; names give type and chunk size."""
    found = documents.with_name_columns(readers.read_collections(lake.spark, folder, model))
    stamped = found.withColumn(
        "metadata",
        F.col("metadata").withField("chunk_size", F.col("chunk_size")),
    )
    return publish_vectors(lake, stamped.select(*schemas.DOCUMENTS.fieldNames()), project, batch_id, settled=True)


def clear_vectors(lake: Lake, model: str, batch_id: str) -> DataFrame | None:
    """Empties the vector table; returns the counts it held by index."""
    if not lake.begin(batch_id):
        return None
    held = checkpointed(documents.index_stats(lake.read("vectors"), model))
    lake.commit(batch_id, ["vectors"])
    return held
