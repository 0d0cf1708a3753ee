"""Nothing is lost or doubled: change sets, fetches, buckets, batches, indexes, costly functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from corpuslake.catalog import fixtures as fx
from corpuslake.functions.embedding import HashingEmbedder
from corpuslake.operators import bm25, changes, documents, enrich
from corpuslake.plans import jobs
from corpuslake.sources import readers, writers
from corpuslake.sources.lake import Lake
from corpuslake.streaming.feed import start_change_feed
from tests.test_jobs import SETTINGS, content, make

SF_DIR = "/root/testdata/sf0.001"


def test_change_sets_of_many_documents_and_times(spark, tmp_path):
    feed = spark.range(70_000).select(
        F.lit("added").alias("change_type"),
        F.md5(F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("https://h/"), "id").alias("url"),
        F.lit(date(2024, 1, 2)).alias("last_updated"),
        (F.lit("2024-03-01 00:00:00").cast("timestamp") + F.make_dt_interval((F.col("id") % 3).cast("int"))).alias("change_ts"),
    )
    for name, per_document in (("large", 50_000), ("small", 1_000)):
        path = str(tmp_path / name)
        assert writers.write_change_sets(feed.coalesce(1), path, per_document) == 70_000
        back = changes.from_change_sets(readers.read_change_sets(spark, path))
        assert back.select("id", "change_ts").distinct().count() == back.count() == 70_000


def test_repeated_and_missing_ids_are_kept(spark, tmp_path):
    ids = [("a", 1), ("a", 2), ("a", 1), ("b", 1), (None, 1), (None, 2)]
    rows = [(kind, i, f"u{i}", date(2024, 1, day)) for kind in ("removed", "added") for i, day in ids]
    feed = spark.createDataFrame(rows, "change_type string, id string, url string, last_updated date")
    feed = changes.stamped(feed, "2024-03-01 00:00:00")
    pages = feed.select("id", "url", "last_updated")
    for per_document in (50_000, 2):
        path = str(tmp_path / f"changes-{per_document}")
        assert writers.write_change_sets(feed, path, per_document) == len(rows)
        back = changes.from_change_sets(readers.read_change_sets(spark, path))
        assert sorted(map(str, back.collect())) == sorted(map(str, feed.collect()))
        maps = changes.from_keyed_maps(changes.to_keyed_maps(pages, 50_000 // per_document))
        assert sorted(map(str, maps.collect())) == sorted(map(str, pages.collect()))


def test_stream_reads_every_document_of_a_feed(spark, tmp_path):
    old, crawl = make(spark, {0: 1, 1: 1})
    new, new_crawl = make(spark, {n: 1 for n in range(30)})
    later = F.make_dt_interval((F.length("url") % 2 + F.ascii(F.reverse("url")) % 2).cast("int"))
    feed = changes.changes(old, new, "2024-02-01 00:00:00").withColumn("change_ts", F.col("change_ts") + later)
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    jobs.initial_load(lake, old, crawl, SETTINGS, batch_id="b0")
    writers.write_change_sets(feed, str(tmp_path / "in"), per_document=5)
    start_change_feed(spark, str(tmp_path / "in"), str(tmp_path / "cp"), lake, new_crawl, SETTINGS).awaitTermination()
    assert lake.read("pages").count() == 30


def test_one_page_per_url(spark):
    pages, crawl = make(spark, {n: 1 for n in range(6)})
    old = crawl.select("url", F.lit("<h2>old</h2>").alias("html"))
    none = crawl.select("url", F.lit(None).cast("string").alias("html"))
    timed = crawl.withColumn("fetched_at", F.lit(5)).unionByName(old.withColumn("fetched_at", F.lit(4)))
    for repeated in (crawl.union(crawl).union(none), timed.union(timed)):
        found = enrich.lookup_html(pages, repeated)
        assert found.count() == 6
        assert found.join(crawl, "url").where("html_content = html").count() == 6
    assert enrich.lookup_html(pages, none).where("html_content is null").count() == 6
    assert enrich.lookup_html(pages, none, drop_missing=True).count() == 0


def test_a_lake_keeps_its_bucket_width(spark, tmp_path):
    root = str(tmp_path / "lake")
    pages, crawl = make(spark, {n: 1 for n in range(12)})
    jobs.initial_load(Lake(spark, root, hex_digits=2), pages, crawl, SETTINGS, batch_id="b0")
    other = Lake(spark, root, hex_digits=1)
    assert other.hex_digits == 2
    gone, _ = make(spark, {})
    jobs.apply_changes(other, changes.changes(pages, gone), crawl, SETTINGS, batch_id="b1")
    assert content(other, "pages") == content(other, "vectors") == []


def test_batches_are_named(spark, tmp_path):
    with pytest.raises(TypeError):
        jobs.apply_changes(None, None, None)
    with pytest.raises(TypeError):
        jobs.initial_load(None, None, None)


def test_parser_and_model_run_once_per_row(spark):
    settings = jobs.Settings(load_model=lambda: HashingEmbedder(8))

    def python_nodes(frame, name):
        return frame._jdf.queryExecution().optimizedPlan().toString().count(f"ArrowEvalPython [{name}")

    enriched = enrich.enrich_pages(fx.page_list(spark, SF_DIR), fx.crawl(spark, SF_DIR), fx.TITLES, fx.BODIES)
    assert python_nodes(enriched, "extract") == 1
    chunk = fx.corpus(spark, SF_DIR).select(F.col("id").alias("unique_id"), F.col("extracted_content").alias("text"))
    embedded = documents.embed_chunks(chunk, settings.load_model)
    records = documents.upload_records(documents.generate_documents(embedded, "t", 1), "p")
    for frame in (embedded, records):
        assert python_nodes(frame, "embed") == 1


def test_postings_are_unfolded_and_counted_once(spark):
    corpus = fx.corpus(spark, SF_DIR)
    terms, params = bm25.build_bm25(corpus, "extracted_content", "doc_id")
    rows = corpus.select(F.col("id").alias("unique_id"), F.col("extracted_content").alias("text"))
    found = bm25.sparse_weights(rows, terms, params)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    # The form of the lookup changes no row: no term frequent, some, all.
    outcomes = {
        tuple(sorted((r.unique_id, r.term_idx, round(r.score, 9)) for r in bm25.sparse_weights(rows, terms, params, hot_terms=n).collect()))
        for n in (0, 200, 10**9)
    }
    assert len(outcomes) == 1


def test_found_postings_stay_with_their_chunk(spark):
    words = [("b", "x y x"), ("a", "x x z w"), ("a", "x x z w"), (None, "x y"), ("c", None), ("d", "w w q")]
    rows = spark.createDataFrame([(k, t, n) for n, (k, t) in enumerate(words)], "unique_id string, text string, n int")
    terms = spark.createDataFrame(
        [("w", 3, 1, 2.0), ("x", 0, 3, 0.5), ("y", 1, 2, 1.0), ("z", 2, 1, 2.0)], "term string, term_idx long, df long, idf double"
    )
    plain = bm25.sparse_weights(rows, terms, None).collect()
    expected = {}
    for r in plain:
        expected.setdefault(r.unique_id, {})[r.term_idx] = pytest.approx(r.score)
    for hot_terms in (0, 3, 10**9):
        for place in (None, [F.substring("unique_id", 1, 1), F.pmod(F.xxhash64("unique_id"), F.lit(2))]):
            found = bm25.add_sparse_vectors(rows, terms, None, hot_terms=hot_terms, place=place)
            assert found.columns == ["unique_id", "text", "n", "bm25_sparse_vector"]
            got = found.collect()
            assert sorted(r.n for r in got) == list(range(6))
            assert all(r.bm25_sparse_vector == (expected.get(r.unique_id, {}) if r.unique_id else {}) for r in got)
    # Nothing but the bounded table of frequent terms is joined to whole chunks.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line or "Join LeftAnti" in line]
    assert joins and all("strategy=broadcast" in line for line in joins)


def test_no_task_makes_more_documents_than_its_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "MOST_CHUNKS", 50)
    rows = spark.range(4000).select(
        F.concat(F.md5(F.col("id").cast("string")), F.lit("_1")).alias("unique_id"), F.concat(F.lit("x w"), "id").alias("text")
    )
    terms = spark.range(4000).select(
        F.concat(F.lit("w"), "id").alias("term"), F.col("id").alias("term_idx"), F.lit(1).cast("long").alias("df"), F.lit(2.0).alias("idf")
    )
    for hex_digits, most_buckets in ((1, 2), (2, 6)):
        lake = Lake(spark, str(tmp_path / f"lake{hex_digits}"), hex_digits=hex_digits)
        parts = jobs._parts(lake, 4000)
        assert parts == 80 and jobs._parts(lake, 3) == 1
        found = bm25.add_sparse_vectors(rows, terms, None, place=[lake.place_of(F.col("unique_id"), parts)], parts=parts)
        sizes = found.where(F.size("bm25_sparse_vector") == 1).groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.count_distinct(lake.bucket_of(F.col("unique_id"))).alias("buckets")
        ).collect()
        assert len(sizes) == 80 and sum(r.n for r in sizes) == 4000 and max(r.n for r in sizes) < 110
        assert max(r.buckets for r in sizes) <= most_buckets
    nowhere = spark.createDataFrame([(None,), ("",), ("?_1",)], "key string").select(lake.place_of(F.col("key"), 3).alias("n"))
    assert all(0 <= r.n < 3 for r in nowhere.collect())


def test_known_vectors_are_found_while_chunks_are_narrow(spark):
    chunk = spark.createDataFrame([("p_1", "one two", 16), ("p_2", "three", 16), ("q_1", None, 16)], "unique_id string, text string, chunk_size int")
    marked = chunk.withColumn("mark", documents.text_mark("m"))
    known = marked.where("unique_id = 'p_1'").select("mark", F.array(F.lit(5.0).cast("float")).alias("values"))
    matched = documents.with_known_vectors(chunk, known.union(known), "m")
    assert {r.unique_id: r._held for r in matched.collect()} == {"p_1": [5.0], "p_2": None, "q_1": None}
    found = documents.embed_unknown(matched, lambda: HashingEmbedder(1))
    assert {r.unique_id: list(map(abs, r.embedding)) for r in found.collect()} == {"p_1": [5.0], "p_2": [1.0]}


def test_terms_are_named_once_per_pair(spark):
    terms = spark.createDataFrame([("often", 7, 90, 0.1), ("once", 8, 1, 3.0)], "term string, term_idx long, df long, idf double")
    pairs = spark.createDataFrame([("a", 7), ("a", 8), ("b", 7), ("b", 9), ("b", 7)], "id string, indices int")
    for hot_terms in (0, 2, 10**9):
        named = bm25.name_terms(pairs, terms, hot_terms=hot_terms).select("id", "term").collect()
        assert sorted(map(tuple, named)) == [("a", "often"), ("a", "once"), ("b", "often"), ("b", "often")]


def test_a_crawl_is_shuffled_once(spark):
    pages, crawl = make(spark, {n: 1 for n in range(6)})
    found = enrich.lookup_html(pages, crawl.union(crawl))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert found.count() == 6


class Dead:
    def embed_documents(self, texts):
        raise RuntimeError("no model")


def test_a_dead_model_fails_the_run(spark, tmp_path):
    pages, crawl = make(spark, {n: 1 for n in range(4)})
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    with pytest.raises(RuntimeError, match="no vector"):
        jobs.initial_load(lake, pages, crawl, jobs.Settings(load_model=Dead), batch_id="b0")
    assert not lake.applied("b0")


def test_indexes_stay_side_by_side_and_the_last_wins(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    pages, crawl = make(spark, {n: 1 for n in range(3)})
    jobs.initial_load(lake, pages, crawl, SETTINGS, batch_id="b0")
    docs = lake.read("documents").cache()
    other = docs.withColumn("metadata", F.col("metadata").withField("chunk_size", F.lit(64)))
    n = docs.count()
    jobs.publish_vectors(lake, other, "p", "b1")
    assert lake.read("vectors").count() == 2 * n
    later = other.withColumn("metadata", F.col("metadata").withField("date", F.date_add("metadata.date", 9)))
    jobs.publish_vectors(lake, later.union(other).union(later), "q", "b2")
    found = lake.read("vectors").groupBy("metadata.chunk_size", "metadata.project").count().collect()
    assert sorted((r.chunk_size, r.project, r["count"]) for r in found) == [(64, "q", n), (256, "p", n)]
    newest = lake.read("vectors").where("metadata.chunk_size = 64").agg(F.max("metadata.date"), F.min("metadata.date")).first()
    assert newest[0] == newest[1]


def test_rows_meet_once_on_their_way_to_a_bucket(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    pages, crawl = make(spark, {n: 1 for n in range(3)})
    jobs.initial_load(lake, pages, crawl, SETTINGS, batch_id="b0")
    plan = lambda: lake.read("vectors")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan()
    docs, n = lake.read("documents"), lake.read("documents").count()
    later = docs.withColumn("metadata", F.col("metadata").withField("date", F.date_add("metadata.date", 9)))
    jobs.publish_vectors(lake, docs.union(later).union(later), "p", "b1", settled=True)
    assert "Join" in plan()
    found = lake.read("vectors").select("id", "metadata.project", "metadata.date")
    expected = later.select(F.col("unique_id").alias("id"), F.lit("p").alias("project"), "metadata.date")
    assert found.count() == n and found.exceptAll(expected).isEmpty()


def test_wide_results_are_stored_compressed(spark, tmp_path):
    corpus = fx.corpus(spark, SF_DIR)
    terms, _ = bm25.build_bm25(corpus, "extracted_content", "doc_id")
    assert all(".parquet" in name for name in terms.inputFiles()) and terms.inputFiles()
    docs = documents.generate_documents(fx.embedded_rows(spark, SF_DIR), "t", 1)
    folder = writers.write_collection(docs, str(tmp_path), "m", 1)
    assert readers.path_exists(spark, f"{folder}/*.json.gz") and not readers.path_exists(spark, f"{folder}/*.json")
    assert readers.read_collections(spark, str(tmp_path), "m").count() == docs.count()


def test_an_update_sums_the_terms_once_and_keeps_old_values_of_added_pages(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    pages, crawl = make(spark, {n: 1 for n in range(4)})
    jobs.initial_load(lake, pages, crawl, SETTINGS, batch_id="b0")
    _, newer = make(spark, {n: 2 for n in range(5)})
    listed, _ = make(spark, {n: 2 for n in (1, 4)})
    feed = changes.stamped(
        listed.select(F.lit("added").alias("change_type"), "id", "url", F.when(F.col("url").endswith("4"), F.col("last_updated")).alias("last_updated")),
        "2024-03-01 00:00:00",
    )
    summed = []
    real = bm25.summed_terms
    monkeypatch.setattr(bm25, "summed_terms", lambda deltas: summed.append(1) or real(deltas))
    jobs.apply_changes(lake, feed, newer, SETTINGS, batch_id="b1")
    assert len(summed) == 1
    found = {r.url[-1]: r for r in lake.read("pages").collect()}
    assert sorted(found) == list("01234")
    before = {r.url[-1]: r for r in crawl.collect()}
    after = {r.url[-1]: r for r in newer.collect()}
    assert [found[n].html_content == after[n].html for n in "01234"] == [False, True, False, False, True]
    assert found["0"].html_content == before["0"].html
    # The page that came again without a date keeps the one it had.
    assert [found[n].last_updated for n in "14"] == [date(2024, 1, 2), date(2024, 1, 3)]


def test_a_join_with_a_table_never_written_moves_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), hex_digits=1)
    deltas = spark.createDataFrame([("a", 1, 5, 0, None)], "term string, df long, first_doc long, first_pos int, n_tokens long")
    absent = readers.read_or_empty(spark, str(tmp_path / "none"), lake.read("bm25_terms").schema)
    assert absent.schema == lake.read("bm25_terms").schema and absent.count() == 0
    joined = deltas.join(lake.read("bm25_terms").select("term", F.lit(True).alias("held")), "term", "left")
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in bm25.with_new_ids(deltas, lake.read("bm25_terms")).collect()] == [("a", 0, 1)]
