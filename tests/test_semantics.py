"""Small hand-made cases for rules that are easy to get wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from corpuslake.functions import vectors as V
from corpuslake.functions.text import collapse_whitespace, local_date, tokens
from corpuslake.operators import bm25, changes, chunks, documents, enrich, merge, sitemap
from corpuslake.sources import readers, writers


def values(df, column):
    return [r[column] for r in df.collect()]


def stamps(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "lastmod string")


def test_date_is_local_to_its_offset(spark):
    df = stamps(spark, "2024-03-01T00:30:00+02:00", "2024-03-01T23:30:00-0500", "2024-02-29T10:00:00Z")
    got = values(df.select(local_date("lastmod").alias("d")), "d")
    assert got == [date(2024, 3, 1), date(2024, 3, 1), date(2024, 2, 29)]


@pytest.mark.parametrize(
    "bad", ["2024-03-01", "2024-02-30T00:00:00Z", "2024-13-01T00:00:00Z", "2024-03-01T25:00:00Z", "", "2024-03-01T00:00:00"]
)
def test_bad_dates(spark, bad):
    df = stamps(spark, bad)
    assert values(df.select(local_date("lastmod", "null").alias("d")), "d") == [None]
    with pytest.raises(Exception, match="not a timestamp"):
        df.select(local_date("lastmod").alias("d")).collect()


def test_bad_date_of_a_filtered_entry_does_not_fail(spark):
    text = "<url><loc>https://h/en/a</loc><lastmod>2024-01-01T00:00:00Z</lastmod></url><url><loc>https://h/de/b</loc><lastmod>?</lastmod></url>"
    df = spark.createDataFrame([("s", text)], "source string, value string")
    assert sitemap.process_sitemap(df, "https://h").count() == 1


def test_entry_without_date_runs_into_the_next(spark):
    text = "<url><loc>a</loc></url>\n<url><loc> b </loc>\n<lastmod>2024-01-01T00:00:00Z</lastmod></url>"
    df = spark.createDataFrame([("s", text)], "source string, value string")
    compat = values(sitemap.parse_entries(df), "url")
    assert len(compat) == 1 and compat[0].startswith("a</loc>")
    assert values(sitemap.parse_entries(df, mode="strict"), "url") == ["b"]


def test_last_entry_of_a_url_wins(spark):
    one = "<url><loc>u</loc><lastmod>2024-01-02T00:00:00Z</lastmod></url>"
    two = "<url><loc>u</loc><lastmod>2024-01-01T00:00:00Z</lastmod></url>"
    df = spark.createDataFrame([("s", one + two)], "source string, value string")
    rows = sitemap.process_sitemap(df, "u", (), (), ()).collect()
    assert [r["last_updated"] for r in rows] == [date(2024, 1, 1)]


def test_empty_filter_lists_are_off(spark):
    df = spark.createDataFrame([("a.PDF",), ("b",)], "url string")
    assert df.where(sitemap.wanted()).count() == 2
    assert values(df.where(sitemap.wanted(extensions=(".pdf",))), "url") == ["b"]


def test_base_url_prefix_and_strict(spark):
    df = spark.createDataFrame([("https://h.org/x",), ("https://h.org.evil.com/x",)], "url string")
    assert df.where(sitemap.is_safe("https://h.org")).count() == 2
    assert values(df.where(sitemap.is_safe("https://h.org", "strict")), "url") == ["https://h.org/x"]


def test_unicode_white_space(spark):
    df = spark.createDataFrame([(" A b\n\tC ",)], "t string")
    assert df.select(tokens("t")).first()[0] == ["a", "b", "c"]
    assert df.select(collapse_whitespace("t")).first()[0] == "A b C"


def test_chunk_ids_have_gaps_and_null_text_gives_nothing(spark):
    text = "a" * 60 + "\n\n" + "b" * 20 + "\n\n" + "c" * 200 + "\n\n" + "d" * 100
    df = spark.createDataFrame([("p", text), ("q", None)], "id string, extracted_content string")
    every = chunks.chunk_pages(df, min_length=0).orderBy("unique_id").collect()
    kept = chunks.chunk_pages(df, min_length=50).collect()
    assert [r["unique_id"] for r in every] == [f"p_{i + 1}" for i in range(len(every))]
    assert {r["unique_id"] for r in kept} == {r["unique_id"] for r in every if r["len"] >= 50}


def test_versions_need_two_snapshots(spark):
    one = spark.createDataFrame([(1, "a", "u")], "snapshot_id int, id string, url string")
    assert changes.version_by_age(one, 0).count() == 1
    assert changes.version_by_age(one, 1).count() == 0


def _list(spark, *rows):
    return spark.createDataFrame(
        [(i, u, date.fromisoformat(d)) for i, u, d in rows], "id string, url string, last_updated date"
    )


def test_diff_invariants(spark):
    old = _list(spark, ("a", "ua", "2024-01-01"), ("b", "ub", "2024-01-01"), ("c", "uc", "2024-01-01"))
    new = _list(spark, ("b", "ub", "2024-01-02"), ("c", "uc", "2024-01-01"), ("d", "ud", "2024-01-01"))
    kinds = {r["id"]: r["change_type"] for r in changes.diff(old, new).collect()}
    assert kinds == {"a": "removed", "b": "modified", "c": "unchanged", "d": "added"}
    feed = changes.changes(old, new, "2024-01-05 00:00:00")
    rebuilt = merge.upsert_replace(
        changes.pages_to_fetch(feed), merge.delete_rows(old, changes.ids_to_delete(feed), "id"), "id"
    )
    assert sorted(map(tuple, rebuilt.collect())) == sorted(map(tuple, new.select(rebuilt.columns).collect()))
    row = changes.change_counts(changes.diff(old, new)).first()
    assert (row["total_before"], row["total_after"], row["net_change"]) == (3, 3, 0)


def test_newest_change_set_wins(spark):
    rows = [("removed", "a", "u", None, datetime(2024, 1, 1)), ("added", "a", "u", date(2024, 1, 2), datetime(2024, 1, 2))]
    feed = spark.createDataFrame(rows, "change_type string, id string, url string, last_updated date, change_ts timestamp")
    assert values(changes.latest_changes(feed), "change_type") == ["added"]


def test_no_file_for_an_empty_feed(spark, tmp_path):
    old = _list(spark, ("a", "ua", "2024-01-01"))
    target = str(tmp_path / "changes")
    assert writers.write_change_sets(changes.changes(old, old), target) == 0
    assert not readers.path_exists(spark, target)


def test_upsert_keeps_old_value_for_null(spark):
    old = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], "id int, a string, b string")
    new = spark.createDataFrame([(1, None, "z", 5), (3, "n", None, 6)], "id int, a string, b string, extra int")
    rows = {r["id"]: tuple(r)[1:] for r in merge.upsert_keep_values(new, old).collect()}
    assert rows == {"1": ("x", "z", 5), "2": ("p", "q", None), "3": ("n", None, 6)}


def test_vector_cleaning(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([([1.0, nan, inf, -inf],)], "v array<float>")
    got = df.select(V.clean_vector("v")).first()[0]
    assert got[0] == 1.0 and got[1] == pytest.approx(0.1) and got[2] == -got[3] > 3.4e38


def test_failed_embeddings_are_dropped(spark):
    class Picky:
        def encode(self, texts):
            if any(t == "bad" for t in texts):
                raise RuntimeError("no")
            return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("a", "xx"), ("b", "bad"), ("c", "yyy")], "unique_id string, text string")
    rows = documents.embed_chunks(df, Picky).collect()
    assert {r["unique_id"]: r["embedding"] for r in rows} == {"a": [2.0], "c": [3.0]}


def test_model_needs_a_known_method(spark):
    df = spark.createDataFrame([("a", "x")], "unique_id string, text string")
    with pytest.raises(Exception, match="neither"):
        documents.embed_chunks(df, object).collect()


def test_random_id_without_unique_id(spark):
    df = spark.createDataFrame([("p", "x"), ("p", "y")], "id string, text string")
    rows = documents.generate_documents(df, chunk_size=256).collect()
    assert len({r["unique_id"] for r in rows}) == 2
    assert {r["metadata"]["general_id"] for r in rows} == {"p"}


def test_name_without_size_raises(spark):
    df = spark.createDataFrame([("recursive-vectors.json",)], "file_name string")
    with pytest.raises(Exception, match="no chunk size"):
        documents.with_name_columns(df).collect()


def test_placeholder_row_of_a_failed_fetch_stays_in_the_first_load_only(spark):
    pages = _list(spark, ("a", "ua", "2024-01-01"), ("b", "ub", "2024-01-01"))
    crawl = spark.createDataFrame([("ub", "<p>nothing</p>")], "url string, html string")
    first = enrich.enrich_pages(pages, crawl).collect()
    assert [(r["id"], r["extracted_content"]) for r in first] == [("a", "Main content not found")]
    assert enrich.enrich_pages(pages, crawl, drop_null=True).count() == 0


def _weights(df):
    return {(r["unique_id"], r["term_idx"]): round(r["score"], 9) for r in df.collect()}


def test_bm25_with_and_without_broadcast_terms_and_a_hot_term(spark):
    words = ["hot"] * 300 + [f"w{i}" for i in range(100)]
    rows = [(i, f"hot {words[i]} w{i % 7} hot") for i in range(400)]
    docs = spark.createDataFrame(rows, "n long, text string").withColumn(
        "unique_id", F.concat(F.lit("d_"), "n")
    )
    terms, params = bm25.build_bm25(docs, "text", "n")
    by_rank = {r["term"]: r["term_idx"] for r in terms.collect()}
    assert by_rank["hot"] == 0 and by_rank["w0"] == 1 and by_rank["w6"] == 7
    assert sorted(by_rank.values()) == list(range(len(by_rank)))
    wide = _weights(bm25.sparse_weights(docs, terms, params))
    assert wide == _weights(bm25.sparse_weights(docs, terms, params, hot_terms=3))
    assert len(wide) == sum(len(set(t.split())) for _, t in rows)


def test_chunk_without_known_terms_gets_an_empty_vector(spark):
    docs = spark.createDataFrame([(1, "alpha beta")], "n long, text string")
    terms, params = bm25.build_bm25(docs, "text", "n")
    other = spark.createDataFrame([("a_1", "gamma"), ("a_2", "alpha")], "unique_id string, text string")
    got = {r["unique_id"]: r["bm25_sparse_vector"] for r in bm25.add_sparse_vectors(other, terms, params).collect()}
    assert got["a_1"] == {} and list(got["a_2"]) == [0]


def test_stored_statistics_are_not_overwritten(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta")], "n long, text string")
    terms, params = bm25.build_bm25(docs, "text", "n")
    path = str(tmp_path / "bm25")
    writers.write_bm25(terms, params, path)
    with pytest.raises(Exception, match="already exists"):
        writers.write_bm25(terms, params, path)
    writers.write_bm25(terms, params, path, force=True)


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    rows = [("a", "u", date(2024, 1, 1), '<a href="x">\n"q", z</a>', "t", "c")]
    pages = spark.createDataFrame(rows, "id string, url string, last_updated date, html_content string, extracted_title string, extracted_content string")
    writers.write_enriched_csv(pages, str(tmp_path / "csv"))
    assert [tuple(r) for r in readers.read_enriched_csv(spark, str(tmp_path / "csv")).collect()] == rows


def test_gzip_sitemap_file(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "s.xml.gz", "wt") as f:
        f.write("<urlset>\n<url>\n<loc>u</loc>\n<lastmod>2024-01-01T00:00:00Z</lastmod>\n</url>\n</urlset>")
    assert values(sitemap.parse_entries(readers.read_sitemaps(spark, str(tmp_path / "*.gz"))), "url") == ["u"]
