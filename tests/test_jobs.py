"""Jobs end to end: increments equal rebuilds, runs repeat safely, streams equal batches."""

import uuid
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuslake.functions.embedding import HashingEmbedder
from corpuslake.functions.text import url_key
from corpuslake.operators import changes, chunks
from corpuslake.plans import jobs
from corpuslake.sources import writers
from corpuslake.sources.lake import Lake
from corpuslake.streaming.feed import start_change_feed

SETTINGS = jobs.Settings(load_model=lambda: HashingEmbedder(8), project="p")
TABLES = ("pages", "chunks", "documents", "registry", "vectors")


def page(n, version, words=80):
    body = " ".join(f"word{(n * 31 + i * version) % 97}" for i in range(words * (1 + n % 3)))
    return f'<h2>Page {n}</h2><div id="content-core"><p>{body}</p></div>'


def make(spark, listing):
    """(page list, crawl) of {n: version}; version 0 is a failed fetch."""
    rows = [(f"https://h/{n}", date(2024, 1, v + 1), page(n, v) if v else None) for n, v in listing.items()]
    df = spark.createDataFrame(rows, "url string, last_updated date, html string")
    pages = df.select(url_key("url").alias("id"), "url", "last_updated")
    return pages, df.where("html IS NOT NULL").select("url", "html")


def content(lake, table):
    return sorted(r["j"] for r in lake.read(table).select(F.to_json(F.struct("*")).alias("j")).collect())


OLD = {n: 1 for n in range(12)} | {20: 0}
NEW = {n: (2 if n % 3 == 0 else 1) for n in range(2, 15)} | {21: 0}


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), hex_digits=1)


def test_increment_equals_rebuild_with_frozen_statistics(spark, lake, tmp_path):
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial")
    assert lake.read("pages").where("html_content IS NULL").count() == 1
    feed = changes.changes(old, new, "2024-02-01 00:00:00")
    report = jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1").first()
    assert report["removed"] == 3 and report["modified"] == 3 and report["added"] == 4

    rebuilt = Lake(spark, str(tmp_path / "rebuilt"), hex_digits=1)
    rebuilt.begin("statistics")
    rebuilt.append("bm25_terms", lake.placed("bm25_terms").where("batch = 1"))
    rebuilt.append("bm25_sizes", lake.placed("bm25_sizes").where("batch = 1"))
    rebuilt.append("bm25_params", lake.read("bm25_params"))
    rebuilt.commit("statistics")
    fetched = new.join(crawl.select("url"), "url", "left_semi").select(*new.columns)
    jobs.initial_load(rebuilt, fetched, crawl, SETTINGS, batch_id="initial")
    for table in TABLES:
        assert content(lake, table) == content(rebuilt, table), table
    orphans = lake.read("chunks").join(
        lake.read("pages").select(F.col("id").alias("general_id")), "general_id", "left_anti"
    )
    assert orphans.count() == 0


def test_batch_takes_effect_once(spark, lake):
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial")
    assert jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial") is None
    feed = changes.changes(old, new, "2024-02-01 00:00:00")
    assert jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1") is not None
    before = content(lake, "vectors")
    assert jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1") is None
    again = jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b2").first()  # only the failed fetch is tried again
    assert (again["removed"], again["modified"], again["added"], again["updated_items"]) == (0, 0, 1, 0)
    assert content(lake, "vectors") == before
    empty = feed.where(F.lit(False))
    assert jobs.apply_changes(lake, empty, crawl, SETTINGS, batch_id="b3") is None


def test_run_that_dies_before_commit_leaves_no_trace(spark, lake, monkeypatch):
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial")
    before = {t: content(lake, t) for t in TABLES}
    feed = changes.changes(old, new, "2024-02-01 00:00:00")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "commit", dies)
        with pytest.raises(RuntimeError):
            jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1")
    assert {t: content(lake, t) for t in TABLES} == before
    assert jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1") is not None


def files(root):
    return {str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(root).rglob("*") if f.is_file()}


def test_an_update_touches_no_older_file_and_writes_what_changed(spark, lake):
    old, crawl = make(spark, {n: 1 for n in range(40)})
    jobs.initial_load(lake, old, crawl, SETTINGS, batch_id="initial")
    before = files(lake.root)
    new, new_crawl = make(spark, {n: (2 if n == 0 else 1) for n in range(40)})
    jobs.apply_changes(lake, changes.changes(old, new), new_crawl, SETTINGS, batch_id="b1")
    after = files(lake.root)
    assert {name: after[name] for name in before} == before
    changed = old.where("url = 'https://h/0'").first()["id"]
    added = {name for name in after if name not in before and "bucket=" in name}
    assert {name.split("bucket=")[1].split("/")[0] for name in added} == {changed[:1], "all"}
    for table in TABLES[:3]:
        ids = lake.placed(table).where("batch = 2").select("key").collect()
        assert ids and all(r.key.startswith(changed) for r in ids)
    everything = {t: content(lake, t) for t in TABLES}
    lake.compact(TABLES, "compact")
    assert {t: content(lake, t) for t in TABLES} == everything
    assert lake.placed("pages").select("batch").distinct().collect()[0].batch == 3


def test_readers_prune_partitions_at_run_time(spark, lake):
    old, crawl = make(spark, {n: 1 for n in range(40)})
    jobs.initial_load(lake, old, crawl, SETTINGS, batch_id="initial")
    few = lake.read("registry", lake.near(old.where("url = 'https://h/0'")))
    n = few.count()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert 0 < n < lake.read("registry").count()


def test_what_a_lost_run_left_does_not_come_back(spark, lake, monkeypatch):
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial")
    feed = changes.changes(old, new, "2024-02-01 00:00:00")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "commit", dies)
        with pytest.raises(RuntimeError):
            jobs.apply_changes(lake, feed, crawl, SETTINGS, batch_id="b1", refresh_bm25=True)
    docs = lake.read("documents")
    jobs.publish_vectors(lake, docs.limit(1), "q", "b2")  # writes two tables only
    pages, _ = make(spark, OLD)
    assert sorted(r.id for r in lake.read("pages").collect()) == sorted(r.id for r in pages.collect())
    assert lake.read("bm25_params").count() == 1 and lake.read("vectors").where("metadata.project = 'q'").count() == 1


def test_change_sets_in_any_order_give_one_state(spark, tmp_path):
    versions = [OLD, NEW, {n: 2 for n in range(4, 18)} | {30: 0}, {n: 3 for n in range(0, 12)} | {21: 1}]
    crawl = make(spark, {n: 3 for n in range(0, 18)} | {21: 1})[1]
    listed = [make(spark, v)[0] for v in versions]
    feeds = [
        changes.changes(a, b, f"2024-02-0{n + 1} 00:00:00").persist() for n, (a, b) in enumerate(zip(listed, listed[1:]))
    ]
    states = []
    for name, order in (("right", (0, 1, 2)), ("other", (2, 0, 1))):
        target = Lake(spark, str(tmp_path / name), hex_digits=1)
        jobs.initial_load(target, listed[0], crawl, SETTINGS, batch_id="initial")
        for k, n in enumerate(order):
            jobs.apply_changes(target, feeds[n], crawl, SETTINGS, batch_id=f"b{k}")
        states.append({t: content(target, t) for t in ("pages", "documents", "registry", "vectors")})
    assert states[0] == states[1]


def statistics(lake):
    terms, params = jobs.stored_bm25(lake)
    return (
        sorted((r.term, r.df, round(r.idf, 9)) for r in terms.collect()),
        [round(x, 9) for x in params.first()],
        {r.term: r.term_idx for r in terms.collect()},
    )


def test_refreshed_statistics_equal_a_rebuild_and_ids_only_grow(spark, lake, tmp_path):
    versions = [OLD, NEW, {n: 5 for n in range(3)} | {n: 2 for n in range(8, 12)}]
    listed = [make(spark, v) for v in versions]
    jobs.initial_load(lake, *listed[0], SETTINGS, batch_id="initial")
    ids = statistics(lake)[2]
    for n, refresh in ((1, False), (2, True)):
        feed = changes.changes(listed[n - 1][0], listed[n][0], f"2024-02-0{n} 00:00:00")
        frozen = statistics(lake)
        jobs.apply_changes(lake, feed, listed[n][1], SETTINGS, batch_id=f"b{n}", refresh_bm25=refresh)
        if not refresh:
            assert statistics(lake) == frozen
            continue
        other = Lake(spark, str(tmp_path / f"rebuilt{n}"), hex_digits=1)
        pages = lake.read("pages").select("id", "url", "last_updated")
        jobs.initial_load(other, pages, listed[n][1], SETTINGS, batch_id="initial")
        assert statistics(lake)[:2] == statistics(other)[:2]
        now = statistics(lake)[2]
        assert all(ids[t] == now[t] for t in ids if t in now) and len(set(now.values())) == len(now)
        ids |= now
        by_index = {v: t for t, v in ids.items()}
        words = {r.id: set(r.text.lower().split()) for r in lake.read("vectors").select("id", "metadata.text").collect()}
        for r in lake.read("vectors").select("id", "sparse_values.indices").collect():
            assert {by_index[k] for k in r.indices or []} <= words[r.id]


class Counting(HashingEmbedder):
    """Notes every text it is asked for in a file of its own."""

    def __init__(self, folder):
        super().__init__(8)
        self.folder = folder

    def embed_documents(self, texts):
        for text in texts:
            (Path(self.folder) / uuid.uuid4().hex).write_text(text)
        return super().embed_documents(texts)


def test_only_changed_chunks_are_embedded(spark, lake, tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()
    settings = jobs.Settings(load_model=lambda: Counting(str(folder)), project="p")
    long_page = [f"word{n}" + "x" * (n % 7) for n in range(400)]

    def listing(words, day):
        html = f'<h2>T</h2><div id="content-core"><p>{" ".join(words)}</p></div>'
        rows = [("https://h/a", date(2024, 1, day), html), ("https://h/b", date(2024, 1, 1), html.replace("word1", "other"))]
        df = spark.createDataFrame(rows, "url string, last_updated date, html string")
        return df.select(url_key("url").alias("id"), "url", "last_updated"), df.select("url", "html")

    old, old_crawl = listing(long_page, 1)
    jobs.initial_load(lake, old, old_crawl, settings, batch_id="b0")
    n_chunks = lake.read("documents").count()
    assert len(list(folder.iterdir())) == n_chunks
    for f in folder.iterdir():
        f.unlink()
    changed = [*long_page[:-1], "w" * len(long_page[-1])]  # the last word, in the last chunk of one page
    new, crawl = listing(changed, 2)
    jobs.apply_changes(lake, changes.changes(old, new), crawl, settings, batch_id="b1")
    assert len(list(folder.iterdir())) == 1
    assert lake.read("documents").count() == n_chunks
    other = replace(settings, model="another")
    back, _ = listing(changed, 3)
    jobs.apply_changes(lake, changes.changes(new, back), crawl, other, batch_id="b2")
    pages = lake.read("documents").where("metadata.url = 'https://h/a'").count()
    assert len(list(folder.iterdir())) == 1 + pages  # another model makes its own vectors


def test_several_sizes_are_loaded_updated_and_deleted_together(spark, lake):
    settings = replace(SETTINGS, chunk_sizes=(128, 256))
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, settings, batch_id="b0")
    jobs.apply_changes(lake, changes.changes(old, new, "2024-02-01 00:00:00"), crawl, settings, batch_id="b1")
    for size in (128, 256):
        wanted = chunks.chunk_pages(lake.read("pages"), (size,)).select("unique_id", "text")
        found = lake.read("vectors").where(F.col("metadata.chunk_size") == size).select("id", "metadata.text")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_insert_only_adds_each_id_once_and_registers_it(spark, lake):
    old, crawl = make(spark, {n: 1 for n in range(6)})
    source = Lake(spark, lake.root + "-source", hex_digits=1)
    jobs.initial_load(source, old, crawl, SETTINGS, batch_id="b0")
    docs = source.read("documents")
    jobs.publish_new_vectors(lake, docs.union(docs), 256, "recursive", "b1")
    jobs.publish_new_vectors(lake, docs, 256, "recursive", "b2")
    n = docs.count()
    assert lake.read("vectors").count() == lake.read("registry").count() == n
    kept, _ = make(spark, {n: 1 for n in range(1, 6)})
    jobs.apply_changes(lake, changes.changes(old, kept), crawl, SETTINGS, batch_id="b3")
    left = docs.where("metadata.url <> 'https://h/0'").count()
    assert 0 < left < n and lake.read("vectors").count() == lake.read("registry").count() == left


def test_stream_of_two_change_sets_with_restart_equals_batch(spark, lake, tmp_path):
    first, first_crawl = make(spark, OLD)
    second, _ = make(spark, NEW)
    third, crawl = make(spark, {n: 2 for n in range(4, 18)})
    feeds = [
        changes.changes(first, second, "2024-02-01 00:00:00"),
        changes.changes(second, third, "2024-02-15 00:00:00"),
    ]
    other = Lake(spark, str(tmp_path / "batch"), hex_digits=1)
    for target in (lake, other):
        jobs.initial_load(target, first, first_crawl, SETTINGS, batch_id="initial")
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")
    for number, feed in enumerate(feeds):
        jobs.apply_changes(other, feed, crawl, SETTINGS, batch_id=f"b{number}")
        writers.write_change_sets(feed, inbox)
        start_change_feed(spark, inbox, checkpoint, lake, crawl, SETTINGS).awaitTermination()
    for table in TABLES:
        assert content(lake, table) == content(other, table), table
    start_change_feed(spark, inbox, checkpoint, lake, crawl, SETTINGS).awaitTermination()
    assert content(lake, "vectors") == content(other, "vectors")


def test_stream_with_archive(spark, lake, tmp_path):
    old, old_crawl = make(spark, OLD)
    new, crawl = make(spark, NEW)
    jobs.initial_load(lake, old, old_crawl, SETTINGS, batch_id="initial")
    inbox, checkpoint, archive = (str(tmp_path / n) for n in ("inbox", "checkpoint", "archive"))
    writers.write_change_sets(changes.changes(old, new, "2024-02-01 00:00:00"), inbox)
    for _ in range(2):
        started = start_change_feed(spark, inbox, checkpoint, lake, crawl, SETTINGS, archive)
        started.awaitTermination()
    expected = new.join(crawl, "url", "left_semi")
    assert sorted(r["id"] for r in lake.read("pages").collect()) == sorted(
        r["id"] for r in expected.collect()
    )
    assert lake.state()[0] == 2


def test_snapshot_job_without_predecessor(spark, tmp_path):
    text = "<url><loc>https://h/en/a</loc><lastmod>2024-01-01T00:00:00Z</lastmod></url>"
    texts = spark.createDataFrame([("s", text)], "source string, value string")
    path, inbox = str(tmp_path / "snapshots"), str(tmp_path / "changes")
    funnel = jobs.take_snapshot(texts, "https://h", path, 1).first()
    assert tuple(funnel) == (1, 1, 1, 0)
    report = jobs.diff_snapshots(spark.read.parquet(path), inbox).first()
    assert report["changes_detected"] is False and report["message"] == "no changes detected"
    jobs.take_snapshot(texts.withColumn("value", F.replace("value", F.lit("en/a"), F.lit("en/b"))), "https://h", path, 2)
    report = jobs.diff_snapshots(spark.read.parquet(path), inbox).first()
    assert report["changes_detected"] is True and (report["removed"], report["added"]) == (1, 1)
