"""Bucketed snapshots: equal buckets are not read, the report is that of a full comparison."""

from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from corpuslake.functions.text import url_key
from corpuslake.operators import changes
from corpuslake.plans import jobs
from corpuslake.sources import readers, snapshots, writers


def listing(spark, days):
    rows = [(f"https://h/{n}", date(2024, 1, 1) + timedelta(d)) for n, d in days.items()]
    return spark.createDataFrame(rows, "url string, last_updated date").select(url_key("url").alias("id"), "url", "last_updated")


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_equal_buckets_are_not_read(spark, tmp_path):
    old = listing(spark, {n: 0 for n in range(400)})
    new = listing(spark, {n: (1 if n == 7 else 0) for n in range(401) if n != 9})
    path = str(tmp_path / "snapshots")
    for n, pages in enumerate((old, new, new)):
        snapshots.write_snapshot(pages, path, n)
    touched = {r.id[:2] for r in changes.diff(old, new).where("change_type <> 'unchanged'").collect()}
    spoiled = 0
    for file in Path(path, "rows").rglob("*.parquet"):
        if str(file).split("bucket=")[1].split("/")[0] not in touched:
            file.write_bytes(b"no parquet")  # whoever reads it fails
            spoiled += 1
    assert spoiled > 100
    found = snapshots.diff_changed_buckets(spark, path, 0, 1).where("change_type <> 'unchanged'")
    assert rows(found) == rows(changes.diff(old, new).where("change_type <> 'unchanged'"))
    assert snapshots.diff_changed_buckets(spark, path, 1, 2).count() == 0


def test_report_equals_that_of_a_full_comparison(spark, tmp_path):
    versions = [{n: 0 for n in range(60)}, {n: n % 5 == 0 for n in range(3, 64)}, {}]
    stored, plain = str(tmp_path / "stored"), str(tmp_path / "plain")
    for n, days in enumerate(versions):
        days = {k: int(v) for k, v in days.items()}
        pages = listing(spark, days) if days else listing(spark, {0: 0}).limit(0)
        snapshots.write_snapshot(pages, stored, n, digits=1)
        writers.append_snapshot(pages, plain, n)
        outcomes = []
        for name in ("a", "b"):
            feed = str(tmp_path / f"feed-{n}-{name}")
            if name == "a":
                report = jobs.diff_stored_snapshots(spark, stored, feed, "2024-02-01 00:00:00")
            else:
                report = jobs.diff_snapshots(spark.read.parquet(plain), feed, "2024-02-01 00:00:00")
            written = rows(changes.from_change_sets(readers.read_change_sets(spark, feed))) if report.first()["changes_detected"] else []
            outcomes.append((rows(report.drop("message")), written))
        assert outcomes[0] == outcomes[1]


def test_a_changed_row_changes_its_digest(spark):
    pages = listing(spark, {n: 0 for n in range(50)}).withColumn("bucket", F.lit("all"))
    digest = changes.bucket_digests(pages).first()
    assert changes.bucket_digests(pages.repartition(7)).first() == digest
    other = pages.withColumn("last_updated", F.when(F.col("url") == "https://h/3", F.lit(date(2024, 5, 1))).otherwise(F.col("last_updated")))
    assert changes.bucket_digests(other).first() != digest
