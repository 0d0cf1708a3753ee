"""Snapshot versions and the difference between two of them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.operators.common import keep_last, single, unfold

NO_ID = "\0"  # stands for a null id in JSON objects keyed by id
COMPARED = ("url", "last_updated")
CHANGE_TYPES = ("removed", "modified", "added")


def version_by_age(snapshots: DataFrame, age: int = 0, column: str = "snapshot_id") -> DataFrame:
    """Rows of the ``age``-th newest snapshot (0 = latest); none if there are fewer.

    Each step back is one scalar ``max`` over the version column, so the final
    filter is a single value that prunes partitions.
    """
    ids = snapshots.select(column)
    newest = ids.agg(F.max(column).alias("v"))
    for _ in range(age):
        newest = ids.where(F.col(column) < single(newest, "v")).agg(F.max(column).alias("v"))
    return snapshots.where(F.col(column) == single(newest, "v"))


def removed(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    return old.join(new.select(key), key, "left_anti")


def added(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    return new.join(old.select(key), key, "left_anti")


def modified(old: DataFrame, new: DataFrame, key: str = "id", compared=COMPARED) -> DataFrame:
    """New rows whose key exists in both and whose compared columns differ."""
    before = old.select(key, F.struct(*compared).alias("_old"))
    same = F.struct(*compared).eqNullSafe(F.col("_old"))
    return new.join(before, key).where(~same).drop("_old")


def common_keys(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    return old.select(key).intersect(new.select(key))


def missing_keys(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    return old.select(key).subtract(new.select(key))


def diff(old: DataFrame, new: DataFrame, key: str = "id", compared=COMPARED) -> DataFrame:
    """``change_type, key, compared...`` for all keys, ``unchanged`` included.

    One full outer join; removed rows show the old values, others the new.
    """
    left = old.select(key, F.struct(*compared).alias("_old"))
    right = new.select(key, F.struct(*compared).alias("_new"))
    kind = (
        F.when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").isNull(), "added")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("modified")
    )
    row = F.coalesce("_new", "_old")
    return (
        left.join(right, key, "full_outer")
        .withColumn("change_type", kind)
        .withColumn("_row", row)
        .select("change_type", key, *[F.col(f"_row.{c}").alias(c) for c in compared])
    )


def bucket_digests(placed: DataFrame, key: str = "id", compared=COMPARED) -> DataFrame:
    """``bucket, rows, mark, other``: two order-free digests of the rows of each bucket.

    Sums of 64-bit hashes, one of them of the reversed key, so that equal digests mean equal
    rows but for a chance of about 2**-128.
    """
    first = F.xxhash64(key, *compared)
    second = F.xxhash64(F.reverse(key), *compared, F.lit(1))
    return placed.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum(first.cast("decimal(38,0)")).alias("mark"), F.bit_xor(second).alias("other")
    )


def stamped(feed: DataFrame, change_ts=None) -> DataFrame:
    stamp = F.current_timestamp() if change_ts is None else F.lit(change_ts).cast("timestamp")
    return feed.withColumn("change_ts", stamp)


def changes(old: DataFrame, new: DataFrame, change_ts=None) -> DataFrame:
    """The change feed: ``diff`` without unchanged rows, stamped."""
    return stamped(diff(old, new).where("change_type <> 'unchanged'"), change_ts)


def change_counts(difference: DataFrame) -> DataFrame:
    """One row: removed, modified, added, total before and after, net change."""

    def n(*kinds):
        return F.count_if(F.col("change_type").isin(*kinds))

    before = n("removed", "modified", "unchanged")
    after = n("added", "modified", "unchanged")
    return difference.agg(
        n("removed").alias("removed"),
        n("modified").alias("modified"),
        n("added").alias("added"),
        before.alias("total_before"),
        after.alias("total_after"),
        (after - before).alias("net_change"),
    )


def ids_to_delete(feed: DataFrame) -> DataFrame:
    """Distinct ids whose derived data goes away: removed or modified."""
    return feed.where(F.col("change_type").isin("removed", "modified")).select("id").distinct()


def pages_to_fetch(feed: DataFrame) -> DataFrame:
    """``id, url, last_updated`` of added and modified pages; modified wins over added."""
    picked = feed.where(F.col("change_type").isin("added", "modified"))
    later = (F.col("change_type") == "modified").cast("int").alias("later")
    return keep_last(picked.select("id", "url", "last_updated", later), "id", ["later"]).drop(
        "later"
    )


def change_order():
    """Sorts changes of one page: by time, then removed, added, modified, then by the date of the page."""
    kind = F.array_position(F.array(*map(F.lit, ("removed", "added", "modified"))), F.col("change_type"))
    return F.struct(F.col("change_ts").alias("at"), kind.alias("kind"), F.col("last_updated").alias("day"))


def latest_changes(feed: DataFrame) -> DataFrame:
    """One row per id when several change sets are applied together: the newest."""
    return keep_last(feed, "id", [change_order()])


def _entry() -> Column:
    page = F.struct("url", F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"))
    return F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), page)


def _sharded(rows: DataFrame, shards: int, *document: str) -> DataFrame:
    """Adds ``_shard`` and ``_turn``, 0 for the first row of an id, 1 for the next: an object holds a key once.

    The rows of a shard are brought together here; grouping below it needs no exchange of its own.
    """
    whole = [c for c in document if c != "change_type"]
    placed = rows.withColumn("_shard", F.pmod(F.xxhash64("id"), F.lit(shards))).repartition(*whole, "_shard")
    same = Window.partitionBy(*document, "_shard", "id").orderBy("last_updated", "url")
    return placed.withColumn("_turn", F.row_number().over(same) - 1)


def to_change_sets(feed: DataFrame, shards: int = 1) -> DataFrame:
    """Rows -> change-set documents ``{removed, modified, added, timestamp}``.

    ``shards`` splits the ids so that no document grows with the change set.  Rows that
    repeat an id in one kind of change go to further documents of their own.
    """

    def part(kind):
        chosen = F.collect_list(F.when(F.col("change_type") == kind, _entry()))
        return F.map_from_entries(chosen).alias(kind)

    return (
        _sharded(feed, shards, "change_ts", "change_type")
        .groupBy("change_ts", "_shard", "_turn")
        .agg(*[part(kind) for kind in CHANGE_TYPES])
        .select(*CHANGE_TYPES, F.col("change_ts").alias("timestamp"))
    )


def from_change_sets(documents: DataFrame) -> DataFrame:
    """Change-set documents -> rows ``change_type, id, url, last_updated, change_ts``."""
    empty = F.create_map().cast("map<string,struct<url:string,last_updated:string>>")

    def part(kind):
        return F.transform(
            F.map_entries(F.coalesce(kind, empty)),
            lambda e: F.struct(
                F.lit(kind).alias("change_type"), F.nullif(e["key"], F.lit(NO_ID)).alias("id"), e["value"].alias("page")
            ),
        )

    rows = F.concat(*[part(kind) for kind in CHANGE_TYPES])
    return unfold(documents, ["timestamp"], rows, "c").select(
        "c.change_type",
        "c.id",
        "c.page.url",
        F.to_date("c.page.last_updated").alias("last_updated"),
        F.col("timestamp").alias("change_ts"),
    )


def to_keyed_maps(pages: DataFrame, shards: int = 1) -> DataFrame:
    """Keyed page list -> JSON objects ``{id: {url, last_updated}}``, one per shard; further ones for repeated ids."""
    return (
        _sharded(pages, shards)
        .groupBy("_shard", "_turn")
        .agg(F.to_json(F.map_from_entries(F.collect_list(_entry()))).alias("value"))
        .select("value")
    )


def from_keyed_maps(texts: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects ``{id: {url, last_updated}}`` -> ``id, url, last_updated``."""
    parsed = F.from_json(column, "map<string,struct<url:string,last_updated:string>>")
    return unfold(texts, [], F.map_entries(parsed), "e").select(
        F.nullif("e.key", F.lit(NO_ID)).alias("id"),
        "e.value.url",
        F.to_date("e.value.last_updated").alias("last_updated"),
    )
