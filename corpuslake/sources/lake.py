"""Corpus tables on plain Parquet that only grow: appended rows and keys of removed ones.

A batch appends new rows to ``<table>/batch=<n>`` and the keys of rows it removes or
replaces to ``removed/batch=<n>``; a row is current unless its key was removed by a later
batch.  So an update writes what its change set holds, and no older file is touched.  All
files are partitioned by bucket, a prefix of the md5 page id that the keys of all tables
begin with; readers that know their pages prune by it at run time.

The last write of a batch is its row in ``commits``.  Readers skip what has none, and the
next run overwrites or empties what a lost one left.  One writer at a time is assumed.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake import schemas
from corpuslake.sources.readers import empty, path_exists, read_or_empty
from corpuslake.sources.scratch import checkpointed


def _key(*columns) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    key: object = None  # columns of a row -> its key; None: rows are never removed one by one

    def key_column(self) -> Column | None:
        return None if self.key is None else self.key()


TABLES = {
    "pages": Table(schemas.PAGES, lambda: F.col("id")),
    "chunks": Table(schemas.CHUNKS, lambda: _key(F.col("unique_id"), F.col("chunk_size"))),
    "documents": Table(
        schemas.STORED_DOCUMENTS, lambda: _key(F.col("unique_id"), F.col("metadata.chunk_size"))
    ),
    "registry": Table(schemas.UNIQUE_IDS, lambda: F.col("unique_id")),
    "vectors": Table(
        schemas.VECTORS,
        lambda: _key(F.col("id"), F.col("metadata.doc_type"), F.size("values"), F.col("metadata.chunk_size")),
    ),
    "changes": Table(schemas.CHANGE_STATE, lambda: F.col("id")),
    "bm25_terms": Table(schemas.TERM_DELTAS),
    "bm25_sizes": Table(schemas.SIZE_DELTAS),
    "bm25_params": Table(schemas.STORED_PARAMS),
}
_PLACE = [T.StructField("bucket", T.StringType()), T.StructField("batch", T.IntegerType())]
_REMOVED = T.StructType([T.StructField("key", T.StringType()), T.StructField("table", T.StringType()), *_PLACE])
_COMMITS = "batch_id string, replaced array<string>, hex_digits int, batch int"


@dataclass(frozen=True)
class Near:
    """Some buckets, and the removed keys in them."""

    buckets: DataFrame
    removed: DataFrame


class Lake:
    """Tables below ``root``.  ``hex_digits`` is the bucket width of a new lake; a lake keeps the one it began with."""

    def __init__(self, spark: SparkSession, root: str, hex_digits: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self._width = hex_digits
        self._state = None
        self._written = set()

    def _commits(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/commits", _COMMITS)

    def _load(self, batch_id: str = "") -> bool:
        """Reads the state anew; whether the batch is among the commits."""
        since = [F.max(F.when(F.array_contains("replaced", name), F.col("batch"))).alias(name) for name in TABLES]
        seen = F.max(F.col("batch_id") == batch_id).alias("seen")
        row = self._commits().agg(F.max("batch").alias("batch"), F.max("hex_digits").alias("width"), seen, *since).first()
        self._state = row.batch or 0, {name: row[name] or 0 for name in TABLES}, row.width or self._width
        return bool(row.seen)

    def state(self):
        """``(last batch, {table: first batch that counts}, bucket width)`` as of the first use or the last commit here."""
        if self._state is None:
            self._load()
        return self._state

    @property
    def hex_digits(self) -> int:
        return self.state()[2]

    @property
    def next_batch(self) -> int:
        return self.state()[0] + 1

    def applied(self, batch_id: str) -> bool:
        return not self._commits().where(F.col("batch_id") == batch_id).isEmpty()

    def begin(self, batch_id: str) -> bool:
        """Starts a batch; False if it was applied before."""
        self._written = set()
        return not self._load(batch_id)

    def commit(self, batch_id: str, replaced=()) -> None:
        """Makes the batch current.  Of ``replaced`` tables only what it appended counts from now on."""
        number, _, width = self.state()
        for name in {*TABLES, "removed"} - self._written:
            self._clear(f"{self.root}/{name}/batch={number + 1}")
        row = self.spark.createDataFrame(
            [(batch_id, sorted(replaced), width)], "batch_id string, replaced array<string>, hex_digits int"
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/batch={number + 1}")
        self._state = None

    def _clear(self, path: str) -> None:
        """Empties what a lost run left behind where this one has nothing to write."""
        if path_exists(self.spark, path):
            empty(self.spark, "bucket string, row int").write.mode("overwrite").partitionBy("bucket").parquet(path)

    # -- writing -----------------------------------------------------------------

    def bucket_of(self, key: Column) -> Column:
        return F.substring(key, 1, self.hex_digits)

    def _write(self, placed: DataFrame, path: str, by: list, counts: dict, mode: str = "overwrite") -> dict:
        """The counts are taken in the tasks that write, so no row is read for them again."""
        seen = Observation()
        watched = placed.observe(seen, *[c.alias(n) for n, c in counts.items()])
        watched.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)
        return seen.get

    def append(self, table: str, rows: DataFrame, placed: bool = False, one_of=(), latest: Column | None = None) -> int:
        """Writes rows of the coming batch; returns their number.

        Rebalancing lets AQE split a bucket that one page dominates and merge small ones.  Rows
        that are ``placed``, made from rows of the same buckets as they lie in storage, stay
        where they are, and so do rows of tables that have one bucket only.  Of rows that agree in ``one_of`` the greatest by ``latest`` is written;
        they meet in the one exchange that brings the rows to their buckets.
        """
        shape = TABLES[table]
        bucket = F.lit("all") if shape.key is None else self.bucket_of(shape.key_column())
        found = rows.select(*shape.schema.fieldNames(), bucket.alias("bucket"))
        if latest is not None:
            found = self._last(found, one_of, latest)
        elif shape.key is not None and not placed:
            found = found.hint("rebalance", "bucket")
        self._written.add(table)
        path = f"{self.root}/{table}/batch={self.next_batch}"
        return self._write(found, path, ["bucket"], {"n": F.count(F.lit(1))})["n"]

    def _last(self, rows: DataFrame, one_of, latest: Column) -> DataFrame:
        """One row of those that agree in ``one_of``, by bucket and salt."""
        dealt = rows.withColumn("_salt", self._salt(*one_of)).repartition("bucket", "_salt")
        order = Window.partitionBy("bucket", "_salt", *one_of).orderBy(latest.desc())
        return dealt.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*rows.columns)

    def _deal(self, parts: int) -> int:
        """Salts a bucket needs, so that all buckets make about twice as many places as there are parts."""
        return -(-2 * parts // 16**self.hex_digits)

    def _salt(self, *columns) -> Column:
        """Deals a bucket to several tasks."""
        deal = self._deal(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return F.pmod(F.xxhash64(*columns), F.lit(deal))

    def place_of(self, key: Column, parts: int) -> Column:
        """Number of the part a key belongs to; rows dealt by it are ``placed`` for ``append``.

        Parts are of like size, and each holds neighbouring buckets or a share of one.
        """
        deal = self._deal(parts)
        bucket = F.coalesce(F.conv(self.bucket_of(key), 16, 10).try_cast("int"), F.lit(0))
        number = bucket * deal + F.pmod(F.coalesce(F.xxhash64(key), F.lit(0)), F.lit(deal))
        return F.floor(number * F.lit(parts) / F.lit(16**self.hex_digits * deal)).cast("int")

    def remove(self, keys: DataFrame) -> dict:
        """Writes ``table, key, counted`` of rows that the coming batch removes or replaces; further calls add to it.

        Older rows with such a key are gone once it is committed, its own stay.  Returns
        the number of counted keys by table.
        """
        counts = {
            name: F.count_if((F.col("table") == name) & F.col("counted")) for name, t in TABLES.items() if t.key
        }
        mode = "append" if "removed" in self._written else "overwrite"
        self._written.add("removed")
        placed = keys.select("table", "key", "counted", self.bucket_of(F.col("key")).alias("bucket"))
        placed = placed.hint("rebalance", "table", "bucket")
        return self._write(placed, f"{self.root}/removed/batch={self.next_batch}", ["table", "bucket"], counts, mode)

    # -- reading -----------------------------------------------------------------

    def near(self, ids: DataFrame, key: str = "id") -> "Near":
        """The buckets of some page ids and the keys that were removed in them, worked out once.

        There are at most 16 ** hex_digits buckets, so their broadcast is bounded; the
        comparison lets the optimizer prune partitions by them at run time.
        """
        buckets = checkpointed(ids.select(self.bucket_of(F.col(key)).alias("bucket")).distinct()).where("bucket > ''")
        removed = self._rows("removed", _REMOVED, min(self.state()[1].values()) + 1)
        return Near(buckets, checkpointed(removed.join(F.broadcast(buckets), "bucket", "left_semi")))

    def _rows(self, name: str, schema: T.StructType, first: int) -> DataFrame:
        stored = read_or_empty(self.spark, f"{self.root}/{name}", schema)
        return stored.where(F.col("batch").between(first, self.state()[0]))

    def placed(self, table: str, near: "Near | None" = None) -> DataFrame:
        """Current rows with ``key``, ``bucket`` and ``batch``; ``near`` limits them to some buckets.

        Nothing removes rows of the last batch, so only older ones are joined with the removed keys.
        """
        last, since = self.state()[0], self.state()[1][table]
        shape = TABLES[table]
        rows = self._rows(table, T.StructType([*shape.schema.fields, *_PLACE]), since)
        if shape.key is None:
            return rows
        if near is None:
            removed = self._rows("removed", _REMOVED, since + 1)
        else:
            rows, removed = rows.join(F.broadcast(near.buckets), "bucket", "left_semi"), near.removed
        gone = removed.where(F.col("table") == table).select(F.col("key").alias("_key"), F.col("batch").alias("_batch"))
        rows = rows.withColumn("key", shape.key_column())
        newest = rows.where(F.col("batch") == last)
        if since >= last:
            return newest
        older = rows.where(F.col("batch") < last)
        kept = older.join(gone, (F.col("key") == F.col("_key")) & (F.col("_batch") > F.col("batch")), "left_anti")
        return kept.unionByName(newest)

    def read(self, table: str, near: "Near | None" = None) -> DataFrame:
        """Current rows of a table; empty if never written."""
        return self.placed(table, near).select(*TABLES[table].schema.fieldNames())

    def appended(self, table: str) -> DataFrame:
        """Rows that were appended for the coming batch, read back from storage."""
        shape, number = TABLES[table], self.next_batch
        stored = T.StructType([*shape.schema.fields, _PLACE[0]])
        rows = read_or_empty(self.spark, f"{self.root}/{table}/batch={number}", stored)
        return rows.select(*shape.schema.fieldNames())

    def compact(self, tables, batch_id: str) -> None:
        """Rewrites the current rows of tables, so that readers need no older batch of them."""
        if self.begin(batch_id):
            for table in tables:
                self.append(table, self.read(table))
            self.commit(batch_id, replaced=tables)
