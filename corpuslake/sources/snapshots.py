"""Page list snapshots in key buckets, with a digest of each bucket.

Two snapshots of a large site mostly agree.  Their digests, a few hundred rows, say in
which buckets they do not, and only those are read and compared.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake import schemas
from corpuslake.operators.changes import bucket_digests, diff

DIGITS = 2
_PLACED = "id string, url string, last_updated date, snapshot_id int, bucket string"
_DIGESTS = "bucket string, rows long, mark decimal(38,0), other long, snapshot_id int"


def write_snapshot(pages: DataFrame, path: str, snapshot_id: int, digits: int = DIGITS) -> None:
    """Writes a snapshot by bucket, and its digests last; a repeated run replaces both.

    All snapshots of a path need the same ``digits``.
    """
    spark = pages.sparkSession
    target = f"{path}/rows/snapshot_id={int(snapshot_id)}"
    placed = pages.select(*schemas.SITEMAP.fieldNames(), F.substring("id", 1, digits).alias("bucket"))
    placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
    stored = spark.read.schema("id string, url string, last_updated date, bucket string").parquet(target)
    bucket_digests(stored).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests/snapshot_id={int(snapshot_id)}")


def read_snapshot(spark: SparkSession, path: str, snapshot_id: int) -> DataFrame:
    stored = spark.read.schema(_PLACED).parquet(f"{path}/rows").where(F.col("snapshot_id") == snapshot_id)
    return stored.select("id", "url", "last_updated", "bucket")


def digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DIGESTS).parquet(f"{path}/digests")


def changed_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets whose digests differ or that one side lacks; at most 16 ** DIGITS rows."""
    columns = ["bucket", "rows", "mark", "other"]
    either = old.select(*columns).unionByName(new.select(*columns))
    return either.groupBy(*columns).agg(F.count("*").alias("sides")).where("sides = 1").select("bucket").distinct()


def diff_changed_buckets(spark: SparkSession, path: str, old_id: int, new_id: int) -> DataFrame:
    """``diff`` of two stored snapshots without the buckets that are equal; all its changes are there."""
    marks = digests(spark, path)
    of = {n: marks.where(F.col("snapshot_id") == n) for n in (old_id, new_id)}
    changed = F.broadcast(changed_buckets(of[old_id], of[new_id]))
    old, new = (read_snapshot(spark, path, n).join(changed, "bucket", "left_semi") for n in (old_id, new_id))
    return diff(old, new)
