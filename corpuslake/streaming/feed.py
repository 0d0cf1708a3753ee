"""Change sets as a stream: each is applied once to the corpus tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpuslake import schemas
from corpuslake.operators.changes import from_change_sets
from corpuslake.plans.jobs import Settings, apply_changes
from corpuslake.sources.lake import Lake


def start_change_feed(
    spark: SparkSession,
    change_path: str,
    checkpoint: str,
    lake: Lake,
    crawl: DataFrame,
    settings: Settings = Settings(),
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Consumes the change sets waiting in a folder and stops.

    A micro-batch may run again after a failure; the tables remember the batch,
    so it takes effect once.  ``archive`` moves finished files there.
    """
    source = spark.readStream.schema(schemas.CHANGE_SET).option("multiLine", True)
    if archive:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def apply(batch: DataFrame, number: int) -> None:
        feed = from_change_sets(batch)
        apply_changes(lake, feed, crawl, settings, batch_id=f"{checkpoint}#{number}")

    return (
        source.json(change_path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
