"""Run statistics and their text form."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def change_message(counts: str = "", path: str = "") -> Column:
    """Message about detected changes, over the columns of ``change_counts``."""
    c = lambda name: F.col(f"{counts}.{name}" if counts else name)
    return F.format_string(
        "Sitemap changes\n"
        "removed: %d\nmodified: %d\nadded: %d\n"
        "total before: %d\ntotal after: %d\nnet change: %d\n"
        "change set: %s",
        c("removed"),
        c("modified"),
        c("added"),
        c("total_before"),
        c("total_after"),
        c("net_change"),
        F.lit(path),
    )


def update_message() -> Column:
    """Message about an applied change set, over the columns of a run report."""
    return F.format_string(
        "Corpus update\n"
        "vectors deleted: %d\ndocuments deleted: %d\npages removed: %d\n"
        "registry ids removed: %d\nitems added or updated: %d",
        F.col("deleted_vectors"),
        F.col("deleted_documents"),
        F.col("removed_pages"),
        F.col("removed_unique_ids"),
        F.col("updated_items"),
    )
