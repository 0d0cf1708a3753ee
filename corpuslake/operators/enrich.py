"""Page list + crawl snapshot -> pages with extracted text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.functions.html import extract_text
from corpuslake.operators.common import keep_last


def lookup_html(
    pages: DataFrame, crawl: DataFrame, drop_missing: bool = False, latest_by: str | None = None
) -> DataFrame:
    """Adds ``html_content`` from a crawl snapshot ``(url, html)``; null if absent.

    A url fetched several times gives one page: the fetch that is last by
    ``latest_by`` (``fetched_at`` where the crawl has it), then one with html, then the
    one whose html has the greatest hash.  A whole crawl is reduced to one fetch a url
    before and in the one exchange it takes.  ``drop_missing`` (update runs) joins inner,
    which lets a small page list be the hashed side instead of shuffling the crawl; there
    the choice is made on the narrow columns and the html itself is only joined.
    """
    order = latest_by or ("fetched_at" if "fetched_at" in crawl.columns else None)
    rank = [F.col(order).alias("at")] if order else []
    rank += [F.col("html").isNotNull().alias("some"), F.xxhash64("html").alias("mark")]
    fetched = crawl.select("url", F.col("html").alias("html_content"), F.struct(*rank).alias("_fetch"))
    if not drop_missing:
        one = keep_last(fetched.where(F.col("url").isNotNull()), "url", ["_fetch"])
        return pages.join(one, "url", "left").select(*pages.columns, "html_content")
    fetched = fetched.where(F.col("html_content").isNotNull()).join(pages.select("url"), "url", "left_semi")
    last = fetched.groupBy("url").agg(F.max("_fetch").alias("_last"))
    one = fetched.join(last, "url").where(F.col("_fetch").eqNullSafe(F.col("_last")))
    one = one.select("url", "html_content").dropDuplicates(["url"])
    joined = pages.join(one, "url", "inner")
    return joined.select(*pages.columns, "html_content")


def drop_null_html(pages: DataFrame) -> DataFrame:
    return pages.dropna(subset=["html_content"])


def add_extracted(
    pages: DataFrame, titles=C.TITLE_SELECTORS, bodies=C.BODY_SELECTORS
) -> DataFrame:
    """Adds ``extracted_title`` and ``extracted_content``."""
    text = extract_text(F.col("html_content"), titles, bodies)
    return pages.withColumn("_text", text).select(
        *pages.columns, "_text.extracted_title", "_text.extracted_content"
    )


def drop_placeholders(pages: DataFrame) -> DataFrame:
    """Drops pages where neither title nor body was found."""
    empty = f"{C.TITLE_PLACEHOLDER} {C.BODY_PLACEHOLDER}"
    return pages.where(~F.col("extracted_content").eqNullSafe(F.lit(empty)))


def drop_incomplete(pages: DataFrame) -> DataFrame:
    return pages.dropna(subset=["html_content", "extracted_content"])


def enrich_pages(
    pages: DataFrame,
    crawl: DataFrame,
    titles=C.TITLE_SELECTORS,
    bodies=C.BODY_SELECTORS,
    drop_null: bool = False,
    latest_by: str | None = None,
) -> DataFrame:
    """Keyed page list -> enriched pages (the update run drops failed fetches first)."""
    found = lookup_html(pages, crawl, drop_null, latest_by)
    return drop_placeholders(add_extracted(found, titles, bodies))


def null_audit(df: DataFrame) -> DataFrame:
    """One row per column with its null count; one pass, one row aggregated."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.inline(pairs))
