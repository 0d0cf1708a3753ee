"""Sitemap text -> keyed page list."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.functions.text import local_date, strip, url_key
from corpuslake.operators.common import fold_or, keep_last, unfold


def parse_entries(
    texts: DataFrame, column: str = "value", pattern: str = C.ENTRY_PATTERN, mode: str = "compat"
) -> DataFrame:
    """One row per entry: the other columns, ``pos``, ``url``, ``lastmod``.

    ``compat`` matches over the whole text, so an entry without a date runs
    into the next one; ``strict`` matches inside each ``<url>`` element.
    """
    rest = [c for c in texts.columns if c != column]
    regex = F.lit("(?s)" + pattern)
    if mode == "compat":
        parts = F.arrays_zip(
            F.regexp_extract_all(column, regex, F.lit(1)).alias("url"),
            F.regexp_extract_all(column, regex, F.lit(2)).alias("lastmod"),
        )
    elif mode == "strict":
        opened = F.filter(F.split(column, "<url>"), lambda _, i: i > 0)
        elements = F.transform(opened, lambda part: F.concat(F.lit("<url>"), part))
        matching = F.filter(elements, lambda part: F.regexp_count(part, regex) > 0)
        parts = F.transform(
            matching,
            lambda part: F.struct(
                F.regexp_extract(part, "(?s)" + pattern, 1).alias("url"),
                F.regexp_extract(part, "(?s)" + pattern, 2).alias("lastmod"),
            ),
        )
    else:
        raise ValueError(f"mode must be compat or strict, got {mode!r}")
    return unfold(texts, rest, parts, "entry", "pos").select(
        *rest, "pos", strip("entry.url").alias("url"), strip("entry.lastmod").alias("lastmod")
    )


def not_excluded_extension(extensions=C.EXCLUDED_EXTENSIONS, url: str = "url") -> Column:
    lowered = F.lower(url)
    return ~fold_or([F.endswith(lowered, F.lit(e.lower())) for e in extensions])


def not_excluded_substring(substrings=C.EXCLUDED_SUBSTRINGS, url: str = "url") -> Column:
    return ~fold_or([F.contains(F.col(url), F.lit(s)) for s in substrings])


def included_substring(substrings=C.INCLUDED_SUBSTRINGS, url: str = "url") -> Column:
    if not substrings:
        return F.lit(True)
    return fold_or([F.contains(F.col(url), F.lit(s)) for s in substrings])


def wanted(extensions=(), exclude=(), include=(), url: str = "url") -> Column:
    """All three url filters; an empty list switches its filter off."""
    return (
        not_excluded_extension(extensions, url)
        & not_excluded_substring(exclude, url)
        & included_substring(include, url)
    )


def is_safe(base_url: str, mode: str = "compat", url: str = "url") -> Column:
    """``compat``: url starts with the base.  ``strict``: scheme and host equal too."""
    prefix = F.startswith(F.col(url), F.lit(base_url))
    if mode == "compat":
        return prefix
    if mode == "strict":
        same = [
            F.try_parse_url(F.col(url), F.lit(part)).eqNullSafe(
                F.try_parse_url(F.lit(base_url), F.lit(part))
            )
            for part in ("PROTOCOL", "AUTHORITY")
        ]
        return prefix & same[0] & same[1]
    raise ValueError(f"mode must be compat or strict, got {mode!r}")


def split_safe(entries: DataFrame, base_url: str, mode: str = "compat"):
    """(safe, unsafe): two filters over one plan."""
    flagged = entries.withColumn("is_safe", is_safe(base_url, mode))
    return (
        flagged.where("is_safe").drop("is_safe"),
        flagged.where("NOT is_safe").drop("is_safe"),
    )


def key_entries(entries: DataFrame, order: list, on_bad_date: str = "fail") -> DataFrame:
    """``id, url, last_updated``; of several entries for a url the last one stays."""
    dated = entries.select(
        url_key("url").alias("id"),
        "url",
        local_date("lastmod", on_bad_date).alias("last_updated"),
        *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order)],
    )
    if on_bad_date == "drop":
        dated = dated.where(F.col("last_updated").isNotNull())
    last = keep_last(dated, "id", [f"_o{n}" for n in range(len(order))])
    return last.select("id", "url", "last_updated")


def process_sitemap(
    texts: DataFrame,
    base_url: str,
    extensions=C.EXCLUDED_EXTENSIONS,
    exclude=C.EXCLUDED_SUBSTRINGS,
    include=C.INCLUDED_SUBSTRINGS,
    order: str = "source",
    mode: str = "compat",
    on_bad_date: str = "fail",
    pattern: str = C.ENTRY_PATTERN,
) -> DataFrame:
    """Sitemap texts (``order`` column, ``value``) to the keyed page list; ``pattern`` has url and date as groups."""
    entries = parse_entries(texts, pattern=pattern, mode=mode)
    kept = entries.where(wanted(extensions, exclude, include) & is_safe(base_url, mode))
    return key_entries(kept, [order, "pos"], on_bad_date)


def sitemap_funnel(
    texts: DataFrame,
    base_url: str,
    extensions=C.EXCLUDED_EXTENSIONS,
    exclude=C.EXCLUDED_SUBSTRINGS,
    include=C.INCLUDED_SUBSTRINGS,
    mode: str = "compat",
    pattern: str = C.ENTRY_PATTERN,
) -> DataFrame:
    """One row of counts: total, filtered, safe, unsafe; one pass."""
    flagged = parse_entries(texts, pattern=pattern, mode=mode).select(
        wanted(extensions, exclude, include).alias("keep"), is_safe(base_url, mode).alias("safe")
    )
    return flagged.agg(
        F.count("*").alias("total"),
        F.count_if("keep").alias("filtered"),
        F.count_if(F.col("keep") & F.col("safe")).alias("safe"),
        F.count_if(F.col("keep") & ~F.col("safe")).alias("unsafe"),
    )
