"""Column expressions over text, all JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake import constants as C


def strip(text) -> Column:
    """Trim all Unicode white space (``trim`` alone removes only blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_whitespace(text) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def words(text) -> Column:
    """White-space separated words, without empty ones."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def tokens(text) -> Column:
    """Lower-cased words."""
    return words(F.lower(text))


def url_key(url) -> Column:
    """Key of a page: hex md5 of the UTF-8 url."""
    return F.md5(url)




# Date, time and offset of a last-modified stamp such as 2024-03-01T00:30:00+02:00.
_STAMP = (
    r"^(\d{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12]\d|0?[1-9]))"
    r"T(?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d"
    r"(?:Z|[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?)$"
)


def local_date(stamp, on_bad_date: str = "fail") -> Column:
    """Calendar date of a stamp in the stamp's own offset (never shifted to UTC).

    A malformed stamp raises with ``on_bad_date='fail'`` and is null otherwise.
    """
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    day = F.to_date(F.try_to_timestamp(F.regexp_extract(stamp, _STAMP, 1), F.lit("y-M-d")))
    if on_bad_date == "fail":
        problem = F.concat(F.lit("not a timestamp with offset: "), F.coalesce(stamp, F.lit("null")))
        return F.coalesce(day, F.raise_error(problem).cast("date"))
    if on_bad_date in ("null", "drop"):
        return day
    raise ValueError(f"on_bad_date must be fail, null or drop, got {on_bad_date!r}")


def chunk_overlap(size) -> Column:
    """Overlap that goes with a chunk size column."""
    size = F.col(size) if isinstance(size, str) else size
    return F.when(size <= C.SMALL_CHUNK_LIMIT, C.SMALL_CHUNK_OVERLAP).otherwise(
        C.LARGE_CHUNK_OVERLAP
    )


def parent_id(unique_id) -> Column:
    """Page id inside a chunk id ``<page id>_<ordinal>``."""
    return F.substring_index(unique_id, "_", 1)
