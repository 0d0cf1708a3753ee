"""Words of a text as the operators count them: maximal runs of non-blank ASCII-wise bytes."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed: the characters that separate words (space and U+0009 to U+000D).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def words(raw: bytes) -> list[bytes]:
    """Words of UTF-8 bytes; ``bytes.split`` parts exactly at space and 0x09-0x0D."""
    return raw.split()


def utf8_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """The test fold: crc32 of the id as text leaves 1 when divided by 3; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def least_hashed(ids: DataFrame, group: str, key: str, most: int, most_groups: int) -> DataFrame:
    """``(group, key)``: of each group the ``most`` keys of least hash, of the ``most_groups`` largest groups.

    No group is sorted whole: its size tells below which hash about twice ``most`` of its
    keys lie, and only these are ranked.  At most ``most * most_groups`` rows.
    """
    each = ids.select(group, key).distinct()
    sizes = each.groupBy(group).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), group).limit(most_groups)
    share = F.lit(2.0 * most + 100.0) / F.col("_n")
    low = each.join(F.broadcast(sizes.select(F.col(group).alias("_group"), share.alias("_share"))), F.col(group) == F.col("_group"))
    place = F.xxhash64(key).cast("double") / float(1 << 64) + 0.5
    order = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    ranked = low.where(place <= F.col("_share")).select(group, key, F.row_number().over(order).alias("_rank"))
    return ranked.where(F.col("_rank") <= most).select(group, key)
