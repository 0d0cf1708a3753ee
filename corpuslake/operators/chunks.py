"""Pages -> overlapping text chunks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.functions.splitter import chunk_texts
from corpuslake.functions.text import chunk_overlap
from corpuslake.operators.common import unfold


def chunk_pages(
    pages: DataFrame,
    sizes=(C.CHUNK_SIZE,),
    text: str = "extracted_content",
    min_length: int = C.MIN_CHUNK_LENGTH,
    carry=("url", "last_updated"),
    separators=C.SEPARATORS,
    length=None,
) -> DataFrame:
    """``unique_id, carried..., text, len, general_id, chunk_size``.

    Ordinals count from 1 per page and size and are given before short chunks
    are dropped, so ids may have gaps.  Rows without text give no chunk.  All sizes
    come from one pass over the text.  ``length`` measures a piece of text (None:
    characters); ``len`` and ``min_length`` stay characters.
    """
    carried = [c for c in carry if c in pages.columns]
    wanted = F.array(*map(F.lit, sizes))
    overlaps = F.transform(wanted, chunk_overlap)
    split = chunk_texts(F.col(text), wanted, overlaps, separators, length)
    by_size = unfold(pages.select("id", *carried, text), ["id", *carried], split, "_chunks", "_size")
    sized = by_size.select("id", *carried, F.get(wanted, F.col("_size")).alias("chunk_size"), "_chunks")
    numbered = unfold(sized, ["id", *carried, "chunk_size"], F.col("_chunks"), "text", "_pos")
    return numbered.select(
        F.concat_ws("_", "id", F.col("_pos") + 1).alias("unique_id"),
        *carried,
        "text",
        F.length("text").alias("len"),
        F.col("id").alias("general_id"),
        "chunk_size",
    ).where(F.col("len") >= min_length)


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Chunk length statistics by chunk size; sizes without chunks give no row."""
    return chunks.groupBy("chunk_size").agg(
        F.count("*").alias("chunks"),
        F.min("len").alias("min_len"),
        F.max("len").alias("max_len"),
        F.avg("len").alias("mean_len"),
        F.median("len").alias("median_len"),
    )
