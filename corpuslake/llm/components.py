"""Connected components of an undirected graph by alternating star contraction.

Each round replaces every edge by edges to smaller neighbours (large star, then
small star), so long chains shorten by halves; the graph ends as one star per
component.  All state is edges in reliable checkpoints; the driver sees two
numbers per round.  Stars with many leaves are joins on one key whose other side
has a single row, which adaptive execution splits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.sources.scratch import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of an edge ``(u, v)``; component is the least node.

    Loops and repeated edges are allowed; an edge with a null end is ignored.
    """
    edges = checkpointed(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        edges = checkpointed(_small_star(_large_star(edges)))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
