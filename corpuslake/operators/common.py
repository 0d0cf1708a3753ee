"""Small relational building blocks shared by the operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: str, order: list) -> DataFrame:
    """One row per key: the greatest by ``order``.

    An aggregate, not a window: it combines before the shuffle, so a key that
    holds a third of the rows costs one partial row per task.
    """
    rest = [c for c in df.columns if c != key]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranked = F.struct(*[c.alias(f"o{n}") for n, c in enumerate(order)])
    payload = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(key).agg(F.max_by(payload, ranked).alias("_row"))
    return best.select(*[F.col(key) if c == key else F.col(f"_row.{c}") for c in df.columns])


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append by name; a column missing on one side is null there."""
    return first.unionByName(second, allowMissingColumns=True)


def fold_or(tests: list[Column]) -> Column:
    found = F.lit(False)
    for test in tests:
        found = found | test
    return found


def unfold(df: DataFrame, keep: list, array: Column, value: str, pos: str | None = None) -> DataFrame:
    """One row per non-null array element: kept columns, ``pos`` if named, ``value``.

    The inner ``explode`` makes the optimizer filter on the size of its input,
    which evaluates a costly array expression a second time; the outer form
    followed by a null filter does not.
    """
    if pos is None:
        rows = df.select(*keep, F.explode_outer(array).alias(value))
    else:
        rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return rows.where(F.col(value).isNotNull())


def hashed(df: DataFrame, *keys: str) -> DataFrame:
    """Whole rows dealt to all shuffle partitions by key, so that counting below a key needs no exchange of its own."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def single(df: DataFrame, column: str) -> Column:
    """Value of a one-row frame as a scalar subquery."""
    return df.select(column).scalar()
