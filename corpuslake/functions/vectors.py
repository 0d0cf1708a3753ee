"""Column expressions over dense and sparse vectors."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake import constants as C


def clean_vector(values) -> Column:
    """NaN -> 0.1, +inf / -inf -> largest / smallest finite value."""
    big = F.lit(C.FLOAT32_MAX).cast("float")

    def fix(x):
        return (
            F.when(F.isnan(x), F.lit(C.NAN_REPLACEMENT).cast("float"))
            .when(x == F.lit(float("inf")), big)
            .when(x == F.lit(float("-inf")), -big)
            .otherwise(x)
        )

    return F.transform(values, fix)


def is_valid_vector(values) -> Column:
    """A vector that can be cleaned: present and without null elements."""
    return values.isNotNull() & ~F.exists(values, lambda x: x.isNull())


def sparse_pair(sparse) -> Column:
    """Map index -> weight as parallel arrays; null when the map is empty."""
    pair = F.struct(
        F.transform(F.map_keys(sparse), lambda k: k.cast("int")).alias("indices"),
        F.map_values(sparse).alias("values"),
    )
    return F.when(F.size(sparse) > 0, pair)


def _dot(a, b) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def metric_score(a, b, metric: str) -> Column:
    """Exact score of two equal-length vectors under an index metric."""
    if metric == "dotproduct":
        return _dot(a, b)
    if metric == "cosine":
        norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
        return F.when(norms > 0, _dot(a, b) / norms)
    if metric == "euclidean":
        gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
        return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, d: acc + d * d))
    raise ValueError(f"metric must be one of {C.METRICS}, got {metric!r}")
