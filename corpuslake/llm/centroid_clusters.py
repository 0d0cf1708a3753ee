"""Centroid clustering in exact integers, with centroids discarded by rotated bounds.

Vectors become integers, so sums, means and squared distances are exact and do not depend
on how Spark deals the rows.  The vectors' covariance, summed over all of them, gives a
rotation; each vector is stored with its leading rotated coordinates and the length of
what is left of it.  For a centroid c the squared distance of the leading coordinates plus
the squared difference of the two residual lengths never exceeds the squared distance, so
a centroid whose bound lies above the distance to the most promising one cannot win.
The survivors, ties among them, are measured in integers.

Each task sums its vectors per cluster; Spark adds up the sums, and a round brings
``k * dims`` numbers to the driver, whatever the number of vectors.

A vector takes part if it has exactly ``dims`` components, none of them null or not finite;
others, and null vectors, give no row.  A component beyond +-2^26 after scaling counts as
that limit, so that every squared distance fits a long.  Repeated rows are vectors of their
own; rows with one id and equal first hash start in the order of their vectors; a null id
hashes as the empty string.  With fewer vectors than ``k`` there are so many clusters.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.sources.scratch import checkpointed

DIMS = 64
SCALE = 64
K = 16
ROUNDS = 3
SEED = 1
LEADING = 12  # rotated coordinates that are stored
LIMIT = 1 << 26  # greatest size of an integer component
_LONG = (1 << 63) - 1
_SLACK = 1e-9  # room for rounding of the bounds, relative to the squared lengths
_ROWS = 2048  # vectors worked on at once: k * _ROWS bounds and at most as many differences


@dataclass
class Rotation:
    mean: np.ndarray
    axes: np.ndarray  # (leading, dims), orthonormal

    def of(self, x: np.ndarray):
        """Leading coordinates and length of the rest, of vectors as rows."""
        y = x - self.mean
        lead = y @ self.axes.T
        return lead, np.sqrt(np.maximum((y**2).sum(1) - (lead**2).sum(1), 0.0))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the vectors that take part, as ``floor(scale * component)``."""
    value = F.col("embedding").cast("array<double>")
    fit = (F.size(value) == dims) & F.forall(
        value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    limit = F.lit(float(LIMIT))
    whole = F.transform(value, lambda v: F.floor(F.greatest(F.least(v * scale, limit), -limit)).cast("int"))
    return vectors.where(F.coalesce(fit, F.lit(False))).select("vec_id", whole.alias("x"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors of least hash, in its order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.select(digest.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in chosen], np.int64)


def fit_rotation(rows: DataFrame, dims: int, leading: int = LEADING) -> Rotation:
    """Leading axes of the covariance of all vectors: every task gives one matrix, Spark adds them up."""

    def moments(batches):
        n, total, square = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), np.float64)
            if len(x):
                n, total, square = n + len(x), total + x.sum(0), square + x.T @ x
        values = np.concatenate([[n], total, square.ravel()])
        yield pa.record_batch({"at": pa.array(np.arange(len(values))), "value": pa.array(values)})

    sums = rows.select("x").mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    values = np.zeros(1 + dims + dims * dims)
    for r in sums.collect():  # 1 + dims + dims^2 numbers
        values[r["at"]] = r["value"]
    n = max(values[0], 1.0)
    mean = values[1 : 1 + dims] / n
    covariance = values[1 + dims :].reshape(dims, dims) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh(covariance)
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading].T))


def with_rotated(rows: DataFrame, rotation: Rotation) -> DataFrame:
    """Adds ``lead`` (leading rotated coordinates) and ``rest`` (length of the residual)."""

    def rotate(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lead, rest = rotation.of(_matrix(batch.column(1), np.float64))
            flat = pa.array(lead.ravel())
            edges = pa.array(np.arange(0, lead.size + 1, lead.shape[1], dtype=np.int32))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(edges, flat), pa.array(rest)],
                names=["vec_id", "x", "lead", "rest"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(rotate, f"vec_id {kind}, x array<int>, lead array<double>, rest double")


class Nearest:
    """Exact nearest centroid; ``measured`` counts the distances that were worked out."""

    def __init__(self, centroids: np.ndarray, rotation: Rotation):
        self.centroids = centroids
        self.lead, self.rest = rotation.of(centroids.astype(np.float64))
        shifted = ((centroids - rotation.mean) ** 2).sum(1)
        self.slack = _SLACK * float(shifted.max(initial=0.0))
        self.measured = 0

    def _distance(self, x, c):
        self.measured += len(x)
        return ((x - self.centroids[c]) ** 2).sum(1)

    def __call__(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray):
        """``(cluster, squared distance)`` of integer vectors; of equally near centroids the smallest number."""
        bound = ((lead[:, None, :] - self.lead[None]) ** 2).sum(2) + (rest[:, None] - self.rest[None]) ** 2
        promising = bound.argmin(1)
        best = self._distance(x, promising)
        room = self.slack + _SLACK * ((lead**2).sum(1) + rest**2) + _SLACK
        alive = bound <= (best + room)[:, None]
        alive[np.arange(len(x)), promising] = False
        row, other = np.nonzero(alive)
        distance = np.full(bound.shape, _LONG)
        distance[np.arange(len(x)), promising] = best
        distance[row, other] = self._distance(x[row], other)
        cluster = distance.argmin(1)  # the first of equal ones
        return cluster, distance[np.arange(len(x)), cluster]


def _assigned_blocks(batches, centroids, rotation):
    """``(vec_id, x, cluster, distance)`` of the stored vectors, block by block."""
    nearest = Nearest(centroids, rotation)
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            x = _matrix(part.column(1), np.int64)
            lead, rest = _matrix(part.column(2), np.float64), part.column(3).to_numpy()
            yield part.column(0), x, *nearest(x, lead, rest)


def _sums(stored: DataFrame, centroids: np.ndarray, rotation: Rotation):
    """Per cluster that has vectors: their number and the sums of their components."""

    def partial(batches):
        k, dims = centroids.shape
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x, cluster, _ in _assigned_blocks(batches, centroids, rotation):
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            held, first = np.unique(cluster[order], return_index=True)
            sums[held] += np.add.reduceat(x[order], first, axis=0)
        held = np.flatnonzero(counts)
        table = np.concatenate([counts[held, None], sums[held]], 1)
        yield pa.record_batch(
            {
                "cluster": pa.array(np.repeat(held, dims + 1)),
                "at": pa.array(np.tile(np.arange(dims + 1), len(held))),
                "value": pa.array(table.ravel()),
            }
        )

    parts = stored.mapInArrow(partial, "cluster long, at long, value long")
    total = parts.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {}
    for r in total.collect():  # k * (dims + 1) numbers
        found.setdefault(r["cluster"], {})[r["at"]] = int(r["value"])
    return found


def clusters(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.

    ``rounds`` times all vectors go to their nearest centroid, and every centroid that has
    vectors becomes their mean, rounded down; at last the vectors are assigned once more.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, dims, scale)
    centroids = first_centroids(rows, k, seed)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        none = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], none)
    rotation = fit_rotation(rows, dims)
    stored = checkpointed(with_rotated(rows, rotation))
    for _ in range(rounds):
        for number, values in _sums(stored, centroids, rotation).items():
            centroids[number] = [values[at] // values[0] for at in range(1, dims + 1)]

    final = centroids.copy()

    def assign(batches):
        for ids, _, cluster, distance in _assigned_blocks(batches, final, rotation):
            yield pa.record_batch([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = checkpointed(stored.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    as_long = lambda c: F.least(c, F.lit(_LONG)).cast("long")
    per_cluster = assigned.groupBy("cluster").agg(wide.alias("sum"))
    every = assigned.agg(as_long(wide).alias("inertia"))
    marks = pd.DataFrame(
        {"cluster": range(len(final)), "components": [",".join(map(str, c)) for c in final.tolist()]}
    )
    marks = spark.createDataFrame(marks, "cluster int, components string")
    facts = per_cluster.join(F.broadcast(marks), "cluster").select(
        "cluster",
        as_long(F.col("sum")).alias("cluster_inertia"),
        every.scalar().alias("inertia"),
        F.sha2("components", 256).alias("centroid_sha256"),
    )
    # At most k rows.
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
