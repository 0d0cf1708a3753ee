"""Near-duplicate embeddings by product quantisation with inverted lists.

Unit vectors are assigned to coarse lists; what is left of a vector after its list's
centroid is coded per subspace.  A query looks into every list that can hold a vector
within the link distance (the bisecting plane between the two centroids must be that
near), so the probes are sufficient, not a guess.  Inside a list, distances come from
per-subspace lookup tables; as each stored vector keeps the length of its coding
error, the triangle inequality discards only what cannot link.  The rest is measured
exactly, as a cosine in double precision.

Equal vectors of a label are one entry with a count.  Long lists are stored in salts;
a task holds one salt of one list and streams its queries, counts links, and gives
out a spanning forest of what it linked, never the pairs.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.components import connected_components
from corpuslake.sources.scratch import checkpointed

LEAST = 0.98
SAMPLE = 8192  # vectors that the codebooks are fitted to
MOST_LISTS = 1024
LIST_ROWS = 4096  # about so many vectors per list, and at most about so many per salt of a list
SUBSPACES = 8
CODES = 64
SHARES = 4  # tasks that a salt's queries are dealt to
BLOCK_ROWS = 2048  # vectors assigned to lists at once
QUERY_ROWS = 256  # queries measured against a salt at once
_SLACK = 1e-6  # room for rounding where vectors are discarded


@dataclass
class Codebooks:
    centroids: np.ndarray  # (lists, dims)
    words: np.ndarray  # (subspaces, codes, dims of a subspace)
    distances: np.ndarray | None = None

    @property
    def width(self) -> int:
        return self.words.shape[0] * self.words.shape[2]

    def between(self) -> np.ndarray:
        """Distances of the centroids from each other, worked out once per task."""
        if self.distances is None:
            self.distances = np.sqrt(_squares(self.centroids, self.centroids))
        return self.distances

    def pad(self, x: np.ndarray) -> np.ndarray:
        """Vectors of any length, cut or filled with zeros only for coding; distances stay exact elsewhere."""
        if x.shape[1] >= self.width:
            return x[:, : self.width]
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres, without an array of their differences."""
    found = (x**2).sum(1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(1)
    return np.maximum(found, 0.0, out=found)


def _blocks(lengths: np.ndarray):
    """Places of vectors of one length, at most BLOCK_ROWS at a time."""
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        for k in range(0, len(at), BLOCK_ROWS):
            yield at[k : k + BLOCK_ROWS]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * (x @ centres.T), axis=1)


def _kmeans(x: np.ndarray, k: int, turns: int, rng) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(turns):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(distinct: DataFrame, rows: int, sample: int = SAMPLE) -> Codebooks | None:
    """Codebooks from the ``sample`` vectors of column ``vector`` with the smallest hash; None without any."""
    drawn = distinct.select("vector").orderBy(F.xxhash64("vector"), F.hash("vector")).limit(sample).toArrow()
    vectors = drawn.column("vector").to_pylist()
    if not vectors:
        return None
    dims = max(map(len, vectors))
    width = -(-dims // SUBSPACES) * SUBSPACES
    x = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        x[k, : len(v)] = v
    x /= np.linalg.norm(x, axis=1)[:, None]
    rng = np.random.default_rng(0)
    lists = max(1, min(MOST_LISTS, len(x) // 4, -(-rows // LIST_ROWS)))
    centroids = _kmeans(x, lists, 12, rng)
    rest = (x - centroids[_nearest(x, centroids)]).reshape(len(x), SUBSPACES, -1)
    words = [_kmeans(np.ascontiguousarray(rest[:, m]), CODES, 8, rng) for m in range(SUBSPACES)]
    return Codebooks(centroids, np.stack(words))


def _able():
    """Label and all components given, components finite and not all zero."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & some, F.lit(False))


def usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)`` of the rows that can link."""
    return rows.where(_able()).select("vec_id", "label", F.col("embedding").alias("vector"))


def _matrix(vectors: list[list[float]]) -> np.ndarray:
    return np.array(vectors, dtype=np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors without overflow or loss for very large or small components."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _assigned(classes: DataFrame, books: Codebooks, link: float) -> DataFrame:
    """Per class its own list, codes and coding error, and the lists it has to ask."""
    shared = classes.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("struct<list: int, codes: binary, error: double, probes: array<int>>")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        model = shared.value
        out = {"list": [], "codes": [], "error": [], "probes": []}
        lengths = vectors.map(len).to_numpy()
        result = pd.DataFrame(index=range(len(vectors)), columns=list(out), dtype=object)
        between = model.between()
        for at in _blocks(lengths):
            full = _unit(np.stack([np.asarray(vectors.iloc[k], dtype=np.float64) for k in at]))
            x = model.pad(full)
            squares = _squares(x, model.centroids)
            own = squares.argmin(1)
            nearest = squares[np.arange(len(x)), own]
            reach = (squares - nearest[:, None]) <= 2 * (link + _SLACK) * between[own]
            reach[np.arange(len(x)), own] = True
            rest = (x - model.centroids[own]).reshape(len(x), SUBSPACES, -1)
            codes = np.stack([_nearest(rest[:, m], model.words[m]) for m in range(SUBSPACES)], axis=1)
            coded = np.stack([model.words[m][codes[:, m]] for m in range(SUBSPACES)], axis=1)
            errors = np.linalg.norm((rest - coded).reshape(len(x), -1), axis=1)
            for row, k in enumerate(at):
                result.iloc[k] = [int(own[row]), codes[row].astype(np.uint8).tobytes(), float(errors[row]),
                                  np.flatnonzero(reach[row]).astype(np.int32)]
        return result.astype({"list": np.int32, "error": np.float64})

    return classes.withColumn("at", assign.asNondeterministic()(F.col("vector"))).select(
        "class", "label", F.size("vector").alias("dims"), "n", "vector", "at.*"
    )


class _Salt:
    """Stored vectors of one salt of a list, and the forest of links found so far."""

    def __init__(self, books: Codebooks, place: int, link: float, least: float):
        self.books, self.place, self.link, self.least = books, place, link, least
        self.rows = []

    def add(self, row):
        self.rows.append(row)

    def close(self):
        self.ids = np.array([r[0] for r in self.rows], dtype=np.int64)
        self.n = np.array([r[1] for r in self.rows], dtype=np.int64)
        self.units = _unit(_matrix([r[2] for r in self.rows]))
        self.codes = np.frombuffer(b"".join(r[3] for r in self.rows), np.uint8).reshape(len(self.rows), SUBSPACES)
        self.errors = np.array([r[4] for r in self.rows])
        self.tree = np.arange(len(self.rows))
        self.rows = None

    def ask(self, ids, vectors):
        """Links per query, and new edges of the forest."""
        x = _unit(_matrix(vectors))
        rest = (self.books.pad(x) - self.books.centroids[self.place]).reshape(len(x), SUBSPACES, -1)
        squares = np.zeros((len(x), len(self.ids)), dtype=np.float32)
        for m in range(SUBSPACES):
            words = self.books.words[m]
            table = ((rest[:, m][:, None] - words[None]) ** 2).sum(2).astype(np.float32)
            squares += table[:, self.codes[:, m]]
        maybe = np.sqrt(squares) <= self.link + self.errors[None] + 1e-4
        counts, edges = np.zeros(len(x), dtype=np.int64), []
        for k in np.flatnonzero(maybe.any(1)):
            near = np.flatnonzero(maybe[k])
            near = near[self.units[near] @ x[k] >= self.least]
            near = near[self.ids[near] != ids[k]]
            if len(near):
                counts[k] = self.n[near].sum()
                trees, at = np.unique(self.tree[near], return_index=True)
                edges += [(ids[k], self.ids[j]) for j in near[at]]
                if len(trees) > 1:
                    self.tree[np.isin(self.tree, trees)] = trees[0]
        return counts, edges


def _search(assigned: DataFrame, books: Codebooks, link: float, least: float) -> DataFrame:
    """``(class, links)`` partial counts, and edges ``(u, v)``, from every salt of every list."""
    shared = assigned.sparkSession.sparkContext.broadcast(books)
    sizes = assigned.groupBy("label", "dims", "list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("salts"))
    stored = assigned.join(sizes, ["label", "dims", "list"])
    stored = stored.select(
        "label", "dims", "list", F.pmod(F.xxhash64("class"), "salts").cast("int").alias("salt"),
        F.lit(0).alias("kind"), "class", "n", "vector", "codes", "error",
    )
    asking = assigned.select("label", "dims", F.explode("probes").alias("list"), "class", "vector")
    asking = asking.join(sizes, ["label", "dims", "list"])
    asking = asking.select(
        "label", "dims", "list", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(1).alias("kind"), "class", F.lit(None).cast("long").alias("n"), "vector",
        F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"),
    )
    key = ["label", "dims", "list", "salt"]
    parts = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Queries of one salt are dealt to several tasks by their own hash; each also gets the salt's stored rows.
    spread = F.lit(SHARES)
    asking = asking.withColumn("share", F.pmod(F.xxhash64("class", F.lit(1)), spread).cast("int"))
    stored = stored.select("*", F.explode(F.sequence(F.lit(0), spread - 1)).alias("share"))
    rows = stored.unionByName(asking).repartition(parts, *key, "share")
    rows = rows.sortWithinPartitions(*key, "share", "kind", "class")

    def run(batches):
        here, salt, waiting = None, None, []
        found = []

        def flush():
            nonlocal waiting
            if waiting:
                counts, edges = salt.ask(np.array([r[0] for r in waiting], dtype=np.int64), [r[1] for r in waiting])
                found.extend((int(r[0]), int(c), None, None) for r, c in zip(waiting, counts) if c)
                found.extend((None, None, int(u), int(v)) for u, v in edges)
                waiting = []

        def batch_out():
            columns = list(zip(*found)) if found else [()] * 4
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["class", "links", "u", "v"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in
                       ("label", "dims", "list", "salt", "share", "kind", "class", "n", "vector", "codes", "error")]
            for label, dims, place, part, share, kind, number, n, vector, codes, error in zip(*columns):
                if (label, dims, place, part, share) != here:
                    flush()
                    here, salt = (label, dims, place, part, share), _Salt(shared.value, place, link, least)
                if kind == 0:
                    salt.add((number, n, vector, codes, error))
                else:
                    if salt.rows is not None:
                        if not salt.rows:
                            continue
                        salt.close()
                    waiting.append((number, vector))
                    if len(waiting) >= QUERY_ROWS:
                        flush()
            yield batch_out()
        flush()
        yield batch_out()

    return rows.mapInArrow(run, "class long, links long, u long, v long")


def embedding_groups(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``rows (vec_id, embedding, label)``.

    Rows link when their labels are equal and not null, their vectors equally long and
    their cosine at least ``least``.  A null, empty or zero vector, or one with a null
    or non-finite component, links with nothing; a row that links with nothing is its
    own component.  Repeated rows link with each other.  ``component_id`` is the
    smallest id reached; rows with a null id are counted as links but give a component
    no id, and are never kept.
    """
    link = float(np.sqrt(2 - 2 * least))
    # Numbers are given after the rows are fixed in storage, and fixed there in turn.
    classes = checkpointed(
        usable(rows).groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    )
    classes = checkpointed(classes.withColumn("class", F.monotonically_increasing_id()))
    books = fit(classes, classes.count())
    alone = rows.where(~_able()).select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("reached"))
    if books is None:
        return _report(alone)
    assigned = checkpointed(_assigned(classes, books, link))
    found = checkpointed(_search(assigned, books, link, least))
    links = found.where("class is not null").groupBy("class").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select("u", "v")).withColumnsRenamed({"node": "class", "component": "group"})
    known = (
        classes.select("label", "vector", "class", "n", "least_id")
        .join(links, "class", "left")
        .join(labels, "class", "left")
        .withColumn("group", F.coalesce("group", "class"))
    )
    least_ids = known.groupBy("group").agg(F.min("least_id").alias("reached"))
    known = known.join(least_ids, "group").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "reached",
    )
    able = usable(rows)
    with_class = able.join(known, (able["label"] == known["_label"]) & (able["vector"] == known["_vector"]))
    return _report(with_class.select("vec_id", "links", "reached").unionByName(alone))


def _report(rows: DataFrame) -> DataFrame:
    reached = F.col("reached").cast("long")
    return rows.select(
        "vec_id", F.col("links").cast("long").alias("n_links"), reached.alias("component_id"),
        F.coalesce(F.col("vec_id") == reached, F.lit(False)).alias("kept"),
    )
