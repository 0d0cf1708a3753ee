"""Document fingerprints: SimHash over weighted terms, found again by permuted block tables.

Terms are words and runs of five words; a term's weight grows with the logarithm of
its count, runs weigh four times as much.  Every term's hash votes with its weight on
each of 128 signed bits.

The search cuts the bits into blocks.  Two fingerprints within the radius agree in all
but ``radius`` blocks, so with a table for every choice of ``blocks - radius`` blocks
to come first they meet in at least one table; a pair counts in the first table in
which it meets, and its distance is checked in full.
"""

from hashlib import sha256
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.words import words
from corpuslake.sources.scratch import checkpointed

BITS = 128
RUN = 5
RUN_WEIGHT = 4.0
RADIUS = 3
BLOCKS = 5
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") * 2.0 - 1.0
_LOWEST = -(1 << 63)


def _stir(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _terms(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes of a text and their weights."""
    found = words(raw.lower())
    if not found:
        return np.empty(0, "u8"), np.empty(0)
    single = np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(0)), dtype="u8", count=len(found))
    span = min(RUN, len(found))
    run = np.zeros(len(found) - span + 1, dtype="u8")
    for k in range(span):
        run = _stir(run, k + 1) + single[k : k + len(run)]
    hashes, weights = [], []
    for values, scale in ((single, 1.0), (_stir(run, RUN), RUN_WEIGHT)):
        distinct, n = np.unique(values, return_counts=True)
        hashes.append(distinct)
        weights.append(scale * np.log2(1.0 + n))
    return np.concatenate(hashes), np.concatenate(weights)


def fingerprint(raw: bytes) -> bytes:
    """16 bytes; no words give zeros, equal texts give equal bytes."""
    hashes, weights = _terms(raw)
    if not len(hashes):
        return bytes(BITS // 8)
    wide = np.stack([_stir(hashes, 0x9E3779B97F4A7C15), _stir(hashes, 0xD1B54A32D192ED03)], axis=1)
    lanes = np.ascontiguousarray(wide.view(np.uint8).reshape(len(hashes), BITS // 8).T)
    votes = [np.bincount(lane, weights=weights, minlength=256) @ _SIGNS for lane in lanes]
    return np.packbits(np.concatenate(votes) > 0, bitorder="little").tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """The cosine that the share of differing bits stands for, 0 for right angles and beyond; equal gives 1."""
    apart = (int.from_bytes(one, "little") ^ int.from_bytes(other, "little")).bit_count()
    return max(0.0, float(np.cos(np.pi * apart / BITS))) if apart else 1.0


def _halves(value: bytes) -> tuple[int, int]:
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows of ``docs`` in buckets of consecutive ids, each followed by the row that comes next.

    The bounds are the first ids of a range partitioning of the ids alone, as many as
    there are shuffle partitions.  A bucket's first row also goes to the bucket before
    it (the first bucket's to the last), marked as tail.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"),
    ).withColumn("hash", F.xxhash64("text"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"))
    ranged = ids.repartitionByRange(parts, "key").select("key", F.spark_partition_id().alias("part"))
    firsts = sorted(r["first"] for r in ranged.groupBy("part").agg(F.min("key").alias("first")).collect())
    bounds = np.array(firsts, dtype=np.int64)

    @F.pandas_udf("struct<bucket: int, before: int>")
    def place(keys):
        import pandas as pd

        values = keys.to_numpy(dtype=np.int64)
        bucket = np.searchsorted(bounds, values, side="right") - 1
        before = np.where(bounds[bucket] == values, (bucket - 1) % len(bounds), -1)
        return pd.DataFrame({"bucket": bucket, "before": before})

    own = F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("tail"))
    next_of = F.struct(F.col("at.before").alias("bucket"), F.lit(True).alias("tail"))
    places = F.when(F.col("at.before") >= 0, F.array(own, next_of)).otherwise(F.array(own))
    rows = rows.withColumn("at", place.asNondeterministic()(F.col("key")))
    rows = rows.select("doc_id", "text", "key", "hash", F.explode(places).alias("to"))
    return rows.select("doc_id", "text", "key", "hash", "to.bucket", "to.tail"), max(1, len(firsts))


_RESULT = (
    "n_chars long, edited_sha256 string, fp_a long, fp_b long, edited_a long, edited_b long, "
    "near_edited double, near_next double"
)


def with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of each row's text and of its edited text, and how alike they are.

    The edited text is the text with its last quarter (in code points, rounded down)
    replaced by as many code points from the start of the next row's text, or all of
    it.  Rows follow each other by id, nulls first, then by text hash; the first
    follows the last.  Null text is empty.  Columns ``doc_id`` and those of
    ``_RESULT``; other columns of ``docs`` are not read.
    """
    rows, buckets = _bucketed(docs)
    dealt = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "tail", "key", "hash")

    def run(batches):
        held, closed, kind = None, False, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            out = []
            texts = batch.column("text").to_pylist()
            for doc_id, text, tail in zip(batch.column("doc_id").to_pylist(), texts, batch.column("tail").to_pylist()):
                if closed:
                    break
                mark = fingerprint(text.encode("utf-8"))
                if held is not None:
                    own_id, own, own_mark = held
                    cut = len(own) // 4
                    edited = (own[: len(own) - cut] + text[:cut]).encode("utf-8")
                    edited_mark = own_mark if not cut else fingerprint(edited)
                    out.append(
                        (own_id, len(own), sha256(edited).hexdigest(), *_halves(own_mark), *_halves(edited_mark),
                         likeness(own_mark, edited_mark), likeness(own_mark, mark))
                    )
                held, closed = (doc_id, text, mark), tail
            columns = list(zip(*out)) if out else [()] * 9
            kinds = [kind, pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fp_a", "fp_b", "edited_a", "edited_b", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    kind = dict(docs.dtypes)["doc_id"]
    return dealt.select("doc_id", "text", "tail").mapInArrow(run, f"doc_id {kind}, {_RESULT}")


def fingerprint_text(a: Column, b: Column) -> Column:
    """32 lowercase hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def _tables(radius: int, blocks: int) -> list[tuple[int, int]]:
    """Mask of the bits that come first, as two signed halves, for every choice of blocks."""
    edges = [k * BITS // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in chosen)
        masks.append(_halves(mask.to_bytes(BITS // 8, "little")))
    return masks


def count_within(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each distinct ``(fp_a, fp_b)`` of ``queries``: ``n_within``, the rows of ``fingerprints`` within ``radius``.

    Equal fingerprints are counted as one with their number of rows.  Fingerprints
    without a null only; all rows count, the query's own included.
    """
    masks = _tables(radius, blocks)
    table = F.array(*[F.struct(F.lit(k).alias("t"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                      for k, (a, b) in enumerate(masks)])

    def keyed(rows: DataFrame) -> DataFrame:
        rows = rows.select("*", F.explode(table).alias("m"))
        return rows.select(
            *[c for c in rows.columns if c != "m"], F.col("m.t").alias("t"),
            F.col("fp_a").bitwiseAND(F.col("m.a")).alias("key_a"), F.col("fp_b").bitwiseAND(F.col("m.b")).alias("key_b"),
        )

    stored = keyed(fingerprints.groupBy("fp_a", "fp_b").agg(F.count("*").alias("n"))).withColumnsRenamed(
        {"fp_a": "o_a", "fp_b": "o_b"}
    )
    asked = keyed(queries.select("fp_a", "fp_b").distinct())
    apart_a, apart_b = F.col("fp_a").bitwiseXOR(F.col("o_a")), F.col("fp_b").bitwiseXOR(F.col("o_b"))
    near = F.bit_count(apart_a) + F.bit_count(apart_b) <= radius
    first = F.lit(None)
    for k, (a, b) in reversed(list(enumerate(masks))):
        same = (apart_a.bitwiseAND(F.lit(a).cast("long")) == 0) & (apart_b.bitwiseAND(F.lit(b).cast("long")) == 0)
        first = F.when(same, k).otherwise(first)
    asked, stored = asked.alias("q"), stored.alias("s")
    met = (
        (F.col("q.t") == F.col("s.t"))
        & (F.col("q.key_a") == F.col("s.key_a"))
        & (F.col("q.key_b") == F.col("s.key_b"))
        & near
        & (first == F.col("q.t"))
    )
    return asked.join(stored, met).groupBy("fp_a", "fp_b").agg(F.sum("n").alias("n_within"))


def fingerprint_report(docs: DataFrame, every: int = 20) -> DataFrame:
    """Result of ``with_edited`` and ``n_near``: for ids divisible by ``every``, the other rows within the radius."""
    marked = checkpointed(with_edited(docs))
    asked = marked.where(F.col("doc_id") % every == 0)
    counts = count_within(marked.select("fp_a", "fp_b"), asked).withColumnsRenamed({"fp_a": "q_a", "fp_b": "q_b"})
    same = (F.col("fp_a") == F.col("q_a")) & (F.col("fp_b") == F.col("q_b")) & (F.col("doc_id") % every == 0)
    return marked.join(counts, same, "left").select(
        *marked.columns, (F.col("n_within") - 1).alias("n_near")
    )
