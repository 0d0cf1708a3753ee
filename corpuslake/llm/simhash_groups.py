"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A 64-bit fingerprint takes the majority of its shingles' hash bits.  For radius r
every bit position gets a vector over GF(2) of r + 1 bits; each of the 2**(r+1) - 1
non-zero vectors v gives one table whose mask holds the positions not orthogonal to
v.  At most r differing positions never span the space, so some v is orthogonal to
all of them: every pair within the radius is equal under some mask.

Distinct fingerprints that meet another one in some table are then linked exactly
without listing pairs: each is sent to every value that differs in at most r/2 bits
(a hub).  Two fingerprints lie within r if and only if they share a hub, and a hub
never has more members than it has neighbours, so hot groups stay small.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.components import connected_components
from corpuslake.llm.words import utf8_list, words
from corpuslake.sources.scratch import checkpointed

BITS = 64
SHINGLE = 3
SEED = 42
RADIUS = 2
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 text; A-Z count as a-z; no words give zero."""
    found = words(raw.lower())
    if not found:
        return 0
    if len(found) < shingle:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[k:] for k in range(shingle)))))
    n = len(shingles)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    lanes = np.ascontiguousarray(hashes.view(np.uint8).reshape(n, 8).T)
    votes = [np.bincount(lane, minlength=256) @ _BYTE_BITS for lane in lanes]
    bits = 2 * np.concatenate(votes) > n
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row of ``docs``; a null text counts as empty.

    ``text_hash`` tells apart rows that share an id; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            fp = [simhash(raw) for raw in utf8_list(batch.column("text"))]
            signed = np.array(fp, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(signed)],
                ["doc_id", "text_hash", "fp"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, as signed 64-bit numbers."""
    space = 1 << (radius + 1)
    vectors = [1 + position % (space - 1) for position in range(BITS)]
    masks = []
    for v in range(1, space):
        kept = sum(1 << p for p in range(BITS) if (vectors[p] & v).bit_count() % 2)
        masks.append(_signed(kept))
    return masks


def _flips(most: int) -> list[int]:
    return [_signed(sum(1 << p for p in places)) for k in range(most + 1) for places in combinations(range(BITS), k)]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def colliding(distinct: DataFrame, radius: int) -> DataFrame:
    """Fingerprints (column ``fp``, distinct) that equal another one under some covering mask."""
    tables = distinct.select("fp", F.posexplode(_longs(covering_masks(radius))).alias("table", "mask")).select(
        "fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("slot")
    )
    ends = tables.groupBy("table", "slot").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    shared = ends.where("low <> high").select("table", "slot")
    return tables.join(shared, ["table", "slot"], "left_semi").select("fp").distinct()


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all pairs within ``radius`` (even) bits."""
    if radius % 2:
        raise ValueError("the radius must be even")
    met = colliding(distinct, radius)
    at_hubs = met.select("fp", F.explode(_longs(_flips(radius // 2))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("hub")
    )
    groups = at_hubs.groupBy("hub").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    return groups.select(F.array_min("members").alias("v"), F.explode("members").alias("u")).where("u <> v")


def near_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id, keeper_id, keeper_hash)`` per row of ``docs``.

    ``component_id`` is the smallest id of the group (null only if all its ids are
    null); the keeper is the row of the group with the smallest id, nulls last, and
    then the smallest text hash.  Repeated rows get equal results.
    """
    fps = checkpointed(fingerprints(docs))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = checkpointed(fps.groupBy("fp").agg(F.min(place).alias("first")))
    labels = connected_components(links(classes.select("fp"), radius))
    labels = labels.select(F.col("node").alias("fp"), F.col("component").alias("label"))
    classes = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    keepers = classes.groupBy("label").agg(F.min("first").alias("keeper"))
    known = classes.join(keepers, "label").select(
        "fp",
        F.col("keeper.doc_id").alias("component_id"),
        F.col("keeper.doc_id").alias("keeper_id"),
        F.col("keeper.text_hash").alias("keeper_hash"),
    )
    return fps.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id", "keeper_id", "keeper_hash")


def one_of_each_group(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that are the keeper of their group; repeated rows once."""
    groups = near_groups(docs, radius)
    kept = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("keeper_id")) & (F.col("text_hash") == F.col("keeper_hash")))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    # The row travels as one value, so no column of it can clash with those used here.
    row = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(
        row.alias("_row"), docs["doc_id"].cast("long").alias("_doc_id"), F.xxhash64(docs["text"]).alias("_text_hash")
    )
    same = rows["_doc_id"].eqNullSafe(kept["_id"]) & (rows["_text_hash"] == kept["_hash"])
    found = rows.join(kept, same, "left_semi").dropDuplicates(["_doc_id", "_text_hash"])
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
