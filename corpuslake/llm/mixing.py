"""Mixing sources to target weights, with DataFrame functions only.

Each source's words are packed, document after document, into blocks of (almost)
equal length.  A source whose target is t words gets the slots that hold t words; a
keyed permutation deals all slots of all sources to output shards of fixed size, so
every shard's counts per source are a multinomial draw conditioned on the totals, and
the totals stay exact.  A source's k-th slot reads block ``permute(k)`` of its k-div-n
-th pass, so every pass reads each block once, and slots meet blocks by index.

Sizes grow as documents plus blocks.  No step gathers a source in one task: running
sums are taken within hash salts of a source and then over its salts' totals, slots
are dealt out in chunks, and joins are on the block index.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.words import WORD_PATTERN, word_count
from corpuslake.sources.scratch import checkpointed

WEIGHTS = (5, 2, 1)  # repeat over the sources in code point order, null last
MOST = 3  # a source is read at most so many times
BLOCK = 512  # words
SHARD_SLOTS = 256
SALTS = 1024
ROUNDS = 20
SEED = 7
# Fixed: modulus and multipliers of the arithmetic hash (Mersenne prime; any odd numbers below it serve).
PRIME = 2147483647
A, B, C, D = 48271, 69621, 1103515245, 630360016
_CHUNK = 1024


def _mix(value: Column) -> Column:
    """Hash of a non-negative number to 0 .. PRIME - 1 that SQL engines compute alike."""
    once = (value % PRIME * C + D) % PRIME
    return (once * once % PRIME * A + once) % PRIME


def permute(value: Column, size: Column, tweak: Column) -> Column:
    """Swap-or-not permutation of ``0 .. size - 1`` chosen by ``tweak``: exact for any size, no walking."""

    def turn(x, k):
        partner = (_mix(tweak * 31 + k * 7919 + SEED) + size - x) % size
        high = F.greatest(x, partner)
        coin = _mix(high + _mix(tweak * 17 + k * 104729 + SEED)) >= PRIME // 2
        return F.when(coin, partner).otherwise(x)

    turns = F.array(*[F.lit(k).cast("long") for k in range(ROUNDS)])
    return F.aggregate(turns, value.cast("long"), turn)


def _salt(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % SALTS


def targets(sizes: DataFrame) -> DataFrame:
    """``(sid, source, source_size, target)`` per source of ``sizes (source, size)``.

    Sources share all words by weight; a target stops at ``MOST`` times its source's
    size, and what is above goes to the others by weight until none is above: with
    one level for all, target = min(weight * level, stop).
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (
        sums.withColumn("sid", F.row_number().over(by_name).cast("long"))
        .withColumn("weight", weight.cast("long"))
        .withColumn("stop", F.col("source_size") * MOST)
    )
    # Sources in the order in which they reach their stop as the level rises.
    rising = Window.orderBy(F.col("stop") / F.col("weight"), "sid")
    upto = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before_stop = F.sum("stop").over(upto) - F.col("stop")
    open_weight = F.sum("weight").over(whole) - (F.sum("weight").over(upto) - F.col("weight"))
    level = (F.sum("source_size").over(whole) - before_stop) / open_weight
    reached = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("stop"))
    # The first source that stays open fixes the level of all that follow.
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("stop").cast("double"), F.coalesce(final * F.col("weight"), F.col("stop").cast("double")))
    return reached.select("sid", "source", "source_size", target.alias("target"))


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)`` per row of ``docs``; other columns are not read."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def _placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of ``sizes`` with their source's numbers and ``first``, their place in its run of words."""
    own = sources.select("sid", F.col("source").alias("_source"), "source_size", "target")
    rows = sizes.join(own, sizes["source"].eqNullSafe(own["_source"])).drop("_source")
    rows = rows.withColumn("salt", _salt(F.col("doc_id")))
    within = Window.partitionBy("sid", "salt").orderBy("doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("run", F.sum("size").over(within) - F.col("size"))
    totals = rows.groupBy("sid", "salt").agg(F.sum("size").alias("salt_size"))
    across = Window.partitionBy("sid").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select("sid", "salt", (F.sum("salt_size").over(across) - F.col("salt_size")).alias("start"))
    rows = rows.join(starts, ["sid", "salt"])
    return rows.select(
        "doc_id", "source", "size", "sid", "source_size", "target", (F.col("start") + F.col("run")).alias("first")
    )


def _with_blocks(sources: DataFrame, block: int) -> DataFrame:
    """Blocks, slots and the slots' place among all slots, per source with words."""
    blocks = F.ceil(F.col("source_size") / block)
    slots = F.ceil(F.round("target") * F.col("blocks") / F.col("source_size"))
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sources.where("source_size > 0")
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("slots", F.least(slots.cast("long"), F.col("blocks") * MOST))
        .withColumn("offset", F.sum("slots").over(before) - F.col("slots"))
        .withColumn("all_slots", F.sum("slots").over(whole))
    )


def _edge(index: Column) -> Column:
    """First word of a block; the first source_size % blocks blocks are one word longer."""
    return index * F.expr("source_size div blocks") + F.least(index, F.col("source_size") % F.col("blocks"))


_BLOCK_OF = """case when {w} < (source_size % blocks) * (source_size div blocks + 1)
    then {w} div (source_size div blocks + 1)
    else source_size % blocks
        + ({w} - (source_size % blocks) * (source_size div blocks + 1)) div (source_size div blocks) end"""


def draws(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every slot of the mix: ``(sid, idx, shard, slot, words)``; ``words`` null for a whole block.

    The last slot of a source is cut to the words that its target still lacks.
    """
    chunks = _with_blocks(sources, block).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {_CHUNK}"))).alias("chunk")
    )
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.where("slots > 0").repartition(parts, "sid", "chunk")
    upto = F.least(F.col("slots"), (F.col("chunk") + 1) * _CHUNK) - 1
    slots = chunks.select("*", F.explode(F.sequence(F.col("chunk") * _CHUNK, upto)).alias("k"))
    passed = F.expr("k div blocks")
    index = permute(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("sid") * 8 + passed)
    at = permute(F.col("offset") + F.col("k"), F.col("all_slots"), F.lit(0).cast("long"))
    slots = slots.withColumn("idx", index).withColumn("at", at)
    mean = F.col("source_size") / F.col("blocks")
    lacking = F.col("words") - F.round((F.col("slots") - 1) * mean)
    cut = F.when((F.col("k") == F.col("slots") - 1) & (lacking < F.floor(mean)), lacking.cast("long"))
    return slots.select(
        "sid",
        "idx",
        F.floor(F.col("at") / SHARD_SLOTS).alias("shard"),
        (F.col("at") % SHARD_SLOTS).alias("slot"),
        cut.alias("words"),
    )


def _pieces(placed: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Each document's share of each block it lies in: ``begin`` in the block, ``inside`` the document, ``length``."""
    shape = _with_blocks(sources, block).select("sid", "blocks")
    rows = placed.where("size > 0").join(shape, "sid")
    low, high = F.expr(_BLOCK_OF.format(w="first")), F.expr(_BLOCK_OF.format(w="(first + size - 1)"))
    rows = rows.select("*", F.explode(F.sequence(low, high)).alias("idx"))
    rows = rows.withColumn("left", _edge(F.col("idx"))).withColumn("right", _edge(F.col("idx") + 1))
    begin = F.greatest("first", "left")
    length = F.least(F.col("first") + F.col("size"), F.col("right")) - begin
    return rows.select(
        "doc_id", "source", "size", "first", "sid", "idx",
        (begin - F.col("left")).alias("begin"), (begin - F.col("first")).alias("inside"), length.alias("length"),
    )


def _taken_pieces(placed: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Pieces that at least one slot reads, with ``whole`` (times in full), ``part`` (more words) and first shard."""
    read = draws(sources, block).groupBy("sid", "idx").agg(
        F.count(F.when(F.col("words").isNull(), 1)).alias("times"),
        F.coalesce(F.sum("words"), F.lit(0)).alias("cut"),
        F.min(F.when(F.col("words").isNull(), F.col("shard"))).alias("whole_shard"),
        F.min(F.when(F.col("words").isNotNull(), F.col("shard"))).alias("cut_shard"),
    )
    # Sizes of exploded rows are guessed from the few sources; the hint keeps them from being broadcast.
    joined = _pieces(placed, sources, block).hint("merge").join(read, ["sid", "idx"])
    # A slot that is cut reads the first words of its block.
    part = F.greatest(F.lit(0).cast("long"), F.least("length", F.col("cut") - F.col("begin")))
    joined = joined.withColumn("part", part).where("times > 0 or part > 0")
    return joined.withColumn("shard", F.least("whole_shard", F.when(F.col("part") > 0, F.col("cut_shard"))))


def plan_mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, first, size, source_size, target, taken, first_shard)`` per row of ``docs``.

    ``taken`` counts the words the mix takes of the row, repeats included: 0 for a null,
    empty or blank text; ``first_shard`` is the first output shard that holds some of
    them, null if none.  Null is a source of its own; ids may be null or repeated.
    """
    sizes = checkpointed(sized(docs))
    sources = checkpointed(targets(sizes))
    placed = checkpointed(_placed(sizes, sources))
    taken = (
        _taken_pieces(placed, sources, block)
        .groupBy("sid", "first")
        .agg(
            F.sum(F.col("length") * F.col("times") + F.col("part")).alias("taken"),
            F.min("shard").alias("first_shard"),
        )
    )
    # Rows with words never share their place, rows without are not in ``taken``.
    rows = placed.withColumn("at", F.when(F.col("size") > 0, F.col("first")))
    taken = taken.withColumnRenamed("first", "at")
    return rows.hint("merge").join(taken, ["sid", "at"], "left").select(
        "doc_id", "source", "first", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard",
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents: all columns of ``docs``, one row per document and copy (at most ``MOST``).

    Copy c of a document holds, in order and joined by one space, the words that the
    mix takes at least c times.  ``n_chars`` follows the text where there is such a
    column.  A document of which nothing is taken has no row.  Repeated rows are
    counted and served one by one.
    """
    sizes = checkpointed(sized(docs))
    sources = checkpointed(targets(sizes))
    placed = checkpointed(_placed(sizes, sources))
    span = F.struct("inside", "length", "times", "part")
    spans = (
        _taken_pieces(placed, sources, block)
        .groupBy("doc_id", "source", "size", "first")
        .agg(F.sort_array(F.collect_list(span)).alias("_spans"))
    )
    # Rows that share id, source and size are told apart by their rank.
    key = ["doc_id", "source", "size"]
    ranked = placed.where("size > 0").withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("first")))
    spans = spans.hint("merge").join(
        ranked.select(*[F.col(c).alias(f"_k{c}") for c in key], F.col("first").alias("_kfirst"), "rank"),
        (F.col("first") == F.col("_kfirst"))
        & (F.col("size") == F.col("_ksize"))
        & F.col("doc_id").eqNullSafe(F.col("_kdoc_id"))
        & F.col("source").eqNullSafe(F.col("_ksource")),
    ).select("_kdoc_id", "_ksource", "_ksize", F.col("rank").alias("_krank"), "_spans")
    # The row travels as one value, so no column of it can clash with those used here.
    row = F.struct(*[docs[c] for c in docs.columns])
    own = docs.select(row.alias("_row"), word_count(F.col("text")).alias("_size"))
    order = Window.partitionBy("_row.doc_id", "_row.source", "_size").orderBy(F.xxhash64("_row.text"))
    own = own.withColumn("_rank", F.row_number().over(order))
    found = own.hint("merge").join(
        spans,
        own["_row"]["doc_id"].eqNullSafe(spans["_kdoc_id"])
        & own["_row"]["source"].eqNullSafe(spans["_ksource"])
        & (own["_size"] == spans["_ksize"])
        & (own["_rank"] == spans["_krank"]),
    )
    # The words are bound to a variable, so they are cut out once for all spans and copies; the
    # outer form of explode keeps the optimizer from working the texts out a second time.
    texts = F.expr(
        rf"""element_at(transform(array(regexp_extract_all(_row.text, '{WORD_PATTERN.replace(chr(92), chr(92) * 2)}', 0)), w ->
            transform(sequence(1, {MOST}), copy -> array_join(flatten(transform(_spans, s ->
                slice(w, cast(s.inside as int) + 1,
                    cast(case when s.times >= copy then s.length when s.times = copy - 1 then s.part else 0 end as int))
            )), ' '))), 1)"""
    )
    copies = found.select("_row", F.explode_outer(texts).alias("_taken")).where("_taken <> ''")
    kind = dict(docs.dtypes)
    new = {"text": F.col("_taken"), "n_chars": F.length("_taken")}
    return copies.select(
        *[new[c].cast(kind[c]).alias(c) if c in new else F.col("_row").getField(c).alias(c) for c in docs.columns]
    )
