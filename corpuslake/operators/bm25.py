"""Corpus statistics and BM25 sparse vectors."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake import constants as C
from corpuslake.functions.text import tokens, words
from corpuslake.operators.common import hashed, single, unfold
from corpuslake.sources.scratch import stored

# The bound only chooses the form of a join; both forms give equal rows (tested).
# Terms joined by broadcast: those with at least 1/HOT_TERMS of all postings.  There
# can be no more than HOT_TERMS of them, and with the length limit the broadcast side
# stays below HOT_TERMS * (HOT_TERM_LENGTH * 4 + 64) bytes = 54 MB whatever the corpus.
HOT_TERMS = 50_000
HOT_TERM_LENGTH = 256

# Text that one task looks up: larger parts ask for fewer words in all, smaller ones need less memory.
PART_BYTES = 4 << 20


def tokenize(docs: DataFrame, text: str, *keys: str) -> DataFrame:
    """One row per token: keys, ``pos`` (0-based), ``term``."""
    return unfold(docs.select(*keys, text), list(keys), tokens(text), "term", "pos")


def vocabulary(docs: DataFrame, text: str) -> DataFrame:
    """Distinct lower-cased tokens."""
    return unfold(docs.select(text), [], F.array_distinct(tokens(text)), "term").distinct()


def term_frequency(chunks: DataFrame, text: str = "text", key: str = "unique_id") -> DataFrame:
    """``key, term, tf, doc_len``.

    Texts are hashed by key while still whole, which is several times less data
    than their tokens; counting then needs no exchange of its own.
    """
    split = hashed(chunks.select(key, text), key).select(key, tokens(text).alias("_t"))
    return _counted_by_key(split, key).select(key, "term", "tf", "doc_len")


def _counted_by_key(split: DataFrame, *keys: str) -> DataFrame:
    """Term counts of token arrays ``_t``; rows that repeat the keys and are of equal length count as one."""
    each = unfold(split, [*keys, F.size("_t").alias("doc_len")], F.col("_t"), "term")
    return each.groupBy(*keys, "term", "doc_len").agg(F.count("*").alias("tf"))


def document_frequency(docs: DataFrame, text: str) -> DataFrame:
    """``term, df``: a document counts once per term; repeats vanish before the shuffle."""
    each = unfold(docs.select(text), [], F.array_distinct(tokens(text)), "term")
    return each.groupBy("term").agg(F.count("*").alias("df"))


def average_length(docs: DataFrame, text: str) -> DataFrame:
    """One row ``n_docs, avgdl``."""
    return docs.select(F.size(words(text)).alias("n")).agg(
        F.count("*").alias("n_docs"), F.avg("n").alias("avgdl")
    )


def _term_rows(docs: DataFrame, text: str, order: str) -> DataFrame:
    """``doc, n, pos, term``: distinct terms of each document, and a null term for its length."""
    split = docs.select(F.col(order).alias("doc"), tokens(text).alias("_t"))
    return split.select(
        "doc",
        F.size("_t").alias("n"),
        F.posexplode_outer(F.array_append(F.array_distinct("_t"), F.lit(None))).alias("pos", "term"),
    )


def term_table(docs: DataFrame, text: str, order: str) -> DataFrame:
    """``term, df, first_doc, first_pos, n_tokens`` in a single pass over the corpus.

    Each document also emits one row with a null term that carries its length;
    the null group ends up with the document count and the token count.
    ``order`` must be integral, so all buffers stay in the hash aggregate.
    """
    marked = _term_rows(docs, text, order)
    length = F.when(F.col("term").isNull(), F.col("n").cast("long"))
    return marked.groupBy("term").agg(
        F.count("*").alias("df"),
        F.min("doc").alias("first_doc"),
        F.min_by("pos", "doc").alias("first_pos"),
        F.sum(length).alias("n_tokens"),
    )


def number_terms(terms: DataFrame) -> DataFrame:
    """Adds ``term_idx``: 0-based place in first-seen order, without a one-task window.

    A range sort numbers rows inside each partition; partition offsets (one row
    per partition) are added afterwards.  The stored rows fix the partitions
    between the two steps, also when executors are lost.
    """
    ordered = stored(
        terms.orderBy("first_doc", "first_pos", "term").withColumn(
            "_n", F.monotonically_increasing_id()
        )
    ).withColumn("_part", F.shiftright("_n", 33).cast("int"))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("rows"))
    packed = sizes.agg(F.sort_array(F.collect_list(F.struct("_part", "rows"))).alias("sizes"))
    before = F.aggregate(
        F.filter(F.col("_sizes"), lambda s: s["_part"] < F.col("_part")),
        F.lit(0).cast("long"),
        lambda acc, s: acc + s["rows"],
    )
    offsets = sizes.select("_part", single(packed, "sizes").alias("_sizes")).select(
        "_part", before.alias("_before")
    )
    local = F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(offsets), "_part").select(
        "term", (F.col("_before") + local).alias("term_idx"), *[c for c in terms.columns if c != "term"]
    )


def raw_idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs - df + 0.5) - F.log(df + 0.5)


def bm25_params(terms: DataFrame, k1=C.BM25_K1, b=C.BM25_B, epsilon=C.BM25_EPSILON) -> DataFrame:
    """One row ``n_docs, avgdl, k1, b, epsilon, avg_idf`` from a ``term_table``."""
    totals = terms.where(F.col("term").isNull())
    plain = terms.where(F.col("term").isNotNull())
    idf = raw_idf(single(totals, "df"), F.col("df"))
    mean = plain.agg(F.avg(idf).alias("avg_idf"))
    return totals.select(
        F.col("df").alias("n_docs"),
        (F.col("n_tokens") / F.col("df")).alias("avgdl"),
        F.lit(float(k1)).alias("k1"),
        F.lit(float(b)).alias("b"),
        F.lit(float(epsilon)).alias("epsilon"),
        single(mean, "avg_idf").alias("avg_idf"),
    )


def add_idf(terms: DataFrame, params: DataFrame) -> DataFrame:
    """Adds ``idf``; a negative value becomes ``epsilon * avg_idf``."""
    idf = raw_idf(single(params, "n_docs"), F.col("df"))
    floor = single(params, "epsilon") * single(params, "avg_idf")
    return terms.withColumn("_raw", idf).withColumn(
        "idf", F.when(F.col("_raw") < 0, floor).otherwise(F.col("_raw"))
    ).drop("_raw")


def build_bm25(docs: DataFrame, text: str, order: str, k1=C.BM25_K1, b=C.BM25_B, epsilon=C.BM25_EPSILON):
    """(terms ``term, term_idx, df, idf``; params): one pass over the corpus."""
    table = stored(term_table(docs, text, order))
    params = bm25_params(table, k1, b, epsilon)
    numbered = number_terms(table.where(F.col("term").isNotNull()))
    return add_idf(numbered, params).select("term", "term_idx", "df", "idf"), params


# -- statistics that follow a changing corpus ---------------------------------------


def term_deltas(added: DataFrame, removed: DataFrame, text: str, order: str) -> DataFrame:
    """``term, df, first_doc, first_pos``: documents a term gains (added) or loses (removed, so negative).

    A null term carries the change in documents as ``df`` and in tokens as ``n_tokens``.
    ``first_doc`` is null for a term that no added document holds.
    """
    gained = _term_rows(added, text, order).withColumn("sign", F.lit(1).cast("long"))
    lost = _term_rows(removed, text, order).withColumn("sign", F.lit(-1).cast("long"))
    doc = F.when(F.col("sign") > 0, F.col("doc"))
    length = F.when(F.col("term").isNull(), F.col("sign") * F.col("n"))
    return gained.unionByName(lost).groupBy("term").agg(
        F.sum("sign").alias("df"),
        F.min(doc).alias("first_doc"),
        F.min_by("pos", doc).alias("first_pos"),
        F.sum(length).alias("n_tokens"),
    )


def with_new_ids(deltas: DataFrame, known: DataFrame) -> DataFrame:
    """``term, term_idx, df``: terms that ``known`` (``term, term_idx``) lacks get the ids that follow its greatest.

    Ids are never given twice, so vectors made earlier keep their meaning.  Other terms have a null id here.
    """
    held = known.select("term", F.lit(True).alias("_held")).distinct()
    own = deltas.where(F.col("term").isNotNull()).join(held, "term", "left")
    is_fresh = F.col("first_doc").isNotNull() & F.col("_held").isNull()
    own = stored(own.select("*", is_fresh.alias("_fresh")).drop("_held"))
    first = F.coalesce(single(known.agg((F.max("term_idx") + 1).alias("n")), "n"), F.lit(0))
    fresh = number_terms(own.where("_fresh"))
    fresh = fresh.select("term", (F.col("term_idx") + first).alias("term_idx"), "df")
    return fresh.unionByName(own.where("not _fresh").select("term", F.lit(None).cast("long").alias("term_idx"), "df"))


def summed_terms(deltas: DataFrame) -> DataFrame:
    """``term, term_idx, df`` of the terms that documents hold after all changes."""
    whole = deltas.groupBy("term").agg(F.max("term_idx").alias("term_idx"), F.sum("df").alias("df"))
    return whole.where("df > 0")


def params_of(
    terms: DataFrame, sizes: DataFrame, k1=C.BM25_K1, b=C.BM25_B, epsilon=C.BM25_EPSILON
) -> DataFrame:
    """One row of parameters from summed terms and changes of size (``n_docs, n_tokens``)."""
    totals = sizes.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    mean = terms.agg(F.avg(raw_idf(single(totals, "n_docs"), F.col("df"))).alias("avg_idf"))
    return totals.select(
        "n_docs",
        F.try_divide("n_tokens", "n_docs").alias("avgdl"),
        F.lit(float(k1)).alias("k1"),
        F.lit(float(b)).alias("b"),
        F.lit(float(epsilon)).alias("epsilon"),
        single(mean, "avg_idf").alias("avg_idf"),
    )


def score(tf, doc_len, idf, k1, b, avgdl) -> Column:
    """BM25 weight; missing parameters take their defaults."""
    k1 = F.coalesce(k1, F.lit(C.BM25_K1))
    b = F.coalesce(b, F.lit(C.BM25_B))
    avgdl = F.coalesce(avgdl, F.lit(C.BM25_DEFAULT_AVGDL))
    norm = k1 * (1 - b + b * doc_len / avgdl)
    return idf * (tf * (k1 + 1) / (tf + norm))


def _param(params: DataFrame | None, name: str) -> Column:
    if params is None or name not in params.columns:
        return F.lit(None).cast("double")
    return single(params, name)


def _hot_and_rare(terms: DataFrame, hot_terms: int) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (``term, term_idx, idf``) in two: frequent terms, of bounded number and size, and the rest."""
    postings = terms.agg(F.sum("df").alias("n"))
    is_hot = (F.length("term") <= HOT_TERM_LENGTH) & (
        F.col("df") * F.lit(hot_terms) >= single(postings, "n")
    )
    entry = ("term", F.col("term_idx").cast("int").alias("term_idx"), "idf")
    return terms.where(is_hot).select(*entry), terms.where(~F.coalesce(is_hot, F.lit(False))).select(*entry)


def parts_of(texts: DataFrame, text: str) -> int:
    """Number of parts for the weights of these texts: by their bytes, but as many as shuffle partitions at least."""
    total = texts.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(_usual_parts(texts), -(-total // PART_BYTES))


def _usual_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(chunks: DataFrame, own: Column, place: list[Column] | None, parts: int | None) -> DataFrame:
    """``_part, _row``: whole chunks, dealt by ``place`` (None: ``own``) to parts, or to the number it is if ``parts`` is given."""
    given = place is not None and parts is not None
    parts = parts or _usual_parts(chunks)
    part = place[0] if given else F.pmod(F.xxhash64(*(place or [own])), F.lit(parts))
    # Never null, so that no reader adds a filter below the exchange and then cannot share it.
    number = F.coalesce(part.cast("int"), F.lit(0)).alias("_part")
    rows = chunks.select(number, F.struct(*chunks.columns).alias("_row"))
    return rows.repartitionById(parts, "_part")


def _entries_of_parts(dealt: DataFrame, hot: DataFrame, rare: DataFrame, text: str, parts: int | None) -> DataFrame:
    """``_part, term, _rare``: entries of the rare terms that a part's chunks hold, sent to the part.

    A part asks for a term once, however many of its chunks hold it, and no posting travels.
    """
    # The row is named as a whole, so this plan has the columns of its caller's and shares the one exchange.
    held = F.flatten(F.transform(F.array("_row"), lambda r: F.array_distinct(tokens(r.getField(text)))))
    asked = unfold(dealt, ["_part"], held, "term", "_n").select("_part", "term").distinct()
    unmet = asked.join(F.broadcast(hot.select("term")), "term", "left_anti")
    found = unmet.join(rare, "term").select("_part", "term", F.struct("term_idx", "idf").alias("_rare"))
    return found.repartitionById(parts or _usual_parts(dealt), "_part")


def _looked_up(postings: DataFrame, hot: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds ``_found`` (``term_idx, idf``, null for unknown terms) to postings with ``_part, term``.

    Frequent terms come by broadcast.  The others lie in the part already: both sides are dealt
    by ``_part``, so the join needs no exchange, and its hash table is the terms of one part.
    """
    often = hot.select("term", F.struct("term_idx", "idf").alias("_hot"))
    tried = postings.join(F.broadcast(often), "term", "left")
    both = entries.hint("shuffle_hash").join(tried, ["_part", "term"], "right")
    return both.withColumn("_found", F.coalesce("_hot", "_rare")).drop("_hot", "_rare")


def sparse_weights(
    chunks: DataFrame,
    terms: DataFrame,
    params: DataFrame | None,
    text: str = "text",
    key: str = "unique_id",
    hot_terms: int = HOT_TERMS,
    place: list[Column] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``key, term_idx, score`` for every known term of every chunk.

    Chunks travel once, as whole texts, by ``place`` (as for ``add_sparse_vectors``); frequent
    terms come to them by the bounded broadcast and the others once per part, so no posting
    travels or is sorted.  Terms are counted within the row; only rows that share their key
    with others go through an aggregate.
    """
    hot, rare = _hot_and_rare(terms, hot_terms)
    dealt = _dealt(chunks.select(key, text), F.col(key), place, parts)
    entries = _entries_of_parts(dealt, hot, rare, text, parts)

    keyed = dealt.select("_part", F.col("_row").getField(key).alias(key), F.col("_row").getField(text).alias("_text"))
    keyed = keyed.withColumn("_same", F.count("*").over(Window.partitionBy("_part", key)))
    alone = _with_term_counts(keyed.where("_same = 1"), F.col("_text"))
    alone = alone.select("_part", key, "doc_len", F.inline_outer("_counts")).where(F.col("term").isNotNull())
    shared = keyed.where("_same > 1").select("_part", key, tokens("_text").alias("_t"))
    k1, b, avgdl = (_param(params, name) for name in ("k1", "b", "avgdl"))

    def weights(postings: DataFrame) -> DataFrame:
        found = _looked_up(postings, hot, entries).where(F.col("_found").isNotNull())
        return found.select(
            key,
            F.col("_found.term_idx").alias("term_idx"),
            score(F.col("tf"), F.col("doc_len"), F.col("_found.idf"), k1, b, avgdl).alias("score"),
        )

    return weights(alone).unionByName(weights(_counted_by_key(shared, "_part", key)))


def name_terms(pairs: DataFrame, terms: DataFrame, index: str = "indices", hot_terms: int = HOT_TERMS) -> DataFrame:
    """Adds ``term`` to rows with a term id; rows with an unknown id go.

    Ids of frequent terms meet a bounded broadcast; only the other rows travel.  ``pairs`` is
    read twice, so it should be a stored table.
    """
    hot, rare = (side.select(F.col("term_idx").alias(index), "term") for side in _hot_and_rare(terms, hot_terms))
    unmet = pairs.join(F.broadcast(hot.select(index)), index, "left_anti")
    return pairs.join(F.broadcast(hot), index).unionByName(unmet.join(rare, index))


def _run_starts(ordered: Column, differs: Callable[[Column, Column], Column]) -> Column:
    """Places in an ordered array where a run of like elements begins."""
    return F.filter(
        F.transform(ordered, lambda _, i: i),
        lambda i: (i == 0) | differs(F.get(ordered, i - 1), F.get(ordered, i)),
    )


def _with_term_counts(rows: DataFrame, text: Column) -> DataFrame:
    """Adds ``doc_len`` and ``_counts``, an array of ``term, tf``, counted within the row."""
    ordered = rows.withColumn("_t", F.array_sort(tokens(text)))
    starts = ordered.withColumn("_starts", _run_starts(F.col("_t"), lambda x, y: x != y))
    until = lambda k: F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_t"))
    counts = F.transform(
        "_starts", lambda i, k: F.struct(F.get(F.col("_t"), i).alias("term"), (until(k) - i).cast("long").alias("tf"))
    )
    return starts.select(*rows.columns, F.size("_t").alias("doc_len"), counts.alias("_counts"))


def add_sparse_vectors(
    chunks: DataFrame,
    terms: DataFrame,
    params: DataFrame | None,
    text: str = "text",
    key: str = "unique_id",
    hot_terms: int = HOT_TERMS,
    place: list[Column] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Adds ``bm25_sparse_vector`` (``map<int,double>``, empty if no term is known).

    A group is one chunk, whose length the chunk size bounds.  Chunks travel once, by ``place``
    (columns a function of the key; None: the key), and the result lies there.  Frequent terms
    come to the chunks by a bounded broadcast and the others once per part, so postings stay
    where the chunk is.  On the way the key is its md5, as for the ids of pages.  With ``parts``
    and ``place`` the one column of ``place`` is the number of a part below it.  Each part is one
    task: the sort that brings a chunk and its postings together is as large as the caller chose,
    where adaptive execution would join partitions by their compressed bytes.
    """
    hot, rare = _hot_and_rare(terms, hot_terms)
    # A chunk without a key has no weights; it is placed by its text.
    mark = lambda of: F.coalesce(
        F.unhex(F.md5(of(key).cast("string"))), F.unhex(F.hex(F.xxhash64(of(text))))
    )
    dealt = _dealt(chunks, mark(F.col), place, parts)
    entries = _entries_of_parts(dealt, hot, rare, text, parts)

    group = ["_part", "_mark"]
    own_field = F.col("_row").getField
    met = dealt.select("_part", mark(own_field).alias("_mark"), "_row")
    counted = _with_term_counts(met, F.when(own_field(key).isNotNull(), own_field(text)))

    kinds = dict(met.dtypes)

    def item(row=None, term=None, tf=None):
        given = (("_row", row, kinds["_row"]), ("term", term, "string"), ("tf", tf, "bigint"))
        return F.struct(*[(F.lit(None).cast(kind) if c is None else c).alias(name) for name, c, kind in given])

    own = F.transform("_counts", lambda c: item(term=c["term"], tf=c["tf"]))
    itself = F.array(item(row=F.col("_row")))
    items = F.when(F.col("_counts").isNull(), itself).otherwise(F.concat(itself, own))
    spread = counted.select(*group, "doc_len", F.explode(items).alias("_i")).select(*group, "doc_len", "_i.*")
    entry = F.struct(F.col("_found.term_idx").alias("term_idx"), "doc_len", F.col("_found.idf").alias("idf"), "tf")
    gathered = (
        _looked_up(spread, hot, entries)
        .select(*group, "_row", F.when(F.col("_found").isNotNull(), entry).alias("_entry"))
        .where(F.col("_row").isNotNull() | F.col("_entry").isNotNull())
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list("_entry")).alias("_e"), F.collect_list("_row").alias("_rows"))
    )

    # Rows that repeat a key count as one: like entries of equal length are added up.
    differs = lambda x, y: (x["term_idx"] != y["term_idx"]) | (x["doc_len"] != y["doc_len"])
    gathered = gathered.withColumn("_starts", F.when(F.size("_rows") > 1, _run_starts(F.col("_e"), differs)))
    until = lambda k: F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_e"))

    def summed(i, k):
        same = F.slice(F.col("_e"), i + 1, until(k) - i)
        return F.get(F.col("_e"), i).withField("tf", F.aggregate(same, F.lit(0).cast("long"), lambda n, e: n + e["tf"]))

    single_entries = F.when(F.col("_starts").isNull(), F.col("_e")).otherwise(F.transform("_starts", summed))
    # Functions over arrays take no subquery, so the parameters become columns.
    gathered = gathered.withColumns({f"_{name}": _param(params, name) for name in ("k1", "b", "avgdl")})
    k1, b, avgdl = (F.col(f"_{name}") for name in ("k1", "b", "avgdl"))
    weights = F.transform(
        "_single",
        lambda e: F.struct(
            e["term_idx"].alias("term_idx"), score(e["tf"], e["doc_len"], e["idf"], k1, b, avgdl).alias("score")
        ),
    )
    vectors = gathered.withColumn("_single", single_entries).select(
        F.map_from_entries(weights).alias("bm25_sparse_vector"), F.explode("_rows").alias("_row")
    )
    return vectors.select(F.col(f"_row.{key}"), *[F.col(f"_row.{c}") for c in chunks.columns if c != key], "bm25_sparse_vector")


def fallback_terms(chunks: DataFrame, text: str, idf: DataFrame) -> DataFrame:
    """Terms for statistics that lack a vocabulary: the chunks' own words, with stored idf.

    Ordinals follow the alphabet, since a set has no order of its own.
    """
    own = vocabulary(chunks, text).join(idf.select("term", "df", "idf"), "term", "left")
    ranked = own.withColumn("first_doc", F.lit(0).cast("long")).withColumn("first_pos", F.lit(0))
    numbered = number_terms(ranked)
    return numbered.where(F.col("idf").isNotNull()).select("term", "term_idx", "df", "idf")
