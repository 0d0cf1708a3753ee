"""Language identification with bit-sliced Bloom filters of character n-grams.

One filter array serves all languages: a slot holds a byte per eight languages, one
bit each.  An n-gram's slots are combined with AND, which gives at once all languages
that contain it.  Per-language counts of set bits over a text's n-grams are corrected
for the filter's own false positives; the language with the largest corrected count
decides.

N-grams are counted by Spark over a bounded sample of labelled documents per language
and the filters hold at most ``per_language`` of each, so the model has a size bound
that no corpus changes.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.words import held_out, least_hashed

SIZES = (3, 4)
SAMPLE_PER_LANGUAGE = 2000  # labelled documents per language that the fit looks at
MOST_LANGUAGES = 256  # languages that are learnt, the commonest first
PER_LANGUAGE = 30_000  # n-grams kept per language
SLOTS = 1 << 20
PROBES = 2
SHARE = 0.1  # a language holds an n-gram if it is at least this common there, against the commonest
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], "u8")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_letters = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters, each run of others as one blank, with a blank at either end; empty without letters."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letter_table()[points]
    if not letter.any():
        return points[:0]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return np.where(letter, points, 32)[keep].astype("u8")


def ngram_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every n-gram, repeats included."""
    found = []
    for size in SIZES:
        if len(points) >= size:
            span = len(points) - size + 1
            mixed = np.full(span, size, dtype="u8")
            for k in range(size):
                mixed = (mixed ^ points[k : k + span]) * _MULTIPLIERS[k]
                mixed ^= mixed >> np.uint64(29)
            found.append(mixed)
    return np.concatenate(found) if found else np.empty(0, "u8")


def _slots(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    mask = np.uint64(slots - 1)
    return [(hashes >> np.uint64(20 * k)) & mask for k in range(PROBES)]


@dataclass
class Filters:
    languages: list[str]
    slices: np.ndarray  # (bytes per slot, slots)
    false_rate: np.ndarray  # chance that an unknown n-gram seems to be in the language

    @classmethod
    def build(cls, languages, codes, hashes, slots: int = SLOTS) -> "Filters":
        """``codes[i]`` is the place in ``languages`` of the language that holds ``hashes[i]``."""
        slices = np.zeros((max(1, -(-len(languages) // 8)), slots), dtype=np.uint8)
        for place in _slots(hashes, slots):
            np.bitwise_or.at(slices, (codes // 8, place), (1 << (codes % 8)).astype(np.uint8))
        fill = np.array([np.count_nonzero(slices[k // 8] >> (k % 8) & 1) / slots for k in range(len(languages))])
        return cls(list(languages), slices, fill**PROBES)

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Per language, how many of the n-grams it holds, less the expected false ones."""
        places = _slots(hashes, self.slices.shape[1])
        found = []
        for layer in self.slices:
            masks = layer[places[0]]
            for place in places[1:]:
                masks = masks & layer[place]
            found.append(np.bincount(masks, minlength=256) @ _BYTE_BITS)
        raw = np.concatenate(found)[: len(self.languages)]
        return np.maximum(0.0, (raw - len(hashes) * self.false_rate) / (1 - self.false_rate))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and the share of n-grams it explains; ``und`` and 0 without letters or without any language."""
        points = code_points(text) if text else np.empty(0, "u8")
        if not len(points) or not self.languages:
            return UNKNOWN, 0.0
        hashes = ngram_hashes(points)
        counts = self.counts(hashes)
        best = int(np.argmax(counts))
        return self.languages[best], float(min(1.0, counts[best] / len(hashes)))


def ngram_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all n-grams of ``labelled (lang, text)``, summed within batches first."""

    def run(batches):
        for batch in batches:
            by_language = {}
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_language.setdefault(language, []).append(ngram_hashes(code_points(text)))
            for language, parts in by_language.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )

    rows = labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    per_language: int = PER_LANGUAGE,
    slots: int = SLOTS,
) -> Filters:
    """Filters learnt from the text and language of documents outside the test fold.

    Rows with a null text, language or id are not learnt from.  Of each language the
    documents with the smallest hash of their id are taken, of at most MOST_LANGUAGES languages.  Without any, the filters
    know no language.
    """
    usable = docs.select("doc_id", "lang", "text").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.where(~held_out(F.col("doc_id")))
    ids = usable.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    chosen = least_hashed(ids, "_lang", "_id", sample_per_language, MOST_LANGUAGES)
    # At most ``sample_per_language * MOST_LANGUAGES`` pairs, so the texts need no shuffle.
    sample = usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    counted = ngram_counts(sample)
    totals = Window.partitionBy("lang")
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = counted.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= per_language)
    kept = kept.withColumn("share", F.col("n") / F.sum("n").over(totals)).select("lang", "gram", "share")
    table = kept.toArrow()
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    place = {language: k for k, language in enumerate(languages)}
    codes = np.array([place[x] for x in names], dtype=np.int64)
    grams = table.column("gram").to_numpy().astype(np.int64).view("u8")
    shares = table.column("share").to_numpy()
    _, group = np.unique(grams, return_inverse=True)
    most = np.zeros(group.max() + 1 if len(group) else 0)
    np.maximum.at(most, group, shares)
    common = shares >= SHARE * most[group] if len(group) else np.zeros(0, bool)
    return Filters.build(languages, codes[common], grams[common], slots)


def _predictor(docs: DataFrame, filters: Filters):
    """Column function from text to language and score; the filters (size fixed by their parameters) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("struct<lang_pred: string, lang_score: double>")
    def predict(texts):
        import pandas as pd

        model = shared.value
        return pd.DataFrame([model.predict(text) for text in texts], columns=["lang_pred", "lang_score"])

    return predict.asNondeterministic()


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``(doc_id, lang_pred, lang_score)`` per row of ``docs``; only the text is looked at.

    Null or letterless text gets ``und`` and 0.
    """
    found = docs.select("doc_id", _predictor(docs, filters)(F.col("text")).alias("found"))
    return found.select("doc_id", "found.lang_pred", "found.lang_score")


def known_language(docs: DataFrame, filters: Filters, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of at least ``least``."""
    # The row travels as one value, so no column of it can clash with those used here.
    row = F.struct(*[docs[c] for c in docs.columns])
    found = docs.select(row.alias("_row"), _predictor(docs, filters)(docs["text"]).alias("_found"))
    good = (F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.lang_score") >= least)
    return found.where(good).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
