"""Toxicity by multiple-instance learning.

Only documents carry labels.  A document is a bag of sentences; each sentence gets a
logistic score from the features it holds, and the bag is toxic unless every sentence
is not (noisy-or).  Training that likelihood on document labels pushes the blame to
the sentences that explain it, so the model also says where a document offends.

Features are words and their first letters; Spark counts in how many sampled documents
of either label each occurs and keeps the telling ones.  Sample, features and so the
broadcast model have fixed bounds.
"""

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.words import held_out, least_hashed
from corpuslake.sources.scratch import checkpointed

SAMPLE_PER_LABEL = 4000  # labelled documents per label that the fit looks at
MOST_FEATURES = 4096
PREFIXES = (4, 5, 6)
LEAST_DOCS = 4  # toxic sample documents that must hold a feature, and
LEAST_SHARE = 0.015  # of all toxic sample documents: what copies of one document share is no feature
LEAST_RATIO = 3.0  # how much commoner a feature must be among toxic documents
OFFENDING = 0.5
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_REMEMBERED = 200_000


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    bias: float
    prior: float | None = None  # score of every text if there was nothing to learn from
    known: dict[str, tuple] = field(default_factory=dict, repr=False)

    def held(self, word: str) -> tuple:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            found = tuple(self.features[f] for f in word_features(word) if f in self.features)
            self.known[word] = found
        return found

    def sentences(self, text: str):
        """``(start, stop, features)`` of the sentences that hold a feature, and the number of all sentences."""
        lower = text.lower()
        if not any(map(self.held, set(_WORD.findall(lower)))):
            return [], sum(1 for _ in _SENTENCE.finditer(text))
        found, n = [], 0
        for m in _SENTENCE.finditer(text):
            n += 1
            held = {f for w in _WORD.findall(m[0].lower()) for f in self.held(w)}
            if held:
                found.append((m.start(), m.end(), sorted(held)))
        return found, n

    def score(self, text: str | None):
        """Noisy-or score and the offending sentences; null and empty texts are one empty sentence."""
        if self.prior is not None:
            return self.prior, []
        found, n = self.sentences(text or "")
        quiet = max(n, 1) - len(found)
        log_clean = -quiet * np.log1p(np.exp(self.bias))
        offending = []
        for start, stop, held in found:
            z = self.bias + self.weights[held].sum()
            log_clean -= np.logaddexp(0.0, z)
            if _sigmoid(z) >= OFFENDING:
                offending.append({"start": start, "stop": stop, "score": float(_sigmoid(z))})
        return float(-np.expm1(log_clean)), offending


def _labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``per_label`` documents of either label outside the test fold."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most twice ``per_label`` rows of two numbers.
    chosen = F.broadcast(least_hashed(known, "toxic", "doc_id", per_label, 2))
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(chosen, "doc_id")


def _document_counts(sample: DataFrame) -> DataFrame:
    """``(feature, toxic, n)``: sample documents that hold a feature, summed within batches first."""

    def run(batches):
        for batch in batches:
            counts = ({}, {})
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = counts[toxic]
                for feature in {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}:
                    own[feature] = own.get(feature, 0) + 1
            for toxic in (0, 1):
                if counts[toxic]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list(counts[toxic])),
                            pa.array([toxic] * len(counts[toxic]), pa.int32()),
                            pa.array(list(counts[toxic].values()), pa.int64()),
                        ],
                        ["feature", "toxic", "n"],
                    )

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic"))
    return rows.mapInArrow(run, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )


def _bags(sample: DataFrame, features: dict[str, int]) -> pa.Table:
    """Per sample document its label, its quiet sentences and its sentences' features; at most the sample's size."""
    shared = sample.sparkSession.sparkContext.broadcast(features)

    def run(batches):
        model = Model(shared.value, np.zeros(len(shared.value)), 0.0)
        for batch in batches:
            rows = [model.sentences(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic").cast(pa.int32()),
                    pa.array([max(n, 1) - len(found) for found, n in rows], pa.int64()),
                    pa.array([[held for *_, held in found] for found, _ in rows], pa.list_(pa.list_(pa.int32()))),
                ],
                ["toxic", "quiet", "held"],
            )

    shape = "toxic int, quiet long, held array<array<int>>"
    return sample.select("text", "toxic").mapInArrow(run, shape).orderBy("toxic", "quiet", "held").toArrow()


def _train(bags: pa.Table, odds: np.ndarray, turns: int = 300, rate: float = 0.03):
    """Weights and bias that fit noisy-or to the labels: gradient steps with running moments from the log odds."""
    size = len(odds)
    y = bags.column("toxic").to_numpy().astype(float)
    quiet = bags.column("quiet").to_numpy().astype(float)
    held = bags.column("held").to_pylist()
    bag = np.array([k for k, sentences in enumerate(held) for _ in sentences], dtype=np.int64)
    sentences = [s for own in held for s in own]
    entry = np.array([k for k, s in enumerate(sentences) for _ in s], dtype=np.int64)
    column = np.array([f for s in sentences for f in s], dtype=np.int64)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    weights = np.append(np.minimum(odds, 6.0), -6.0)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, turns + 1):
        z = weights[size] + np.bincount(entry, weights[column], minlength=len(sentences))
        log_clean = -quiet * np.logaddexp(0, weights[size]) - np.bincount(bag, np.logaddexp(0, z), minlength=len(y))
        clean = np.exp(log_clean)
        # Slope of the loss in a sentence's z: its score for clean bags, blame by odds for toxic ones.
        pull = share * np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(y)
        slope = pull[bag] * _sigmoid(z)
        gradient = np.zeros(size + 1)
        gradient[:size] = np.bincount(column, slope[entry], minlength=size)
        gradient[size] = slope.sum() + (pull * quiet).sum() * _sigmoid(weights[size])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return weights[:size], float(weights[size])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Model from the texts and ``toxic`` labels of documents outside the test fold.

    Labels other than 0 and 1 and rows without text or id are not learnt from; a
    document labelled both ways counts as toxic.  With only one label, or no telling
    feature, every text gets the label's share as its score (0 without labels).
    """
    sample = checkpointed(_labelled_sample(docs, labels, per_label))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, np.zeros(0), 0.0, prior=1.0 if toxic else 0.0)
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    gain = F.col("toxic") / toxic * F.log(ratio)
    telling = (
        _document_counts(sample)
        .where((F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * toxic)) & (ratio >= LEAST_RATIO))
        .orderBy(F.desc(gain), "feature")
        .limit(MOST_FEATURES)
    )
    rows = telling.select("feature", F.log(ratio).alias("odds")).collect()
    features = {r["feature"]: k for k, r in enumerate(rows)}
    if not features:
        return Model({}, np.zeros(0), 0.0, prior=toxic / (toxic + clean))
    weights, bias = _train(_bags(sample, features), np.array([r["odds"] for r in rows]))
    return Model(features, weights, bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, offending)`` per row of ``docs``; the model is broadcast.

    ``offending`` lists start, stop (code points) and score of the sentences that are
    more likely toxic than not.  Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score: double, offending: array<struct<start: int, stop: int, score: double>>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.score(text) for text in texts], columns=["score", "offending"])

    found = docs.select("doc_id", run.asNondeterministic()(F.col("text")).alias("found"))
    return found.select("doc_id", "found.score", "found.offending")
