"""Dense vectors from a pluggable model, in Arrow batches.

A model is any object with ``embed_documents(texts)`` or ``encode(texts)``.
"""

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


class HashingEmbedder:
    """Deterministic feature hashing; stands in where no trained model is at hand."""

    def __init__(self, dim: int = 384):
        self.dim = dim
        self._slot = lru_cache(maxsize=100_000)(self._hash)

    def _hash(self, word):
        digest = hashlib.md5(word.encode("utf-8")).hexdigest()
        return int(digest[:8], 16) % self.dim, 1.0 if int(digest[8], 16) % 2 == 0 else -1.0

    def _embed(self, text):
        sums = [0.0] * self.dim
        for word in text.lower().split():
            slot, sign = self._slot(word)
            sums[slot] += sign
        norm = math.sqrt(sum(x * x for x in sums))
        return [x / norm for x in sums] if norm else sums

    def embed_documents(self, texts):
        return [self._embed(text) for text in texts]


def model_method(model):
    for name in ("embed_documents", "encode"):
        if hasattr(model, name):
            return getattr(model, name)
    raise AttributeError("the model has neither 'embed_documents' nor 'encode'")


def _one(embed, text):
    try:
        return [float(x) for x in embed([text])[0]]
    except Exception:
        return None


def _batch(embed, texts):
    """Vectors of a batch; if the batch fails, text by text with null on failure."""
    try:
        return [[float(x) for x in vector] for vector in embed(texts)]
    except Exception:
        return [_one(embed, text) for text in texts]


def embed_text(text: Column, load_model: Callable[[], object], batch_size: int = 256) -> Column:
    """``array<float>`` per text; ``load_model`` runs once per task.  Null texts give null, unseen by the model."""

    @F.arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        method = model_method(load_model())
        for texts in batches:
            rows = texts.to_pylist()
            given = [k for k, text in enumerate(rows) if text is not None]
            vectors = [None] * len(rows)
            for start in range(0, len(given), batch_size):
                places = given[start : start + batch_size]
                for k, vector in zip(places, _batch(method, [rows[k] for k in places])):
                    vectors[k] = vector
            yield pa.array(vectors, pa.list_(pa.float32()))

    # Non-deterministic to the optimizer: a filter on the result must not run the model again.
    return embed.asNondeterministic()(text)
