"""Embedder interface (D-7, K1): documents DataFrame -> vectors DataFrame.

* ``TfIdfEmbedder`` -- the default; sparse long-form vectors (``Vectors``).
* ``DenseEmbedder`` -- wraps a per-batch model ``fn(list[str]) -> list[list[float]]`` as an
  Arrow-batched ``pandas_udf`` returning ``array<double>``; Spark partitions the documents,
  the model only ever sees one Arrow batch.
* ``create_embedder(name)`` -- factory by name; an unknown name is an error.
"""

from __future__ import annotations

from typing import Callable, NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_CONFIG, TFIDF_MODEL, PipelineConfig
from . import tfidf as tf


class DenseVectors(NamedTuple):
    vectors: DataFrame  # idea_id, vec array<double>
    dimensions: int
    model: str


class TfIdfEmbedder:
    model = TFIDF_MODEL

    def __init__(self, cfg: PipelineConfig = DEFAULT_CONFIG):
        self.cfg = cfg

    def fit_transform(self, ideas: DataFrame) -> tf.Vectors:
        return tf.tfidf(ideas, self.cfg)


class DenseEmbedder:
    """Per-document model applied batch-wise through a pandas UDF."""

    def __init__(self, model: str, fn: Callable[[list], list], dimensions: int):
        self.model = model
        self.fn = fn
        self.dimensions = dimensions

    def udf(self):
        fn = self.fn

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def embed(docs: pd.Series) -> pd.Series:
            return pd.Series([list(map(float, v)) for v in fn(docs.fillna("").tolist())])

        return embed

    def fit_transform(self, ideas: DataFrame) -> DenseVectors:
        docs = tf.documents(ideas)
        return DenseVectors(docs.select("idea_id", self.udf()("doc").alias("vec")), self.dimensions, self.model)


HELD_WORDS = 1 << 18


def hashing_model(dimensions: int = 64):
    """Signed feature hashing of tokens: dense vectors without a fitted vocabulary, unit length or zero.

    A word is hashed once a batch (of the last ``HELD_WORDS`` distinct ones), its repeats in a text are added at once.
    """
    import hashlib
    import re
    from collections import Counter

    def place(word):
        h = int.from_bytes(hashlib.md5(word.encode()).digest(), "big")
        return h % dimensions, 1.0 if (h >> 64) & 1 else -1.0

    def fn(docs):
        out, held, words = [], {}, re.compile("[a-z0-9]{3,}")
        for d in docs:
            v = [0.0] * dimensions
            for t, n in Counter(words.findall(d.lower())).items():
                at = held.get(t)
                if at is None:
                    if len(held) >= HELD_WORDS:
                        held.clear()
                    at = held[t] = place(t)
                v[at[0]] += at[1] * n  # whole numbers: exact in any order
            n = sum(x * x for x in v) ** 0.5
            out.append([x / n for x in v] if n > 0 else v)
        return out

    return fn


_REGISTRY: dict[str, Callable[[], object]] = {
    "tfidf": lambda: TfIdfEmbedder(),
    "hashing": lambda: DenseEmbedder("hashing_v1", hashing_model(64), 64),
}


def register_embedder(name: str, factory: Callable[[], object]) -> None:
    _REGISTRY[name] = factory


def create_embedder(name: str):
    if name not in _REGISTRY:
        raise ValueError(f"no embedder is registered as {name!r}; registered: {sorted(_REGISTRY)}")
    return _REGISTRY[name]()
