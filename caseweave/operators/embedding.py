"""Text to vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import plain_spaces
from caseweave.sources.tables import overwrite

N_FEATURES = 256


@dataclass(frozen=True)
class Embedder:
    """Hashed words, weighted by rarity: in how many of ``n_docs`` texts each feature occurs.

    The counts are exact, so embedders of parts of a corpus add up to that of the whole, and a stream or a
    resumed build that keeps its embedder gives a text the same vector as before.
    """

    n_docs: int
    frequencies: tuple[int, ...]

    @property
    def n_features(self) -> int:
        return len(self.frequencies)

    def weights(self) -> np.ndarray:
        return np.log((self.n_docs + 1) / (np.array(self.frequencies, np.int64) + 1))

    def __add__(self, other: Embedder) -> Embedder:
        if other.n_features != self.n_features:
            raise ValueError("embedders with different numbers of features")
        both = zip(self.frequencies, other.frequencies, strict=True)
        return Embedder(self.n_docs + other.n_docs, tuple(a + b for a, b in both))


def save_embedder(spark: SparkSession, model: Embedder, path: str) -> None:
    rows = [(model.n_docs, list(model.frequencies))]
    overwrite(spark.createDataFrame(rows, "n_docs bigint, frequencies array<bigint>"), path)


def load_embedder(spark: SparkSession, path: str) -> Embedder:
    row = spark.read.schema("n_docs bigint, frequencies array<bigint>").parquet(path).first()
    return Embedder(row["n_docs"], tuple(row["frequencies"]))


def word_feature(word: str, n_features: int) -> int:
    """The feature of a word: its md5's first 32 bits, modulo the number of features."""
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % n_features


def _kernel(n_features: int):
    """A function used inside tasks, as a closure so that it travels with the task."""

    def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every word; each different word of a batch is hashed once."""
        flat = words.flatten().dictionary_encode()
        own = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % n_features for w in flat.dictionary.to_pylist()]
        sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(words)), sizes), np.array(own, np.int64)[flat.indices.to_numpy()]

    return features


def _words(text: Column) -> Column:
    words = F.split(plain_spaces(F.lower(F.coalesce(text, F.lit("")))), " ")
    return F.array_remove(words, "")


def fit_embedder(df: DataFrame, text: str, n_features: int = N_FEATURES) -> Embedder:
    """Embedder without outside weights.  One aggregate over the texts; the model is ``n_features`` numbers."""
    features = _kernel(n_features)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(n_features, np.int64), 0
        for batch in batches:
            row, feature = features(batch.column("words"))
            once = np.unique(row * n_features + feature)
            total += np.bincount(once % n_features, minlength=n_features)
            n += batch.num_rows
        found = np.flatnonzero(total)  # -1 counts the texts
        yield pa.record_batch(
            {"feature": np.append(found, -1).astype(np.int32), "n": np.append(total[found], n)}
        )

    counted = df.select(_words(F.col(text)).alias("words")).mapInArrow(count, "feature int, n bigint")
    counts = {r["feature"]: r["n"] for r in counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    return Embedder(counts.get(-1, 0), tuple(counts.get(i, 0) for i in range(n_features)))


def embed(df: DataFrame, text: str, model: Embedder, out: str = "embedding") -> DataFrame:
    """``df`` with an ``array<float>`` vector of unit length per row (zeros without a word of weight); no shuffle."""
    n_features, weights, features = model.n_features, model.weights(), _kernel(model.n_features)
    held = max(1, (8 << 20) // n_features)  # rows of a dense block

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for start in range(0, len(batch), held):
                words = batch.slice(start, held)
                row, feature = features(words)
                counts = np.bincount(row * n_features + feature, minlength=len(words) * n_features)
                rows = counts.reshape(len(words), n_features) * weights
                norm = np.sqrt((rows**2).sum(axis=1))
                rows[norm > 0] /= norm[norm > 0, None]
                offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * n_features)
                parts.append(pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.float32).ravel())))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    # declared non-deterministic so that the optimizer never evaluates it a second time
    return df.withColumn(out, vectors.asNondeterministic()(_words(F.col(text))))


def embed_with(
    df: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[list[str]], list]],
    out: str = "embedding",
    batch_size: int = fixed.EMBED_BATCH_SIZE,
) -> DataFrame:
    """Vectors from a user's own model.

    ``load_model`` is called once per task and returns a function from a list of texts to their
    vectors, which gets at most ``batch_size`` texts at a time.  Only the text column is sent to
    Python.
    """

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load_model()
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            rows: list = []
            for start in range(0, len(texts), batch_size):
                part = model(texts[start : start + batch_size])
                rows += [[float(x) for x in row] for row in part]
            yield pa.array(rows, pa.list_(pa.float32()))

    return df.withColumn(out, vectors.asNondeterministic()(F.col(text)))
