"""Supervised subword embeddings for document quality.

Every whitespace-separated word, every pair of neighbouring words and every 3-
and 4-byte string of a text is hashed to a bucket with a learned vector; all
pairs of a word with itself share one. A document is the average of its vectors
and of a few zero vectors, which keep short texts near the middle; a softmax layer turns it into class probabilities. Vectors and layer
are trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled rows, in one task; the driver sees the fitted model only.
Scoring reads whole texts in tasks: since the layer is linear in the average, a
bucket's vector and the layer fold into one weight.

Null and empty texts have no features and get the score of the zero vector.
Repeated rows are scored one by one; label rows without a label, or without a
document, teach nothing, and without any every score is 0.5. Extra columns pass
through scoring; a column that is called like the score is an error, and ``into``
gives another name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.stages import require_columns
from .sampling import hash_sample
from .words import CHUNK_BYTES, mixed, runs_of_texts, text_buffers

BUCKET_BITS = 16
DIMENSION = 8
EPOCHS = 3
#: Few labelled rows are gone through more often, for so many steps in all.
LEAST_STEPS = 4_000
RATE = 0.5
#: Step of the vectors against that of the layer.
VECTOR_STEP = 30.0
#: Zero vectors in every average.
PRIOR = 20
#: The model learns from about so many labelled rows, picked by hash, never from
#: twice as many, from texts of at most so many bytes each, and from so many bytes
#: in all.
SAMPLE_ROWS = 4_000
SAMPLE_TEXT_BYTES = 64 << 10
SAMPLE_BYTES = 64 << 20
SEED = 7
THRESHOLD = 0.3

_random = np.random.default_rng(SEED)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_PLACE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_GRAM = {3: np.uint32(0x9E3779B1), 4: np.uint32(0x85EBCA6B)}


class Model(NamedTuple):
    """Bucket vectors and the weights of the softmax layer (classes 0 and 1)."""

    vectors: np.ndarray
    layer: np.ndarray

    def weights(self) -> np.ndarray:
        """Per bucket, how much its vector speaks for class 1."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0])


def buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature buckets of a run of texts in four kinds (words, pairs of words,
    strings of 3 and of 4 bytes); each with the n+1 places where those of a
    text begin."""
    data = data[offsets[0] : offsets[-1]]
    inner = offsets - offsets[0]
    solid = data > 32
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = inner[:-1][inner[:-1] < len(data)]
    begins[firsts] = solid[firsts]
    starts = np.flatnonzero(begins)
    inside = np.flatnonzero(begins[solid])
    letters = data[solid]
    if len(inside):
        place = np.arange(len(letters), dtype=np.int32)
        place -= np.repeat(inside.astype(np.int32), np.diff(np.append(inside, len(letters))))
        words = mixed(np.add.reduceat(_BYTE[letters] * _PLACE[place & 255], inside))
    else:
        words = np.zeros(0, np.uint64)
    firsts = np.searchsorted(starts, inner)
    top = np.uint64(64 - BUCKET_BITS)
    yield (words >> top).astype(np.int32), firsts
    same_text = np.ones(max(0, len(words) - 1), bool)
    same_text[firsts[1:-1][(firsts[1:-1] > 0) & (firsts[1:-1] < len(words))] - 1] = False
    a, b = words[:-1], words[1:]
    pairs = np.where(a == b, np.uint64(0), mixed(a * _PAIR + b))[same_text]
    seen = np.concatenate([[0], np.cumsum(same_text)])
    yield (pairs >> top).astype(np.int32), seen[np.minimum(firsts, len(seen) - 1)]
    wide = data.astype(np.uint32)
    for size, factor in _GRAM.items():
        n = max(0, len(data) - size + 1)
        packed = np.zeros(n, np.uint32)
        for j in range(size):
            packed |= wide[j : j + n] << np.uint32(8 * j)
        keep = np.ones(n, bool)
        for j in range(1, size):
            across = inner[1:-1] - j
            keep[across[(across >= 0) & (across < n)]] = False
        grams = (packed[keep] * factor) >> np.uint32(32 - BUCKET_BITS)
        places = np.concatenate([[0], np.cumsum(keep)])[np.minimum(inner, n)]
        yield grams.astype(np.int32), places


def features(text: str) -> np.ndarray:
    data, offsets = text_buffers(pa.array([text], pa.string()))
    return np.concatenate([b for b, _ in buckets(data, offsets)])


def train(
    texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED
) -> Model:
    """Fit vectors and layer by gradient descent, one document at a time, with a
    rate that falls to nothing."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSION, 1 / DIMENSION, (1 << BUCKET_BITS, DIMENSION))
    layer = np.zeros((DIMENSION, 2))
    documents = []
    for text in texts:
        found, counts = np.unique(features(text), return_counts=True)
        documents.append((found, (counts / (counts.sum() + PRIOR)).astype(np.float32)))
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(texts))))
    steps, done = max(1, epochs * len(texts)), 0
    for _ in range(epochs if texts else 0):
        for i in random.permutation(len(texts)):
            found, share = documents[i]
            now = rate * (1 - done / steps)
            done += 1
            if not len(found):
                continue
            hidden = share @ vectors[found]
            logits = hidden @ layer
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = layer @ error
            layer -= now * np.outer(hidden, error)
            # The average passes little of the gradient to each of many vectors;
            # a step in proportion to a bucket's share makes up for that.
            vectors[found] -= now * VECTOR_STEP * np.outer(share, back)
    return Model(vectors, layer)


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, label, text`` of about ``rows`` labelled texts. Label rows are
    picked by hash first, so only their texts are read out of the documents, and
    only those are shuffled."""
    require_columns(docs, "doc_id", "text")
    require_columns(labels, "doc_id", label)
    picked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    )
    picked = hash_sample(picked, rows, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    short = texts.where(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    return short.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")


def fit(sampled: DataFrame) -> Model:
    """The model learned from rows of ``sample``, in one task. Rows count in the
    order of their hash, up to ``SAMPLE_BYTES``."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels, room = [], [], SAMPLE_BYTES
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                room -= len(text.encode())
                if room < 0:
                    break
                texts.append(text)
                labels.append(label)
        model = train(texts, labels)
        parts = [pa.array([part.tobytes()], pa.binary()) for part in model]
        yield pa.RecordBatch.from_arrays(parts, ["vectors", "layer"])

    keys = [F.xxhash64("doc_id", F.lit(SEED)), "doc_id", "label", "text"]
    one = sampled.repartition(1).sortWithinPartitions(*keys).select("label", "text")
    row = one.mapInArrow(learn, "vectors binary, layer binary").first()
    if row is None:
        return train([], [])
    return Model(*(np.frombuffer(part, np.float64).reshape(-1, width) for part, width in zip(row, (DIMENSION, 2))))


def score_texts(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """Add the probability of class 1 of every whole text."""
    require_columns(docs, text)
    if into in docs.columns:
        raise ValueError(f"column(s) already there: {into}")
    weights = model.weights()

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        data, offsets = text_buffers(column)
        out = np.zeros(len(column))
        for first, last in runs_of_texts(offsets, CHUNK_BYTES):
            total, count = np.zeros(last - first), np.zeros(last - first)
            for found, places in buckets(data, offsets[first : last + 1]):
                running = np.concatenate([[0.0], np.cumsum(weights[found])])
                total += running[places[1:]] - running[places[:-1]]
                count += np.diff(places)
            out[first:last] = 1 / (1 + np.exp(-total / (count + PRIOR)))
        return pa.array(out)

    return docs.withColumn(into, score(F.col(text).cast("string")))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents that no label is learned from: one in five, by checksum."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(5)) == 0


def fit_quality(docs: DataFrame, labels: DataFrame) -> Model:
    """The model learned from the labels of documents that are not held out."""
    return fit(sample(docs, labels.where(~held_out())))


def score_quality(docs: DataFrame, labels: DataFrame, into: str = "score") -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from a score of 0.3 on) to documents,
    by a model learned from the labels that are not held out."""
    if "predicted" in docs.columns:
        raise ValueError("column(s) already there: predicted")
    scored = score_texts(docs, fit_quality(docs, labels), into=into)
    return scored.withColumn("predicted", (F.col(into) >= THRESHOLD).cast("int"))
