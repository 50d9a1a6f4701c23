"""A quality classifier of hashed subword vectors (operator 10).

A document is the average of learned vectors of its words, word pairs and character n-grams,
hashed to BUCKETS; a softmax layer turns the average into class probabilities. Vectors and layer
are trained with stochastic gradient descent on the driver, on a sample of at most MAX_TRAIN labelled
documents, one row each, whose packed features are at most MAX_PACKED bytes together. As average and layer are linear, scoring needs one number a bucket,
which is broadcast: its size is BUCKETS whatever the data's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import filter_rows, map_batches, mixed, saved, texts_of
from orderflow.llm.words import Words, gram_hashes, word_blocks

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
EPOCHS = 4
MAX_TRAIN = 6000
MAX_PACKED = 64 << 20
# Text whose features a worker makes at once: they take a hundred times its bytes, and what a worker
# has once taken it seldom gives back.
BLOCK_BYTES = 256 << 10
RATE = 0.5
# Vectors get the gradient of the average times this, or rare features would hardly move.
VECTOR_GAIN = 300.0
CHAR_SIZES = (3, 4)
KEPT_SCORE = 0.3


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of each feature of the texts of a block, kind by kind."""

    def buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
        salted = mixed(hashes + np.uint64(kind << 56))
        return (salted >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)

    hashes, text = words.hashes(), words.text_of()
    yield buckets(hashes, 1), text
    pairs = gram_hashes(hashes, 2)
    whole = text[: len(pairs)] == text[1:]
    yield buckets(pairs[whole], 2), text[: len(pairs)][whole]
    # Character n-grams lie within a word or take in the byte before or after it.
    data = words.data
    text_at = np.searchsorted(words.offsets, np.arange(len(data)), "right") - 1
    marks = np.zeros(len(data) + 1, np.int8)
    np.add.at(marks, words.starts, 1)
    np.add.at(marks, words.ends, -1)
    inside = np.cumsum(marks[:-1], dtype=np.int8) > 0
    plain = np.where(inside, data, np.uint8(32))
    for size in CHAR_SIZES:
        n = max(0, len(plain) - size + 1)
        packed = np.zeros(n, np.uint64)
        good = text_at[:n] == text_at[size - 1 : size - 1 + n]
        for k in range(size):
            packed = packed << np.uint64(8) | plain[k : k + n].astype(np.uint64)
            if 0 < k < size - 1:
                good &= inside[k : k + n]
        yield buckets(packed[good], size), text_at[:n][good]


@dataclass
class Model:
    """What a bucket adds to the log odds of class 1, on average over a text's features."""

    weights: np.ndarray
    bias: float

    def scores(self, words: Words) -> np.ndarray:
        n = len(words.first) - 1
        total, count = np.zeros(n), np.zeros(n)
        for bucket, text in features(words):
            total += np.bincount(text, self.weights[bucket], n)
            count += np.bincount(text, minlength=n)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """The different buckets of a text, sorted, and their counts: planes of bytes, compressed."""
    gaps = np.diff(buckets, prepend=np.int32(0)).astype("<u4").view(np.uint8).reshape(-1, 4)
    sizes = counts.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = np.concatenate([gaps.T[:3], sizes.T])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(7, -1)
    gaps = sum(planes[i].astype(np.int32) << 8 * i for i in range(3))
    return np.cumsum(gaps, dtype=np.int32), sum(planes[3 + i].astype(np.int64) << 8 * i for i in range(4))


@dataclass
class Learner:
    """Vectors, layer and bias, and one step of gradient descent."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    @classmethod
    def begin(cls, share: float, rng: np.random.Generator) -> Learner:
        vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
        bias = np.log(np.clip([1 - share, share], 1e-3, 1))
        return cls(vectors, rng.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS, bias)

    def step(self, buckets: np.ndarray, counts: np.ndarray, label: int, rate: float) -> None:
        part = counts / max(1, counts.sum())
        mean = part @ self.vectors[buckets]
        odds = mean @ self.layer + self.bias
        gap = np.exp(odds - odds.max())
        gap /= gap.sum()
        gap[label] -= 1
        self.vectors[buckets] -= rate * VECTOR_GAIN * np.outer(part, self.layer @ gap)
        self.layer -= rate * np.outer(mean, gap)
        self.bias -= rate * 0.1 * gap

    def model(self) -> Model:
        odds = self.layer[:, 1] - self.layer[:, 0]
        return Model((self.vectors @ odds).astype(np.float32), self.bias[1] - self.bias[0])


def descend(rows: list[tuple[bytes, int]], seed: int = 1) -> Model:
    """Stochastic gradient descent over (packed features, label), with a falling rate. Without rows
    all scores are one half."""
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    learner = Learner.begin(np.mean([label for _, label in rows]), rng)
    steps = EPOCHS * len(rows)
    for step in range(steps):
        if step % len(rows) == 0:
            order = rng.permutation(len(rows))
        blob, label = rows[order[step % len(rows)]]
        learner.step(*unpacked(blob), label, RATE * (1 - step / steps))
    return learner.model()


def counted(docs: DataFrame) -> DataFrame:
    """place, label, and the packed features of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at, upto, words in word_blocks(batch["text"], limit=BLOCK_BYTES):
                found = list(features(words))
                key = np.concatenate([t * np.int64(BUCKETS) + b for b, t in found])
                key, counts = np.unique(key, return_counts=True)
                cuts = np.searchsorted(key, np.arange(upto - at + 1) * BUCKETS)
                buckets = (key % BUCKETS).astype(np.int32)
                yield {
                    "place": batch["place"][at:upto],
                    "label": batch["label"][at:upto],
                    "packed": [packed(buckets[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])],
                }

    return map_batches(docs, run, "place int, label int, packed binary")


def sampled(docs: DataFrame, labels: DataFrame, label_col: str, max_train: int) -> DataFrame:
    """place, label, text: one row for each of the max_train labelled doc_ids with the smallest MD5,
    in that order. Of several rows of a doc_id the text with the smallest MD5 counts."""
    label = F.col(label_col).cast("double")
    sample = (
        labels.where(label.isin(0.0, 1.0) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .orderBy(F.md5(F.col("labelled").cast("string")), "labelled")
        .limit(max_train)
    )
    # max_train rows at most, whatever the data; so are the groups.
    texts = texts_of(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
    one = F.min(F.struct(F.md5("text"), "text"))["text"].alias("text")
    place = F.row_number().over(Window.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")).alias("place")
    return texts.groupBy("doc_id", "label").agg(one).select(place, "label", "text")


def train(
    docs: DataFrame, labels: DataFrame, label_col: str, max_train: int = MAX_TRAIN, max_packed: int = MAX_PACKED
) -> Model:
    """A model of labels (doc_id and 0 or 1 in label_col) of documents (doc_id, text).

    Fits on the max_train labelled doc_ids with the smallest MD5, so the same at any order of
    rows, or on the first of these whose packed features are max_packed bytes together; texts are
    taken whole. Labels that are null, of a null doc_id or of no document are left out; of several
    for a doc_id, the majority counts, and 1 in a tie; of several texts of a doc_id, one counts.
    Without labels all scores are one half.
    """
    found = saved(counted(sampled(docs, labels, label_col, max_train)), "features")
    taken = F.sum(F.octet_length("packed")).over(Window.orderBy("place")) <= max_packed
    rows = found.withColumn("taken", taken).where("taken").orderBy("place").select("packed", "label")
    return descend([(row["packed"], row["label"]) for row in rows.toLocalIterator()])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: the probability of class 1. One row per row of docs; a null or empty text
    has the score of no features; equal texts have equal scores."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at, upto, words in word_blocks(batch["text"], limit=BLOCK_BYTES):
                yield {"doc_id": batch["doc_id"][at:upto], "score": held.value.scores(words)}

    return map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, score double")


def keep(
    docs: DataFrame, model: Model, least: float = KEPT_SCORE, text_col: str = "text"
) -> DataFrame:
    """The rows of docs, with all columns, whose text has a score of least or more."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def good(batch: pa.RecordBatch) -> np.ndarray:
        column = batch[text_col].cast(pa.string()).fill_null("")
        parts = [held.value.scores(words) for _, _, words in word_blocks(column, limit=BLOCK_BYTES)]
        return np.concatenate([np.zeros(0), *parts]) >= least

    return filter_rows(docs, good)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; fold 0 is held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5
