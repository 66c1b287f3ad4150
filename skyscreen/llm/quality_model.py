"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

The n-grams are taken over two readings of the same words: the words in lower case, and their shapes (runs of capitals, of
other letters, of digits, and every other character as itself). Their hashes index one weight vector; a document is the
sparse vector of its square-root counts at unit length, and its score the logistic of a sparse dot product.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, give_back, spread, stored, text_chunks

#: Weights of the model; its size bounds all that is broadcast.
BUCKETS = 1 << 18
#: Labelled rows, at most about so many, that a model is trained on, and tasks that train on them side by side.
MAX_TRAIN, SHARDS = 16_000, 8

_CLASS = bytes(b"A"[0] if 65 <= c <= 90 else b"a"[0] if 97 <= c <= 122 or c >= 128 else b"0"[0] if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


class Features:
    """Hashes the n-grams of texts; what it knows of distinct words is kept, up to a bound."""

    def __init__(self, buckets: int = BUCKETS, cache: int = 400_000):
        self.mask, self.cache, self.known = np.uint64(buckets - 1), cache, {}
        self.hashes = np.zeros((0, 2), np.uint64)

    def _codes(self, words: list[bytes]) -> np.ndarray:
        codes = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            fresh = list(dict.fromkeys([words[k] for k in new]))
            if len(self.known) + len(fresh) > self.cache and self.known:
                self.known, self.hashes = {}, np.zeros((0, 2), np.uint64)
                return self._codes(words)
            base = len(self.known)
            rows = np.array([(zlib.crc32(w.lower()), zlib.crc32(_RUNS.sub(rb"\1", w.translate(_CLASS))) ^ 0x5BD1E995) for w in fresh], np.uint64)
            self.known.update(zip(fresh, range(base, base + len(fresh)), strict=True))
            self.hashes = np.concatenate((self.hashes, rows))
            codes[new] = np.fromiter((self.known[words[k]] for k in new), np.int64, len(new))
        return codes

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, value) of the features of all texts; each row has length one, empty texts have no features."""
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        codes = self._codes([w for ws in split for w in ws])
        h = self.hashes[codes]
        word, shape = h[:, 0], h[:, 1]
        mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & self.mask
        parts = [(doc, mix(word)), (doc, mix(shape))]
        for x in (word, shape):
            same = doc[1:] == doc[:-1]
            parts.append((doc[1:][same], mix(x[:-1] * np.uint64(3) + x[1:] * np.uint64(7) + np.uint64(1))[same]))
        same = doc[2:] == doc[:-2]
        parts.append((doc[2:][same], mix(shape[:-2] * np.uint64(5) + shape[1:-1] * np.uint64(11) + shape[2:] * np.uint64(13))[same]))
        key = np.concatenate([(d.astype(np.uint64) << np.uint64(32)) | b for d, b in parts])
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        value = np.sqrt(np.diff(first, append=len(key)).astype(np.float64))
        row, bucket = (key[first] >> np.uint64(32)).astype(np.int64), (key[first] & self.mask).astype(np.int64)
        length = np.sqrt(np.bincount(row, value * value, len(texts)))
        return row, bucket, value / length[row]


class Ftrl:
    """FTRL-proximal logistic regression over sparse rows."""

    def __init__(self, buckets: int = BUCKETS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.z, self.n, self.bias = np.zeros(buckets), np.zeros(buckets), [0.0, 0.0]
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def _weight(self, z, n):
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        """One update from a row with its constant term."""
        bz, bn = self.bias
        w, b = self._weight(self.z[at], self.n[at]), -bz / ((self.beta + math.sqrt(bn)) / self.alpha)
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ x) + b))))
        for g, n, put in (((p - label) * x, self.n[at], "rows"), (p - label, bn, "bias")):
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
            if put == "rows":
                self.z[at] += g - sigma * w
                self.n[at] += g * g
            else:
                self.bias = [bz + g - float(sigma) * b, bn + g * g]

    def weights(self) -> np.ndarray:
        """All weights, the constant last."""
        return np.append(self._weight(self.z, self.n), -self.bias[0] / ((self.beta + math.sqrt(self.bias[1])) / self.alpha))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, epochs: int = 3) -> np.ndarray:
    """The weights learned from labelled rows whose crc32(doc_id) mod 3 is not 1; only texts and labels are read.

    Rows are sampled by their hashed id down to about ``max_train`` and dealt to ``SHARDS`` tasks, each of which streams its
    rows through FTRL; the tasks' weights are averaged. Without labelled rows all weights are 0.
    """
    marked = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality")).where(crc_mod("doc_id", 3) != 1)
    n = marked.count()
    order = F.xxhash64("doc_id")
    if n > max_train:
        marked = marked.where(F.pmod(order, F.lit(1 << 20)) < int((1 << 20) * max_train / n))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(marked, "doc_id").withColumn("at", F.xxhash64("doc_id", "text"))
    rows = rows.repartition(SHARDS, F.pmod(order, F.lit(SHARDS))).sortWithinPartitions("at").select("text", "quality")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model, held, seen = Features(), Ftrl(), [], 0
        for batch in batches:
            marks = batch.column(1).to_pylist()
            for start, texts in text_chunks(batch):
                row, bucket, value = features.of(texts)
                cuts = np.searchsorted(row, np.arange(len(texts) + 1))
                for k in range(len(texts)):
                    at, x = bucket[cuts[k] : cuts[k + 1]], value[cuts[k] : cuts[k + 1]]
                    model.learn(at, x, float(marks[start + k]))
                    held.append((at.astype(np.int32), x.astype(np.float32), float(marks[start + k])))
                    seen += 1
        for _ in range(epochs - 1):
            for at, x, label in held:
                model.learn(at, x, label)
        if seen:
            w = model.weights()
            some = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(w[some] * seen), pa.array(np.full(len(some), seen))], names=["bucket", "w", "n"])

    shards = rows.mapInArrow(fit, "bucket int, w double, n long")
    total = stored(shards, "quality-weights")
    # the constant's bucket comes from every shard that saw a row, so its counts sum to all rows
    got = total.groupBy("bucket").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).toPandas()
    weights = np.zeros(BUCKETS + 1)
    if len(got):
        weights[got["bucket"].to_numpy()] = got["w"].to_numpy() / max(int(got["n"].max()), 1)
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every row: the chance of label 1, for empty and null texts that of the constant alone."""
    light = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for start, texts in text_chunks(batch):
                row, bucket, value = features.of(texts)
                logit = np.bincount(row, light[bucket] * value, len(texts)) + float(light[-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))], names=["doc_id", "score"])
        give_back()

    narrow = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return narrow.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts score by the constant alone, very long ones are read whole; null ids stay null and have no label; of
    labels that disagree on one id the lower counts, and repeated rows of it are each a row to learn from; rows that are equal
    score alike, and a score of exactly 0.5 is predicted 1; without labelled rows every score is 0.5; an empty table gives an
    empty result; other columns, of whatever name, are ignored.
    """
    scored = score(docs, train(docs, labels, max_train))
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
