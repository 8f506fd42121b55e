"""Quality classifier: hashed word n-grams, logistic regression by follow the
regularised leader (operator 8).

A text's features are its words and word pairs, lower-cased, and the same for
the words' shapes (runs of small letters, capitals and digits shortened to one
sign each, other signs kept, so ``Word%%%`` becomes ``Aa%``), and a mark on a
word that repeats the one before it. Each is hashed into ``2**bits`` buckets;
a feature's value is its share of the text's words. Training sees a bounded
sample: about ``max_train_rows`` labelled rows, chosen by a hash of the id, go
to one task, which runs ``epochs`` passes of FTRL-proximal in hash order. The
weights (at most ``2**bits`` numbers) travel with the scoring tasks, where a
score is a sparse dot product per text, over whole texts.

Defined results: null and empty texts have no features, so their score is the
bias's. A label that is null is not used; a document with several label rows
is several examples; without any usable label every score is 0.5. Repeated
rows are scored alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import column

U = np.uint64
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[65:91] = 65
SHAPE[48:58] = 48
SALTS = {name: U(i * 0x9E3779B97F4A7C15 % 2**64) for i, name in enumerate(("word", "pair", "shape", "shapes", "again"), 1)}


def _shapes(s: tokens.Slice) -> tokens.Slice:
    """The slice with every word shortened to its shape."""
    kind = SHAPE[s.data]
    inside = np.zeros(len(kind) + 1, np.int8)
    inside[s.starts] += 1
    inside[s.ends] -= 1
    keep = np.cumsum(inside[:-1]).astype(bool)
    change = np.r_[True, kind[1:] != kind[:-1]]
    change[s.starts] = True
    keep &= change
    place = np.r_[0, np.cumsum(keep)]
    return tokens.Slice(s.row, kind[keep], place[s.offsets], place[s.starts], place[s.ends], s.first)


def features(s: tokens.Slice, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every feature occurrence of a slice, by text."""
    lowered = tokens.Slice(s.row, tokens.LOWER[s.data], s.offsets, s.starts, s.ends, s.first)
    word, shape = tokens.word_hashes(lowered), tokens.word_hashes(_shapes(s))
    doc = s.text_of_word()
    if not len(doc):
        return np.zeros(0, int), np.zeros(0, int)
    inner = np.r_[False, doc[1:] == doc[:-1]]
    pair = lambda h: tokens.mix(np.r_[h[:1], h[:-1]] * U(3) + h)
    again = inner & np.r_[False, word[1:] == word[:-1]]
    columns = [(word, "word", True), (pair(word), "pair", inner), (shape, "shape", True), (pair(shape), "shapes", inner), (np.ones(len(word), U), "again", again)]
    bucket = np.stack([(tokens.mix(h ^ SALTS[name]) >> U(64 - bits)).astype(np.int64) for h, name, _ in columns], 1)
    valid = np.stack([np.broadcast_to(ok, len(word)) for *_, ok in columns], 1)
    return np.repeat(doc, valid.sum(1)), bucket[valid]


def _examples(batches: Iterator[pa.RecordBatch], bits: int):
    """(buckets, values, label) of each labelled text."""
    for batch in batches:
        label = batch.column(1).to_pylist()
        for s in tokens.slices(batch.column(0)):
            doc, bucket = features(s, bits)
            cut = np.searchsorted(doc, np.arange(s.n_texts + 1))
            for i, n in enumerate(s.counts):
                index, count = np.unique(bucket[cut[i]:cut[i + 1]], return_counts=True)
                yield index.astype(np.int32), (count / max(n, 1)).astype(np.float32), label[s.row + i]


class Ftrl:
    """FTRL-proximal for logistic loss; the bias is the last coordinate."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - sigma * w
        self.n[index] += g * g


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          bits: int = 18, max_train_rows: int = 10_000, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.0) -> np.ndarray:
    """Weights, the bias last. ``may_learn`` is a condition on ``id_col``."""
    size = 1 << bits
    usable = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id is not null and _label is not null")
    usable = usable.withColumnRenamed("_id", id_col).where(may_learn).withColumnRenamed(id_col, "_id")
    share = min(1.0, max_train_rows / max(1, usable.count()))
    chosen = usable.withColumn("_order", F.xxhash64("_id")).where(F.col("_order") <= F.lit(min(2**63 - 1, int(-2**63 + share * 2**64))))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").select("_text", "_label", "_order", "_id")  # about max_train_rows rows of three numbers

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, examples = Ftrl(size, alpha, beta, l1, l2), list(_examples(batches, bits))
        for _ in range(epochs):
            for index, value, label in examples:
                model.learn(np.append(index, size), np.append(value, np.float32(1)), label)
        w = model.weights()
        kept = np.flatnonzero(w)
        yield pa.record_batch([pa.array(kept, pa.int32()), pa.array(w[kept])], names=["bucket", "weight"])

    fitted = rows.repartition(1).sortWithinPartitions("_order", "_id", "_text", "_label").select("_text", "_label").mapInArrow(tokens.tidy(fit), "bucket int, weight double")
    out = np.zeros(size + 1, np.float32)
    for bucket, weight in fitted.collect():
        out[bucket] = weight
    return out


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", passing: list[str] = ()) -> DataFrame:
    """(id, score, *passing): probability of label 1 for every whole text."""
    bits = int(len(weights) - 1).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for s in tokens.slices(batch.column(1)):
                doc, bucket = features(s, bits)
                total = np.bincount(doc, weights[bucket], s.n_texts) / np.maximum(s.counts, 1)
                out[s.row:s.row + s.n_texts] = 1 / (1 + np.exp(-np.clip(total + weights[-1], -35, 35)))
            yield pa.record_batch([batch.column(0), pa.array(out), *[batch.column(k) for k in place]], names=names)

    others = [c for c in passing if c != text_col]  # the text itself travels once
    place = [1 if c == text_col else 2 + others.index(c) for c in passing]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text"), *[column(c).alias(f"o{i}") for i, c in enumerate(others)])
    schema = "id long, score double" + "".join(f", c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(passing))
    names = ["id", "score", *[f"c{i}" for i in range(len(passing))]]
    return rows.mapInArrow(tokens.tidy(run), schema)


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, unchanged, whose score reaches the threshold."""
    scored = score(docs, weights, id_col, text_col, docs.columns)
    return scored.where(F.col("score") >= threshold).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
