"""Language ID as a mixture of languages inferred by EM (operator 3).

Every language's n-gram distribution is learned from the documents that may
teach: runs of ``order`` signs of the lower-cased letters (other bytes count as
one space), hashed into ``2**bits`` buckets, counted over all training texts
and smoothed. A text is taken as a mixture: with its n-gram counts c and the
languages' likelihoods, expectation-maximisation finds the proportions that
make it likeliest. The languages are selected by penalised likelihood: from
the full set, the least is dropped and the rest estimated anew, and the set
with the best log-likelihood less ``penalty * log(n-grams)`` per language is
kept. The prediction is the largest proportion, and its score that proportion.

The model is ``2**bits`` numbers for each language, and the number of
languages is checked against ``max_languages`` before it is gathered, so what
travels with the tasks has a fixed bound.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if no language could be learned. Rows without lang or text teach nothing.
Ties go to the language that sorts first. Repeated rows are predicted alike.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

U = np.uint64
UNKNOWN = "und"
CHUNK_BYTES = 1 << 20
_ASCII = np.full(256, 0x20, np.uint8)
_ASCII[97:123] = np.arange(97, 123)
_ASCII[65:91] = np.arange(97, 123)
_ASCII[128:] = np.arange(128, 256)


def buckets(s: tokens.Slice, order: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the n-grams of a slice, ordered by text."""
    kind = _ASCII[s.data]
    before = np.r_[np.uint8(0), kind[:-1]]
    opens = np.zeros(len(kind) + 1, bool)
    opens[s.offsets] = True
    keep = (kind != 0x20) | (before != 0x20) | opens[:-1]  # one space for a run
    kind, doc = kind[keep], np.repeat(np.arange(s.n_texts), np.diff(np.r_[0, np.cumsum(keep)][s.offsets]))
    n = len(kind) - order + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    code = np.zeros(n, U)
    for k in range(order):
        code = code * U(257) + kind[k:k + n].astype(U)
    bucket = (tokens.mix(code) >> U(64 - bits)).astype(np.int64)
    whole = doc[:n] == doc[order - 1:]
    key, count = np.unique((doc[:n][whole] << bits) | bucket[whole], return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), count


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, may_teach: Column, lang_col: str = "lang", text_col: str = "text", order: int = 3, bits: int = 16, max_languages: int = 512) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities by language and bucket)."""
    rows = docs.where(may_teach).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for s in tokens.slices(batch.column(1), slice_bytes=CHUNK_BYTES):
                doc, bucket, n = buckets(s, order, bits)
                cut = np.searchsorted(doc, np.arange(s.n_texts + 1))
                for i in range(s.n_texts):
                    at = slice(cut[i], cut[i + 1])
                    total = totals.setdefault(langs[s.row + i], np.zeros(1 << bits, np.int64))
                    total[bucket[at]] += n[at]
        for lang, total in totals.items():
            full = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(total[full])], names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(tokens.tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_lang = counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))  # at most 2**bits entries
    found = by_lang.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"over {max_languages} languages; raise max_languages")
    found.sort(key=lambda r: r.lang)
    table = np.zeros((len(found), 1 << bits))
    for k, r in enumerate(found):
        for bucket, n in r.counts:
            table[k, bucket] = n
    smooth = table + 0.05 if len(found) else table
    return [r.lang for r in found], np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)


def _em(doc_first: np.ndarray, doc: np.ndarray, weight: np.ndarray, p: np.ndarray, active: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of each text over its active languages.
    ``p`` is each n-gram's likelihoods, up to a factor of its own."""
    mix = active / active.sum(1, keepdims=True)
    total = np.add.reduceat(weight, doc_first)
    for _ in range(rounds):
        joint = p * mix[doc]
        share = joint * (weight / np.maximum(joint.sum(1), 1e-300))[:, None]
        mix = np.add.reduceat(share, doc_first) / total[:, None]
    fit = np.add.reduceat(weight * np.log(np.maximum((p * mix[doc]).sum(1), 1e-300)), doc_first)
    return mix, fit


def proportions(doc: np.ndarray, bucket: np.ndarray, weight: np.ndarray, model: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have n-grams, their selected proportions by language)."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    texts, local = doc[first], np.cumsum(np.r_[False, doc[1:] != doc[:-1]])
    logs = model[:, bucket].T.astype(np.float64)
    p = np.exp(logs - logs.max(1, keepdims=True))
    weight = weight.astype(np.float64)
    size = np.add.reduceat(weight, first)
    cost = penalty * np.log(np.maximum(size, 2))
    active = np.ones((len(texts), len(model)))
    best, best_value = active / len(model), np.full(len(texts), -np.inf)
    open_ = np.ones(len(texts), bool)
    while open_.any():
        rows = open_[local]
        sub_first = np.flatnonzero(np.r_[True, np.diff(local[rows]) > 0])
        sub = np.cumsum(np.r_[False, np.diff(local[rows]) > 0])
        here = np.flatnonzero(open_)
        mix, fit = _em(sub_first, sub, weight[rows], p[rows], active[here], rounds)
        value = fit - cost[here] * active[here].sum(1)
        better = value > best_value[here]
        best[here[better]], best_value[here[better]] = mix[better], value[better]
        # drop all that are next to nothing, and the least of the others
        least = np.where(active[here] > 0, mix, np.inf)
        drop = least <= np.maximum(least.min(1, keepdims=True), 1e-3)
        drop[np.arange(len(here)), mix.argmax(1)] = False
        active[here] = np.where(drop, 0.0, active[here])
        left = active[here].sum(1)
        # a set of one that has been valued is the last
        open_[here[~drop.any(1) | (left < 1)]] = False
    return texts, best


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", order: int = 3, penalty: float = 2.0, rounds: int = 12) -> DataFrame:
    """(id, lang_pred, score, mixture) per document; the mixture is a map from
    the selected languages to their proportions."""
    bits = max(model.shape[1] if len(langs) else 2, 2).bit_length() - 1
    names = ["id", "lang_pred", "score", "mixture"]
    kind = pa.map_(pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            pred, score, mixture = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for s in tokens.slices(batch.column(1), slice_bytes=CHUNK_BYTES):
                doc, bucket, n = buckets(s, order, bits)
                if not len(doc) or not langs:
                    continue
                texts, mix = proportions(doc, bucket, n, model, penalty, rounds)
                for t, row in zip(texts.tolist(), mix):
                    if lettered[s.row + t]:
                        k = int(row.argmax())
                        pred[s.row + t], score[s.row + t] = langs[k], min(1.0, float(row[k]))
                        mixture[s.row + t] = [(langs[j], float(row[j])) for j in np.flatnonzero(row > 1e-3)]
            # letters, but too few for an n-gram: the first language, by nothing
            for i in range(batch.num_rows):
                if lettered[i] and pred[i] == UNKNOWN and langs:
                    pred[i], score[i] = langs[0], 1 / len(langs)
            yield pa.record_batch([batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(mixture, kind)], names=names)

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), has_letter(text).alias("lettered"))
    return rows.mapInArrow(tokens.tidy(run), "id long, lang_pred string, score double, mixture map<string,double>")
