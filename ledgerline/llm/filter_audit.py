"""Filter interaction audit by a Gray-code subset walk (operator 11).

Every document gets a mask of the filters it fails. Documents of one part with
the same mask are one cell, so a part has at most 2**k cells for k filters,
whatever its number of documents. A Gray code visits all 2**k subsets of
active filters by toggling one filter at a time: each cell keeps a counter of
the active filters that it fails, and a running total of survivors gains or
loses the cells whose counter reaches or leaves zero. The survivors of all
subsets are stored (32 states for five filters); a step of an order is the
difference of two states, an order the walk from the empty to the full subset.

The filter of repeated texts fails a document whose text some smaller id has,
anywhere in the table. Texts are told apart by their SHA-256. The smallest id
of each text comes from one aggregate (combined map-side), and the documents
that carry it from a join on (text, id): no key of that join is hot, however
often a text occurs. Cells are signed sums: all documents fail the filter,
less those found by the join.

Defined results: a null text counts as empty; empty texts equal each other. A
null part is the empty string. A null id is larger than all others: it fails
the filter of repeated texts if some id has its text. Rows that repeat one id
with one text are not smaller than each other. Label rows of one document
count as one, quality and toxic as their largest; null labels are none. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
GAPS = "\t\n\x0b\x0c\r"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def quality_failures(text: Column) -> list[Column]:
    """Failure conditions A to D over the columns ``words`` and ``text``."""
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        words < 200,
        F.lit(100) * distinct < F.lit(50) * words,
        F.lit(100) * capitals > F.lit(3) * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def masked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, key, mask, good, toxic): every document with its failures of
    the filters that one text decides, and its labels."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    split = rows.withColumn("words", F.array_remove(F.split(F.translate("text", GAPS, " " * len(GAPS)), " "), ""))
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(quality_failures(F.col("text")))), F.lit(0))
    features = split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), mask.cast("int").alias("mask"))
    marked = labels.where("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    joined = features.join(marked, F.col("id") == F.col("label_id"), "left")
    return joined.select("id", "part", "key", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def failure_cells(rows: DataFrame, repeated: int) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failures. ``repeated``
    is the bit of the filter of repeated texts."""
    totals = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    signed = lambda df, mask, sign: df.select("part", mask.alias("mask"), *[(F.col(c) * sign).alias(c) for c in MEASURES])
    first = rows.groupBy(F.col("key").alias("first_key")).agg(F.min("id").alias("first_id"))
    fresh = rows.join(first, (F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id")))
    every, fresh = rows.groupBy("part", "mask").agg(*totals), fresh.groupBy("part", "mask").agg(*totals)
    with_bit = F.col("mask").bitwiseOR(F.lit(repeated))
    cells = signed(every, with_bit, 1).unionAll(signed(fresh, with_bit, -1)).unionAll(signed(fresh, F.col("mask"), 1))
    return cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in MEASURES])


def survivors(masks: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """What survives each subset of active filters: row ``s`` holds the summed
    weights of the cells that fail none of the filters in the bit set ``s``."""
    states = np.zeros((1 << filters, weights.shape[1]), np.int64)
    active_failures = np.zeros(len(masks), np.int64)
    running = weights.sum(axis=0)
    subset = 0
    states[0] = running
    for i in range(1, 1 << filters):
        bit = (i & -i).bit_length() - 1  # the one filter in which neighbouring Gray codes differ
        subset ^= 1 << bit
        failing = (masks >> bit) & 1 == 1
        if subset >> bit & 1:
            running = running - weights[failing & (active_failures == 0)].sum(axis=0)
            active_failures[failing] += 1
        else:
            active_failures[failing] -= 1
            running = running + weights[failing & (active_failures == 0)].sum(axis=0)
        states[subset] = running
    return states


def order_steps(letters: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """For every step of every order: the order, step number, the bit of its
    filter and the subset that was active before it."""
    names, steps, bits, before = [], [], [], []
    for order in permutations(range(len(letters))):
        active = 0
        for step, bit in enumerate(order):
            names.append("".join(letters[b] for b in order))
            steps.append(step + 1)
            bits.append(bit)
            before.append(active)
            active |= 1 << bit
    return names, np.array(steps, np.int32), np.array(bits), np.array(before)


def step_report(states: np.ndarray, bits: np.ndarray, before: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every step as differences of the stored states."""
    full = len(states) - 1
    one = 1 << bits
    lost = states[before] - states[before | one]
    removed = lost[:, 0]
    by_filter = np.zeros(int(bits.max()) + 1, np.int64)
    np.add.at(by_filter, bits, removed)
    return {
        "kept": states[before | one][:, 0], "removed": removed, "redundant": states[0, 0] - states[one][:, 0] - removed,
        "unique_fails": states[full ^ one][:, 0] - states[full, 0], "good_lost": lost[:, 1], "toxic_lost": lost[:, 2], "shapley": by_filter[bits],
    }


def audit(cells: DataFrame, letters: str = FILTERS) -> DataFrame:
    """The report of all orders of the filters, by part."""
    names, steps, bits, before = order_steps(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                masks = np.array([c["mask"] for c in held], np.int64)
                weights = np.array([[c[m] for m in MEASURES] for c in held], np.int64)
                report = step_report(survivors(masks, weights, len(letters)), bits, before)
                columns = {"part": pa.array([part] * len(names), pa.string()), "filter_order": pa.array(names), "step": pa.array(steps)}
                yield pa.record_batch(columns | {k: pa.array(v) for k, v in report.items()})

    # at most 2**k cells a part, however many documents it has
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return by_part.mapInArrow(run, RESULT)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    rows = written(masked(docs, labels, id_col, text_col, part_col), "filter-masks")
    return audit(failure_cells(rows, 1 << FILTERS.index("E")))
