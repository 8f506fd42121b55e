"""SimHash near-dedup over a Gray-ordered hierarchical index (operator 10).

Fingerprints are made in Arrow tasks, one row per document. Two fingerprints
at most ``max_bits`` apart agree on at least one of ``max_bits + 1`` blocks of
bits, and again on one of as many sub-blocks of the other bits; each distinct
fingerprint is dealt out once per (block, sub-block) under the bits it must
share there. Within such a group the fingerprints are sorted by Gray rank and
indexed: a node keeps the bits on which all below it agree (a mask and a
pattern), the differences to another node's pattern are accumulated from the
root down, and a pair of nodes whose fixed bits already differ in more than
``max_bits`` places is pruned as a whole, while one that can't differ in more
is linked as a whole. A group yields one edge per member, never all pairs.
Components come from alternating large-star and small-star joins.

Defined results: null or empty text, or one without words, has fingerprint 0
and links like any other. Repeated rows are copies. A null id never becomes a
component's id unless all its documents have none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .store import column, written

U = np.uint64
LANES = U(0x0101010101010101)
FANOUT = 8
MAX_PAIRS = 1 << 20


# --- fingerprints ------------------------------------------------------------


def shingle_hashes(s: tokens.Slice, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a slice, and the shingle count of each text."""
    joined, starts, ends = tokens.join_words(s)
    n = s.counts
    per_text = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    begin = np.repeat(s.first[:-1] - np.cumsum(per_text) + per_text, per_text) + np.arange(per_text.sum())
    last = np.minimum(begin + shingle, np.repeat(s.first[1:], per_text)) - 1
    cut = map(joined.__getitem__, map(slice, starts[begin].tolist(), ends[last].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), U, len(begin)), per_text


def majority(h: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Bit by bit: set if over half of a text's hashes have it set.

    Eight bits are counted at once, one in each byte of a word, over runs of
    at most 255 hashes; the runs' counts are then added up per text."""
    out = np.zeros(len(per_text), U)
    full = np.flatnonzero(per_text)
    if not len(full):
        return out
    first = np.cumsum(per_text) - per_text
    runs = -(-per_text[full] // 255)
    run_first = np.cumsum(runs) - runs
    at = np.repeat(first[full], runs) + 255 * (np.arange(runs.sum()) - np.repeat(run_first, runs))
    for bit in range(8):
        lanes = np.add.reduceat((h >> U(bit)) & LANES, at).view(np.uint8).reshape(-1, 8)
        count = np.add.reduceat(lanes.astype(np.int64), run_first, axis=0)
        for byte in range(8):
            out[full] |= (2 * count[:, byte] > per_text[full]).astype(U) << U(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, rid, fp): the 64-bit SimHash of every row's whole text, as a long;
    rid is a hash of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [majority(*shingle_hashes(s, shingle, seed)) for s in tokens.slices(batch.column(2), lower=True)]
            fp = np.concatenate(made) if made else np.zeros(0, U)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], names=["id", "rid", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_hash(id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokens.tidy(run), "id long, rid long, fp long")


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- the index ---------------------------------------------------------------


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(max_bits: int) -> list[int]:
    """Masks of the bits that a pair at most ``max_bits`` apart shares under at
    least one of them: a block, and a sub-block of the bits outside it."""
    parts = max_bits + 1
    cut = lambda bits: [bits[len(bits) * i // parts:len(bits) * (i + 1) // parts] for i in range(parts)]
    masks = []
    for block in cut(list(range(64))):
        rest = [b for b in range(64) if b not in set(block)]
        masks += [sum(1 << b for b in block + sub) for sub in cut(rest)]
    return masks


def gray_rank(fp: Column) -> Column:
    """Position of a bit pattern in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


class GrayIndex:
    """Levels over fingerprints sorted by (group, Gray rank). Level 0 is the
    fingerprints themselves; a node of a level has up to FANOUT neighbours of
    the level below, all of one group. Nodes keep the shared bits."""

    def __init__(self, fp: np.ndarray, group: np.ndarray):
        self.levels = [(fp, np.full(len(fp), U(2**64 - 1)), None)]
        while len(group) > 1 and (group[1:] == group[:-1]).any():
            new = np.r_[True, group[1:] != group[:-1]]
            begin = np.flatnonzero(new)
            within = np.arange(len(group)) - np.repeat(begin, np.diff(np.r_[begin, len(group)]))
            heads = np.flatnonzero(within % FANOUT == 0)
            pattern, mask, _ = self.levels[-1]
            ones = np.bitwise_and.reduceat(pattern & mask, heads)
            zeros = np.bitwise_and.reduceat(~pattern & mask, heads)
            self.levels.append((ones, ones | zeros, np.r_[heads, len(group)]))
            group = group[heads]

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions that connect all fingerprints of a group which
        lie within ``max_bits`` of each other."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                yield a, b
                continue
            if len(a) > MAX_PAIRS:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            bounds = self.levels[level][2]
            width_a, width_b = bounds[a + 1] - bounds[a], bounds[b + 1] - bounds[b]
            total = width_a * width_b
            pair = np.repeat(np.arange(len(a)), total)
            k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            left, right = bounds[a][pair] + k // width_b[pair], bounds[b][pair] + k % width_b[pair]
            keep = (left < right) if level == 1 else (left <= right)
            left, right = left[keep], right[keep]
            pattern, mask, _ = self.levels[level - 1]
            fixed = mask[left] & mask[right]
            differ = np.bitwise_count((pattern[left] ^ pattern[right]) & fixed)
            near = differ <= max_bits
            left, right, most = left[near], right[near], differ[near] + (64 - np.bitwise_count(fixed[near]).astype(int))
            whole = (most <= max_bits) & (level > 1)
            if whole.any():
                yield from self._all(level - 1, left[whole], right[whole])
            stack.append((level - 1, left[~whole], right[~whole]))

    def _all(self, level: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything below ``a`` and ``b`` links: tie it to the first below ``a``."""
        span = []
        for x in (a, b):
            lo, hi = x, x + 1
            for k in range(level, 0, -1):
                lo, hi = self.levels[k][2][lo], self.levels[k][2][hi]
            span.append((lo, hi))
        head = span[0][0]
        for lo, hi in span:
            n = hi - lo
            yield np.repeat(head, n), np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def local_components(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position reachable from each, over pairs given in pieces."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    return label


def _group_edges(max_bits: int):
    def edges(fp: np.ndarray, key: np.ndarray) -> pa.RecordBatch | None:
        new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
        group = np.cumsum(new)
        shared = np.bincount(group)[group] > 1
        fp, group = fp[shared], group[shared]
        if not len(fp):
            return None
        label = local_components(len(fp), GrayIndex(fp.view(U), group).links(max_bits))
        other = np.flatnonzero(label != np.arange(len(fp)))
        return pa.record_batch([pa.array(fp[other]), pa.array(fp[label[other]])], names=["a", "b"]) if len(other) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_fp, held_key = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).to_numpy()], 1)
            fp = batch.column(2).to_numpy()
            same = (key == key[-1]).all(axis=1)
            cut = len(key) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                if (out := edges(np.concatenate([*held_fp, fp[:cut]]), np.concatenate([*held_key, key[:cut]]))) is not None:
                    yield out
                held_fp, held_key = [], []
            held_fp.append(fp[cut:])
            held_key.append(key[cut:])
        if held_fp and (out := edges(np.concatenate(held_fp), np.concatenate(held_key))) is not None:
            yield out

    return run


def fingerprint_edges(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): edges that connect the distinct fingerprints (column ``fp``)
    exactly as all links of at most ``max_bits`` differing bits do."""
    keys = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits")) for i, m in enumerate(block_masks(max_bits))]
    dealt = nodes.select("fp", gray_rank(F.col("fp")).alias("rank"), F.explode(F.array(*keys)).alias("key"))
    dealt = dealt.select("key.mask", "key.bits", "fp", "rank").repartition(F.col("mask"), F.col("bits"))
    return dealt.sortWithinPartitions("mask", "bits", "rank").mapInArrow(tokens.tidy(_group_edges(max_bits)), "a long, b long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an undirected edge list (a, b): root is
    the smallest node of its component. Alternates large-star and small-star
    until the edges are stars; each round is a written table."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        tied = both.join(least, "a")
        if large:
            return tied.where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return tied.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()

    def state(pairs: DataFrame):
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    pairs = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(pairs)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        pairs = written(star(written(star(pairs, True), "large"), False), "small")
        now = state(pairs)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(id, rid, fp, root, component): one row per document; component is the
    smallest id that chains of links of at most ``max_bits`` differing bits
    reach, root the smallest fingerprint."""
    fps = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least_id")), "nodes")
    roots = components(fingerprint_edges(nodes, max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    by_fp = rooted.join(named, "root").select("fp", "root", "component")
    return fps.join(by_fp, "fp").select("id", "rid", "fp", "root", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """The documents, unchanged, of which one of each component stays: that
    with the smallest id; of several rows with that id (or of several without
    one, where no row has an id) that with the least hash of its text, and of
    equal ones the first by their other columns."""
    groups = simhash_components(docs, id_col, text_col, shingle, max_bits, seed)
    led = groups.where(F.col("id").eqNullSafe(F.col("component")))
    first = written(led.groupBy("root").agg(F.min(F.struct("rid", "id")).alias("lead")).select("lead.*").distinct(), "first-of-component")
    names = docs.columns
    others = [column(c).alias(f"c{i}") for i, c in enumerate(names) if c != text_col]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), row_hash(id_col, text_col).alias("_rid"), F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("_row"),
                       F.to_json(F.struct(*others)).alias("_order"))
    # of repeated rows one, cut down before the shuffle
    one = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_rid").orderBy("_order"))).where("_n = 1")
    kept = one.join(first, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_rid") == F.col("rid")), "left_semi")
    return kept.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])
