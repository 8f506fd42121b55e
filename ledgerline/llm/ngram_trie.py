"""LM scoring over an Elias-Fano n-gram trie (operator 2).

An interpolated trigram model with absolute discounting; n-grams of two and
three words are kept from ``min_count`` occurrences on, and what is not kept
is left to the lower order, so probabilities still sum to one.

Counting: map tasks count n-grams as numbers and send one sorted, compressed
block per reducer; reducers merge blocks. Bigrams are dealt out by both their
words and trigrams by their first two, so a very frequent word does not meet
in one task. Trigrams are counted only where both bigrams in them are kept.
Nothing passes through the driver but a few numbers per reducer.

The trie lies in files of the shared folder, one set per reducer. A reducer
holds the bigrams (u, v) of its share: the words u that have any (four bytes
each), monotone pointers to the ranges of their successors v, the successors, made monotone
over all ranges; and under each bigram a pointer to its range of third words.
A third word w is written as its place among the successors of v (place times
the number of shares, plus the share of (v, w)), so these numbers are small.
These sequences are Elias-Fano; probabilities and back-off weights are one byte
each, into a table of bin means. Words get dense numbers in hash order.

Scoring: tasks map the files into memory and search in arrays of tokens: first
the range by its pointers, then the successor within it, relative to the range
before. Whole texts are scored, in slices.

Defined results: null or empty text is the end token alone. Rows without an id
are never held out and teach nothing. Without training text every token is
unknown, with probability 1 in the base model (0.5 / 0.5). Repeated rows teach
and are scored each. Other columns are ignored.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .elias_fano import EliasFano, encode
from .store import new_folder, shard_count

U = np.uint64
END = U(0x9D5B1F3A7C24E680)  # stands for the end token's hash
BLOCKS = "shard int, block binary"
HELD = 1_500_000  # n-grams that a map task combines before it sends them
SLICE_BYTES = 2 << 20  # texts worked on at once: each slice visits every share
_codec = pa.Codec("zstd", compression_level=1)


# --- counted blocks ----------------------------------------------------------


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, and counts."""
    planes = np.diff(keys, prepend=U(0)).view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(keys).to_bytes(8, "little") + _codec.compress(planes, asbytes=True)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    raw = np.frombuffer(_codec.decompress(block[8:], 12 * n, asbytes=True), np.uint8)
    keys = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view(U).ravel()
    return np.cumsum(keys, dtype=U), np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view(np.uint32).ravel().astype(np.int64)


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted (keys, counts) of several."""
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64)
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


class Combiner:
    """Map-side counts, sent on in blocks by reducer when they get many."""

    def __init__(self, shards: int, shard_of: Callable[[np.ndarray], np.ndarray]):
        self.shards, self.shard_of, self.parts, self.size = shards, shard_of, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            found, counts = np.unique(keys, return_counts=True)
            self.parts.append((found, counts))
            self.size += len(found)
        if self.size > HELD:
            self.parts = [merge(self.parts)]
            self.size = len(self.parts[0][0])
            if self.size > HELD // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        keys, counts = merge(self.parts)
        self.parts, self.size = [], 0
        if not len(keys):
            return
        shard = self.shard_of(keys)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.shards + 1))
        full = [k for k in range(self.shards) if cut[k] < cut[k + 1]]
        blocks = [pack(keys[at], counts[at]) for at in (order[cut[k]:cut[k + 1]] for k in full)]
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array(blocks, pa.binary())], names=["shard", "block"])


def blocks_of(table: pa.Table) -> list[bytes]:
    return [b.as_py() for b in table.column("block")]


def freeing(write: Callable) -> Callable:
    """``write``, the function of a share, giving memory back at its end."""

    def task(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        try:
            return write(key, table)
        finally:
            tokens.give_back()

    return task


# --- files -------------------------------------------------------------------


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays into one file, whole or not at all."""
    system, root = pafs.FileSystem.from_uri(folder)
    head, at = {}, 0
    for key, a in arrays.items():
        head[key] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 8) * 8
    raw = json.dumps(head).encode()
    path = f"{root}/{name}"
    temporary = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(temporary) as out:
        out.write(len(raw).to_bytes(8, "little") + raw + b" " * (-len(raw) % 8))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    system.move(temporary, path)


def load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory. A file of a remote store is
    copied into an unnamed temporary file first."""
    system, root = pafs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    if isinstance(system, pafs.LocalFileSystem):
        raw = np.asarray(np.memmap(path, np.uint8, "r"))  # plain arrays: a memmap's are slow to index
    else:
        with tempfile.TemporaryFile() as copy:
            with system.open_input_stream(path) as source:
                while chunk := source.read(1 << 20):
                    copy.write(chunk)
            copy.flush()
            raw = np.asarray(np.memmap(copy, np.uint8, "r"))
    n = int(raw[:8].view(np.int64)[0])
    at = 8 + -(-n // 8) * 8
    out = {}
    for key, (dtype, place, length) in json.loads(raw[8:8 + n].tobytes()).items():
        size = length * np.dtype(dtype).itemsize
        out[key] = raw[at + place:at + place + size].view(dtype)
    return out


def named(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{prefix}.{k}": a for k, a in arrays.items()}


def sequence(arrays: dict[str, np.ndarray], prefix: str) -> EliasFano:
    return EliasFano({k.partition(".")[2]: a for k, a in arrays.items() if k.startswith(prefix + ".")})


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of one byte, table of bin means), over equally full bins; a value
    that would fill more than one bin has one of its own."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(256, np.float32)
    values, back, count = np.unique(x, return_inverse=True, return_counts=True)
    if len(values) <= 256:
        code = np.arange(len(values))
    else:
        full = count.astype(float)
        for _ in range(20):
            full = np.minimum(full, full.sum() / 256)
        code = np.minimum(((np.cumsum(full) - full / 2) * (256 / full.sum())).astype(int), 255)
    n, total = np.bincount(code, count, minlength=256), np.bincount(code, count * values, minlength=256)
    return code[back].astype(np.uint8), (total / np.maximum(n, 1)).astype(np.float32)


def ranges(group: np.ndarray, x: np.ndarray, groups: int) -> tuple[dict, dict]:
    """(pointers, members) of sorted (group, x): each range's numbers follow
    on the last of the range before."""
    bounds = np.searchsorted(group, np.arange(groups + 1))
    full = bounds[1:] > bounds[:-1]
    top = np.zeros(groups, np.int64)
    top[full] = x[bounds[1:][full] - 1] + 1
    return encode(bounds), encode(x + (np.cumsum(top) - top)[group])


# --- the trie ----------------------------------------------------------------


@dataclass
class Meta:
    """What the driver knows of a model: a few numbers per share."""

    folder: str
    shards: int
    vocabulary: list[int]  # words in each vocabulary file
    total: int  # training tokens
    discount: float
    min_count: int

    @property
    def n_words(self) -> int:
        return sum(self.vocabulary)

    @property
    def start(self) -> int:
        """The number of the start sign, which is no token."""
        return self.n_words


def word_shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h >> U(32)) * U(shards)) >> U(32)).astype(np.int64)


def pair_shard(pair: np.ndarray, shards: int) -> np.ndarray:
    return (tokens.mix(pair) % U(shards)).astype(np.int64)


def by_share(share: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each share among those of the places ``at``, and its places in order."""
    of = share[at]
    order = np.argsort(of.astype(np.uint16) if len(of) and of.max() < 1 << 16 else of, kind="stable")
    of = of[order]
    for part in np.split(order, np.flatnonzero(of[1:] != of[:-1]) + 1) if len(of) else ():
        yield int(share[at[part[0]]]), at[part]


class Words:
    """Numbers and counts of words."""

    def __init__(self, meta: Meta):
        self.meta = meta
        files = [load(meta.folder, f"words-{k}") for k in range(meta.shards)]
        self.hashes, self.counts = [f["hash"] for f in files], [f["count"] for f in files]
        self.offset = np.r_[0, np.cumsum(meta.vocabulary)]
        self.n_texts = int(self.count(self.number(np.array([END])))[0])

    def number(self, h: np.ndarray) -> np.ndarray:
        """Number of each word hash, or -1."""
        found, back = np.unique(h, return_inverse=True)
        out = np.full(len(found), -1, np.int64)
        cut = np.searchsorted(word_shard(found, self.meta.shards), np.arange(self.meta.shards + 1))
        for k, known in enumerate(self.hashes):
            x = found[cut[k]:cut[k + 1]]
            if len(x) and len(known):
                at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                out[cut[k]:cut[k + 1]] = np.where(known[at] == x, at + self.offset[k], -1)
        return out[back]

    def _gather(self, arrays: list[np.ndarray], number: np.ndarray, missing) -> np.ndarray:
        order = np.argsort(number, kind="stable")
        cut = np.searchsorted(number[order], self.offset)
        out = np.full(len(number), missing, np.float64)
        for k, a in enumerate(arrays):
            if cut[k] < cut[k + 1]:
                here = order[cut[k]:cut[k + 1]]
                out[here] = a[number[here] - self.offset[k]]
        return out

    def count(self, number: np.ndarray) -> np.ndarray:
        return self._gather(self.counts, number, 0)

    def context_count(self, number: np.ndarray) -> np.ndarray:
        return np.where(number == self.meta.start, self.n_texts, self.count(number))

    def backoff(self, number: np.ndarray) -> np.ndarray:
        if not hasattr(self, "weights"):
            files = [load(self.meta.folder, f"backoff-{k}")["weight"] for k in range(self.meta.shards + 1)]
            self.weights, self.start_weight = files[:-1], float(files[-1][0])
        return np.where(number == self.meta.start, self.start_weight, self._gather(self.weights, number, 1.0))


class Pairs:
    """The bigram levels of all shares."""

    def __init__(self, meta: Meta):
        self.meta, self.files = meta, [load(meta.folder, f"pairs-{k}") for k in range(meta.shards)]
        self.pointers, self.members = ([sequence(f, p) for f in self.files] for p in ("pointers", "members"))

    def find(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(share, place in its level or -1, place in the range) of each of
        some distinct sorted pairs (first << 32 | second)."""
        share = pair_shard(pair, self.meta.shards)
        place, within = np.full(len(pair), -1, np.int64), np.zeros(len(pair), np.int64)
        for k, at in by_share(share, np.arange(len(pair))):
            first = self.files[k]["first"]
            if not len(first):
                continue
            u, v = (pair[at] >> U(32)).astype(np.int32), (pair[at] & U(0xFFFFFFFF)).astype(np.int64)
            head = np.r_[True, u[1:] != u[:-1]]
            row = np.searchsorted(first, u[head])
            known = first[np.minimum(row, len(first) - 1)] == u[head]
            back = np.cumsum(head) - 1
            here = np.flatnonzero(known[back])
            found, begin = find_in_ranges(self.pointers[k], self.members[k], row[known], (np.cumsum(known) - 1)[back[here]], v[here])
            place[at[here]], within[at[here]] = found, np.where(found >= 0, found - begin, 0)
        return share, place, within

    def code(self, share: np.ndarray, within: np.ndarray) -> np.ndarray:
        """A second word's number relative to its first: its place among the
        successors."""
        return within * self.meta.shards + share

    def alpha(self, share: np.ndarray, place: np.ndarray) -> np.ndarray:
        return gather(self.files, "alpha", share, place, 0.0)


def find_in_ranges(pointers: EliasFano, members: EliasFano, row: np.ndarray, back: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the members or -1, begin of the range) of each number ``x``
    in the range ``row[back]``. A member is written plus its range's base, one
    more than the member before the range. That one and the first of the range
    stand side by side and settle most numbers; the others are searched for."""
    lo, hi = pointers.access_two(row)
    base, first = np.zeros(len(row), np.int64), np.full(len(row), -1)
    inner, at_start = np.flatnonzero((lo > 0) & (lo < hi)), np.flatnonzero((lo == 0) & (lo < hi))
    before, first[inner] = members.access_two(lo[inner] - 1)
    base[inner] = before + 1
    first[at_start] = members.access(lo[at_start])
    begin, x, first = lo[back], x + base[back], first[back]
    out = np.where(x == first, begin, -1)
    rest = np.flatnonzero((x > first) & (begin + 1 < hi[back]))
    out[rest] = members.find(x[rest], begin[rest] + 1, hi[back[rest]])
    return out, begin


def gather(files: list[dict], name: str, share: np.ndarray, place: np.ndarray, missing: float) -> np.ndarray:
    """Dequantised values at places of shares; ``missing`` where place is -1."""
    out = np.full(len(share), missing)
    for k, at in by_share(share, np.flatnonzero(place >= 0)):
        out[at] = files[k][name + "_table"][files[k][name][place[at]]]
    return out


class Triples:
    """The trigram levels of all shares."""

    def __init__(self, meta: Meta):
        self.meta, self.files = meta, [load(meta.folder, f"triples-{k}") for k in range(meta.shards)]
        self.pointers, self.members = ([sequence(f, p) for f in self.files] for p in ("pointers", "members"))

    def find(self, share: np.ndarray, place: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(discounted probability, back-off weight) of third words ``code``
        (-1: not a successor) after the bigrams at ``place`` of ``share``."""
        alpha, weight = np.zeros(len(share)), np.ones(len(share))
        for k, at in by_share(share, np.flatnonzero(place >= 0)):
            f = self.files[k]
            if not self.members[k].n:
                continue
            weight[at] = f["weight_table"][f["weight"][place[at]]]
            at = at[code[at] >= 0]
            if not len(at):
                continue
            key, back = np.unique((place[at].astype(U) << U(32)) | code[at].astype(U), return_inverse=True)
            node = (key >> U(32)).astype(np.int64)
            head = np.r_[True, node[1:] != node[:-1]]
            found, _ = find_in_ranges(self.pointers[k], self.members[k], node[head], np.cumsum(head) - 1, (key & U(0xFFFFFFFF)).astype(np.int64))
            found = found[back]
            hit = np.flatnonzero(found >= 0)
            alpha[at[hit]] = f["alpha_table"][f["alpha"][found[hit]]]
        return alpha, weight


@dataclass
class Tokens:
    """A slice's texts as numbers: start sign, words, end token."""

    number: np.ndarray
    begin: np.ndarray  # where each text starts
    n: np.ndarray  # tokens of each text, the end token included

    def places(self, back: int) -> np.ndarray:
        """Places with at least ``back`` signs of their text before them."""
        return np.repeat(self.begin + back, np.maximum(self.n + 1 - back, 0)) + _steps(np.maximum(self.n + 1 - back, 0))


def _steps(n: np.ndarray) -> np.ndarray:
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def with_signs(s: tokens.Slice, number_of, start: int) -> Tokens:
    n = s.counts + 1
    begin = np.cumsum(n + 1) - n - 1
    number = np.full(int((n + 1).sum()), start, np.int64)
    inner = np.repeat(begin + 1, n - 1) + _steps(n - 1)
    h = np.full(len(number), END)
    h[inner] = tokens.word_hashes(s)
    real = np.ones(len(number), bool)
    real[begin] = False
    number[real] = number_of(h[real])
    return Tokens(number, begin, n)


def pairs_at(t: Tokens, at: np.ndarray) -> np.ndarray:
    return (t.number[at - 1].astype(U) << U(32)) | t.number[at].astype(U)


# --- building ----------------------------------------------------------------


def train(docs: DataFrame, may_teach: Column, text_col: str = "text", min_count: int = 2, discount: float = 0.75, shards: int | None = None) -> Meta:
    """Count, smooth and write the trie of the whole texts of the documents
    that may teach."""
    spark = docs.sparkSession
    folder, shards = new_folder(spark, "ngram-trie"), shards or shard_count(docs)
    texts = docs.where(may_teach).select(F.col(text_col).alias("text"))

    def count_words(batches):
        send = Combiner(shards, lambda h: word_shard(h, shards))
        for batch in batches:
            for s in tokens.slices(batch.column(0), lower=True, slice_bytes=SLICE_BYTES):
                yield from send.add(np.r_[tokens.word_hashes(s), np.full(s.n_texts, END)])
        yield from send.flush()

    def write_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        h, n = merge([unpack(b) for b in blocks_of(table)])
        save(folder, f"words-{key[0].as_py()}", {"hash": h, "count": n})
        return pa.table({"shard": [key[0].as_py()], "words": [len(h)], "total": [int(n.sum())]}, schema=pa.schema([("shard", pa.int32()), ("words", pa.int64()), ("total", pa.int64())]))

    rows = texts.mapInArrow(tokens.tidy(count_words), BLOCKS).groupBy("shard").applyInArrow(freeing(write_words), "shard int, words long, total long").collect()  # one row per share
    sizes = {r.shard: r.words for r in rows}
    for k in set(range(shards)) - set(sizes):
        save(folder, f"words-{k}", {"hash": np.zeros(0, U), "count": np.zeros(0, np.int64)})
    meta = Meta(folder, shards, [sizes.get(k, 0) for k in range(shards)], sum(r.total for r in rows), discount, min_count)
    if meta.n_words >= 2**31:
        raise ValueError("over 2**31 distinct words")
    _write_pairs(texts, meta)
    _write_triples(texts, meta)
    return meta


def _write_pairs(texts: DataFrame, meta: Meta) -> None:
    shards, folder = meta.shards, meta.folder

    def count_pairs(batches):
        words, send = Words(meta), Combiner(shards, lambda p: pair_shard(p, shards))
        for batch in batches:
            for s in tokens.slices(batch.column(0), lower=True, slice_bytes=SLICE_BYTES):
                t = with_signs(s, words.number, meta.start)
                yield from send.add(pairs_at(t, t.places(1)))
        yield from send.flush()

    def write(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words, k = Words(meta), key[0].as_py()
        pair, n = merge([unpack(b) for b in blocks_of(table)])
        kept = n >= meta.min_count
        pair, n = pair[kept], n[kept]
        u, v = (pair >> U(32)).astype(np.int64), (pair & U(0xFFFFFFFF)).astype(np.int64)
        alpha = (n - meta.discount) / np.maximum(words.context_count(u), 1)
        save_pairs(k, u, v, n, alpha)
        # what the successors of each word take, for its back-off weight
        head = np.flatnonzero(np.r_[True, u[1:] != u[:-1]]) if len(u) else np.zeros(0, int)
        mass = np.add.reduceat(alpha, head) if len(head) else alpha
        share = np.where(u[head] == meta.start, shards, np.searchsorted(words.offset, u[head], "right") - 1)
        cut = np.searchsorted(share, np.arange(shards + 2))
        full = [j for j in range(shards + 1) if cut[j] < cut[j + 1]]
        blocks = [u[head][cut[j]:cut[j + 1]].tobytes() + mass[cut[j]:cut[j + 1]].tobytes() for j in full]
        return pa.table([pa.array(full, pa.int32()), pa.array(blocks, pa.binary())], names=["shard", "block"])

    def save_pairs(k, u, v, n, alpha):
        first, group = np.unique(u, return_inverse=True)
        pointers, members = ranges(group, v, len(first))
        code, means = quantised(alpha)
        save(folder, f"pairs-{k}", {"first": first.astype(np.int32), **named("pointers", pointers), **named("members", members), "alpha": code, "alpha_table": means, "count": n})

    def write_backoff(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words, k = Words(meta), key[0].as_py()
        low, size = (meta.start, 1) if k == shards else (int(words.offset[k]), meta.vocabulary[k])
        taken = np.zeros(size)
        for b in blocks_of(table):
            n = len(b) // 16
            np.add.at(taken, np.frombuffer(b, np.int64, n) - low, np.frombuffer(b, np.float64, n, 8 * n))
        save(folder, f"backoff-{k}", {"weight": np.maximum(1 - taken, 1e-9).astype(np.float32)})
        return pa.table({"shard": pa.array([k], pa.int32())})

    every = texts.sparkSession.range(shards + 1).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("block"))
    blank = every.where(F.col("shard") < shards)
    some = lambda fn: freeing(lambda key, table: fn(key, table.filter(table.column("block").is_valid())))
    counted = texts.mapInArrow(tokens.tidy(count_pairs), BLOCKS).unionByName(blank).groupBy("shard").applyInArrow(some(write), BLOCKS)
    counted.unionByName(every).groupBy("shard").applyInArrow(some(write_backoff), "shard int").count()


def _write_triples(texts: DataFrame, meta: Meta) -> None:
    shards, folder = meta.shards, meta.folder

    def count_triples(batches):
        words, pairs, send = Words(meta), Pairs(meta), [Combiner(1, lambda x: np.zeros(len(x), int)) for _ in range(shards)]
        for batch in batches:
            for s in tokens.slices(batch.column(0), lower=True, slice_bytes=SLICE_BYTES):
                t = with_signs(s, words.number, meta.start)
                at = t.places(2)
                share, place, code = pair_places(pairs, t)
                ok = at[(place[at - 1] >= 0) & (place[at] >= 0)]
                key = (place[ok - 1].astype(U) << U(32)) | code[ok].astype(U)
                for k, here in by_share(share[ok - 1], np.arange(len(ok))):
                    yield from (renamed(b, k) for b in send[k].add(key[here]))
                while sum(c.size for c in send) > HELD:
                    k = max(range(shards), key=lambda j: send[j].size)
                    yield from (renamed(b, k) for b in send[k].flush())
        for k in range(shards):
            yield from (renamed(b, k) for b in send[k].flush())

    def renamed(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
        return pa.record_batch([pa.array([k] * batch.num_rows, pa.int32()), batch.column(1)], names=["shard", "block"])

    def write(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        of_pair = load(folder, f"pairs-{k}")["count"]
        triple, n = merge([unpack(b) for b, ok in zip(blocks_of(table), table.column("block").is_valid().to_pylist()) if ok])
        kept = n >= meta.min_count
        node, code, n = (triple[kept] >> U(32)).astype(np.int64), (triple[kept] & U(0xFFFFFFFF)).astype(np.int64), n[kept]
        alpha = (n - meta.discount) / of_pair[node]
        weight = np.maximum(1 - np.bincount(node, alpha, len(of_pair)), 1e-9)
        pointers, members = ranges(node, code, len(of_pair))
        alpha_code, alpha_means = quantised(alpha)
        weight_code, weight_means = quantised(weight)
        save(folder, f"triples-{k}", {**named("pointers", pointers), **named("members", members), "alpha": alpha_code, "alpha_table": alpha_means, "weight": weight_code, "weight_table": weight_means})
        return pa.table({"shard": pa.array([k], pa.int32())})

    blank = texts.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("block"))
    texts.mapInArrow(tokens.tidy(count_triples), BLOCKS).unionByName(blank).groupBy("shard").applyInArrow(freeing(write), "shard int").count()


def pair_places(pairs: Pairs, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share, place, code) of the bigram that ends at each place of the slice;
    place and code are -1 where there is none."""
    at = t.places(1)
    known = at[(t.number[at - 1] >= 0) & (t.number[at] >= 0)]
    found, back = np.unique(pairs_at(t, known), return_inverse=True)
    share, place, within = pairs.find(found)
    out = [np.full(len(t.number), -1, np.int64) for _ in range(3)]
    code = np.where(place >= 0, pairs.code(share, within), -1)
    for a, b in zip(out, (share, place, code)):
        a[known] = b[back]
    return tuple(out)


# --- scoring -----------------------------------------------------------------


class Model:
    def __init__(self, meta: Meta):
        self.meta, self.words, self.pairs, self.triples = meta, Words(meta), Pairs(meta), Triples(meta)

    def score(self, s: tokens.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base score, score) of each text."""
        t = with_signs(s, self.words.number, self.meta.start)
        at = t.places(1)
        number, back = np.unique(t.number, return_inverse=True)
        count = self.words.count(number)
        one = (count + 0.5) / (self.meta.total + 0.5 * (self.meta.n_words + 1))
        share, place, code = pair_places(self.pairs, t)
        two = self.pairs.alpha(share[at], place[at]) + self.words.backoff(number)[back[at - 1]] * one[back[at]]
        p = np.zeros(len(t.number))
        p[at] = two
        later = t.places(2)
        alpha, weight = self.triples.find(share[later - 1], place[later - 1], code[later])
        p[later] = alpha + weight * p[later]
        total = lambda x: np.add.reduceat(x, np.cumsum(t.n) - t.n)  # noqa: E731  every text has its end token
        return t.n, total((count > 0).astype(np.int64)[back[at]]), total(np.log10(one)[back[at]]), total(np.log10(np.minimum(p[at], 1.0)))


def score(docs: DataFrame, meta: Meta, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every whole text."""
    names = ["id", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = model or Model(meta)
            for s in tokens.slices(batch.column(1), lower=True, slice_bytes=SLICE_BYTES):
                yield pa.record_batch([batch.column(0).slice(s.row, s.n_texts), *map(pa.array, model.score(s))], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokens.tidy(run), "id long, n_tokens long, n_known long, base_score double, score double")
