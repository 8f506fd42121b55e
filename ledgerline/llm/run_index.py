"""Byte-exact repeats by run-length BWT indexes (operator 12).

Every window of ``window`` bytes chooses an anchor: of its ``anchor``-byte
strings the one whose hash is least. Equal windows choose the same anchor at
the same place. Neighbouring windows of one document that chose the same
anchor occurrence are a piece: its text is what these windows cover, and the
windows of equal anchors are dealt to one shard, so that a shard sees every
occurrence of its windows.

Pieces of anchors that occur again are cut down to the windows whose
surroundings, the 91 bytes that ten neighbouring windows share, come twice. So
a shard's texts are repetitive, and are indexed in two rounds:

1. Of each anchor that occurs again the earliest piece is the reference. The
   references get a Burrows-Wheeler transform, kept as runs, with the text
   position (suffix-array sample) of each run's first and last row. All other
   pieces are streamed through it from right to left as matching statistics:
   while the run's letter is the next byte the match grows by an LF step;
   otherwise it moves to the end of the run before, or the start of the run
   after, that has the byte, whichever keeps more of the match, and takes its
   text position from that run's sample. Where a match is ``window`` bytes
   long, the window occurs in an earlier piece.
2. Pieces with windows that no reference explains (same anchor, another
   neighbourhood) are indexed together and streamed through their own index. A
   window is a repeat if the earliest of the rows that share its ``window``
   bytes comes from an earlier piece.

Matches are of bytes, in the index's text; hashes only choose anchors, deal
pieces out, and join equal pieces of one slice (64 bits, among the pieces of
four megabytes). Marked windows are united to spans per document, after all
shards.

No key is too hot for a shard. Of equal pieces in a slice only the first is
sent. A pass before counts, over all documents, how many pieces each anchor
sends; the windows of an anchor above the bound are dealt out in tens, by the
91 bytes that ten neighbouring windows share, and where such a context is
above the bound too, one by one, by all their bytes. The bound grows so that
at most ``1 << 20`` keys can be above it; those travel with the tasks.

Defined results: a null text is empty. Rows are identified by id and text;
rows that repeat both have equal positions, so none is earlier than the other;
null ids come last. The bytes that remain need not be valid UTF-8 where a
repeat starts or ends inside a character; ``remove_repeats`` therefore returns
them as binary. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import shard_count, written

U = np.uint64
LAST = np.iinfo(np.int64).max  # stands for a null id
SLICE = 4 << 20  # bytes of text that a map task takes at a time
BLOCK = 4 << 20  # window starts of one long text that it takes at a time
SHARD_BYTES = 5 << 20  # input for each shard
HOT = 1 << 16  # pieces of one key that a shard may get, at least
REPORT = 1 << 12
RANGE = 10  # windows that a hot anchor's pieces hold at most
PLACE = U((1 << 24) - 1)
STREAM = 1 << 16  # pieces streamed side by side
SPANS = "id long, rid long, spans binary"


@dataclass
class Pieces:
    """Runs of windows with one key; ``text`` holds their bytes in order."""

    key: np.ndarray
    id: np.ndarray
    rid: np.ndarray
    start: np.ndarray  # place of the first window in the document
    anchor: np.ndarray  # place of the anchor: equal windows are ordered by it
    size: np.ndarray  # bytes
    text: np.ndarray

    FIELDS = ("key", "id", "rid", "start", "anchor", "size")

    def only(self, take: np.ndarray) -> Pieces:
        """The pieces where the mask ``take`` is set."""
        return Pieces(*(getattr(self, f)[take] for f in self.FIELDS), self.text[np.repeat(take, self.size)])

    def packed(self, window: int) -> bytes:
        """Keys as they are, the rest compressed: bytes of one significance
        together, ids once for each row. A key is cut to 32 bits, which may
        only bring more pieces together."""
        new = np.r_[True, (self.id[1:] != self.id[:-1]) | (self.rid[1:] != self.rid[:-1])]  # in the order of the texts
        rows = np.stack([self.id[new], self.rid[new]])
        planes = [rows.astype("<i8").ravel(), (np.cumsum(new) - 1).astype("<u4"), self.start.astype("<i8")]
        parts = [np.ascontiguousarray(p.view(np.uint8).reshape(-1, p.itemsize).T).tobytes() for p in planes]
        parts += [(self.anchor - self.start).astype("<u2").tobytes(), (self.size - window).astype("<u2").tobytes(), self.text.tobytes()]
        body = b"".join(parts)
        head = np.array([len(self.key), rows.shape[1], len(body)], np.int64)
        return head.tobytes() + (self.key >> U(32)).astype("<u4").tobytes() + pa.Codec("zstd", compression_level=3).compress(body, asbytes=True)

    @staticmethod
    def keys_of(blob) -> np.ndarray:
        return np.frombuffer(blob, "<u4", np.frombuffer(blob, np.int64, 1)[0], 24)

    @staticmethod
    def unpacked(blob, window: int) -> Pieces:
        n, n_rows, size = (int(x) for x in np.frombuffer(blob, np.int64, 3))
        body = memoryview(pa.Codec("zstd").decompress(memoryview(blob)[24 + 4 * n:], decompressed_size=size))
        at = 0

        def plane(kind: str, count: int) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize
            raw = np.frombuffer(body, np.uint8, count * width, at).reshape(width, count)
            at += count * width
            return np.ascontiguousarray(raw.T).view(kind).ravel()

        rows, row, start = plane("<i8", 2 * n_rows).reshape(2, n_rows), plane("<u4", n), plane("<i8", n)
        ahead, more = (np.frombuffer(body, "<u2", n, at + 2 * n * k).astype(np.int64) for k in (0, 1))
        return Pieces(Pieces.keys_of(blob), rows[0][row], rows[1][row], start, start + ahead, more + window, np.frombuffer(body, np.uint8, offset=at + 4 * n))

    @staticmethod
    def together(parts: list[Pieces]) -> Pieces:
        return Pieces(*(np.concatenate([getattr(p, f) for p in parts]) for f in (*Pieces.FIELDS, "text")))


@dataclass
class Cut(Pieces):
    """The pieces of a slice; ``text`` is the slice's own."""

    at: np.ndarray  # of the piece in the slice
    same: np.ndarray  # hash of the piece's bytes
    parted: np.ndarray  # dealt out finer than by its anchor

    def taken(self, take: np.ndarray) -> Pieces:
        """The pieces numbered in ``take``, with their bytes."""
        at, size = self.at[take], self.size[take]
        where = np.repeat(at - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return Pieces(*(getattr(self, f)[take] for f in Pieces.FIELDS), self.text[where])


@dataclass
class Keying:
    """What decides a piece's key: window and anchor width, and the buckets of
    keys that are dealt out finer."""

    window: int
    anchor: int
    shards: int
    hot: np.ndarray  # buckets of anchors
    hotter: np.ndarray  # buckets of contexts of hot anchors

    def shard(self, key: np.ndarray) -> np.ndarray:
        return (tokens.mix(key) % U(self.shards)).astype(np.int64)

    def bucket(self, key: np.ndarray) -> np.ndarray:
        return (self.shard(key) << 32) | (key >> U(32)).astype(np.int64)


def text_slices(column, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place of its first byte, bytes, offsets of the texts):
    whole texts up to four megabytes, or a block of one long text."""
    data, offsets = tokens.utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        if offsets[row + 1] - offsets[row] > BLOCK:
            for at in range(int(offsets[row]), int(offsets[row + 1]), BLOCK):
                part = data[at:min(at + BLOCK + window - 1, offsets[row + 1])]
                yield row, at - int(offsets[row]), part, np.array([0, len(part)])
            row += 1
            continue
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, 0, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def hasher(data: np.ndarray):
    """64-bit hashes of stretches of ``data``, given as start and length."""
    power, inverse = tokens._byte_powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(tokens._BYTE_CODE[data] * power[:len(data)], out=total[1:])
    return lambda lo, size: tokens.mix((total[lo + size] - total[lo]) * inverse[lo] + np.asarray(size).astype(U))


def cut(data: np.ndarray, offsets: np.ndarray, base: int, ids: np.ndarray, rids: np.ndarray, how: Keying) -> Cut | None:
    """The pieces of a slice, in the order of the text."""
    n = len(data) - how.window + 1
    if n <= 0:
        return None
    doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
    whole = offsets[1:][doc[:n]] - np.arange(n) >= how.window
    if not whole.any():
        return None
    hashed = hasher(data)
    grams = hashed(np.arange(len(data) - how.anchor + 1), how.anchor)
    # least hash, then first place, of the anchors in a window
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=U)
    span, width = 1, how.window - how.anchor + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[:span - width], least[width - span:])
    at = (least[:n] & PLACE).astype(np.int64)
    key = grams[at]
    place = np.arange(n)
    parted = np.zeros(n, np.int64)
    if len(how.hot):
        hot = whole & np.isin(how.bucket(key), how.hot)
        i = np.flatnonzero(hot)
        tens = (at[i] - i) // RANGE
        # bytes that all windows of these offsets share
        context = hashed(at[i] - RANGE * tens, how.window - RANGE + 1) + tens.astype(U)
        alone = np.isin(how.bucket(context), how.hotter)
        key[i] = context
        key[i[alone]] = hashed(i[alone], how.window)
        parted[i] = np.where(alone, i + 1, -tens - 1)
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (parted[1:] != parted[:-1]) | ~whole[:-1]
    head = np.flatnonzero(new & whole)
    stop = np.r_[np.flatnonzero(new | ~whole), n]
    count = stop[np.searchsorted(stop, head, "right")] - head
    size = count + how.window - 1
    first = offsets[doc[head]]
    return Cut(key[head], ids[doc[head]], rids[doc[head]], base + head - first, base + at[head] - first, size, data, head, hashed(head, size), parted[head] != 0)


def _fresh(found: Cut) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the first of equal pieces, in order, and of its later occurrences.
    Copies in the same row of a repeated row are neither."""
    by = np.argsort(found.same, kind="quicksort")
    alike = found.same[by][1:] == found.same[by][:-1]
    company = np.zeros(len(by), bool)
    company[by[1:][alike]] = company[by[:-1][alike]] = True
    few = np.flatnonzero(company)
    few = few[np.lexsort((found.anchor[few], found.id[few], found.same[few]))]
    same, id_, anchor = found.same[few], found.id[few], found.anchor[few]
    new = np.r_[True, same[1:] != same[:-1]][:len(few)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(few)), 0))
    later = (id_ != id_[head]) | (anchor != anchor[head])
    return np.sort(np.r_[np.flatnonzero(~company), few[new]]), few[later]


def _sliced(batches: Iterator[pa.RecordBatch], how: Keying) -> Iterator[Cut]:
    for batch in batches:
        ids, rids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).to_numpy()
        for row, base, data, offsets in text_slices(batch.column(2), how.window):
            rows = slice(row, row + len(offsets) - 1)
            found = cut(data, offsets, base, ids[rows], rids[rows], how)
            if found is not None:
                yield found


def _counted(how: Keying, finer: bool):
    """Counting pass: (shard, buckets of the keys that a slice sends), of finer
    dealt pieces alone where ``finer``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _sliced(batches, how):
            sent, _ = _fresh(found)
            if finer:
                sent = sent[found.parted[sent]]
            buckets = np.sort(how.bucket(found.key[sent]))
            shard = buckets >> 32
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, int)
            parts = np.split((buckets & 0xFFFFFFFF).astype("<u4"), cuts[1:]) if len(cuts) else []
            yield pa.record_batch([pa.array(shard[cuts].astype(np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["shard", "blob"])

    return run


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard's buckets with many pieces; the sum of all stands at -1."""
    shard, parts = 0, []
    for batch in batches:
        for s, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = s
            parts.append(np.frombuffer(blob.as_buffer(), "<u4"))
    if parts:
        bucket, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n >= REPORT
        yield pa.record_batch([pa.array(np.r_[-1, (shard << 32) | bucket[often].astype(np.int64)]), pa.array(np.r_[n.sum(), n[often]])], names=["bucket", "n"])


def spans_of(id_: np.ndarray, rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """The union of byte ranges by row, as (id, rid, ranges)."""
    by = np.lexsort((lo, rid, id_))
    id_, rid, lo, hi = id_[by], rid[by], lo[by], hi[by]
    row = np.r_[True, (id_[1:] != id_[:-1]) | (rid[1:] != rid[:-1])][:len(by)]
    # ranges of a row before: shifted apart, so that one running maximum serves all rows
    number = np.cumsum(row) - 1
    shift = number * (int(hi.max()) + 1 if len(hi) else 1)
    reach = np.maximum.accumulate(hi + shift)
    new = row.copy()
    new[1:] |= (lo + shift)[1:] > reach[:-1]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:] - 1, len(by) - 1][:len(head)]
    packed = np.stack([lo[head], (reach - shift)[tail]], 1).astype("<i8")
    cuts = np.r_[np.flatnonzero(row[head]), len(head)]
    rows = head[cuts[:-1]]
    return id_[rows].tolist(), rid[rows].tolist(), [packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def _dealt(how: Keying):
    """Map side: (shard, kind, blob) with kind 0 pieces and 1 spans found here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _sliced(batches, how):
            sent, again = _fresh(found)
            shards, kinds, blobs = [], [], []
            if len(again):
                lo = found.start[again]
                for id_, rid, spans in zip(*spans_of(found.id[again], found.rid[again], lo, lo + found.size[again])):
                    shards.append(int(how.shard(np.array([rid], np.int64).view(U))[0]))
                    kinds.append(1)
                    blobs.append(np.array([id_, rid], "<i8").tobytes() + spans)
            to = how.shard(found.key[sent])
            by = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[by], np.r_[np.unique(to), how.shards])
            for a, b in zip(cuts[:-1], cuts[1:]):
                shards.append(int(to[by[a]]))
                kinds.append(0)
                blobs.append(found.taken(sent[by[a:b]]).packed(how.window))
            yield pa.record_batch([pa.array(shards, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "kind", "blob"])

    return run


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    """For every place of a sorted array the first place with its value."""
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


class RunIndex:
    """Run-length BWT of pieces with sampled run ends.

    Letters are bytes + 1; 0 ends a piece. Pieces that end alike are in the
    order of their numbers, which makes the LF step consistent."""

    def __init__(self, text: np.ndarray, size: np.ndarray, window: int):
        self.window = window
        n = len(text) + len(size)
        ends = np.cumsum(size + 1) - 1
        self.piece = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)  # of a text position
        letters = np.zeros(n, np.uint8)
        inside = np.ones(n, bool)
        inside[ends] = False
        letters[inside] = text + np.uint8(1)
        left = np.repeat(ends, size + 1) - np.arange(n)  # letters before the end
        rows, same = self._sorted(letters, left)
        before = np.where(rows > 0, letters[rows - 1], 0)
        start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.run_start, self.run_letter = start, before[start].astype(np.int64)
        self.run_size = np.diff(np.r_[start, n])
        # the samples: text positions of each run's first and last row
        self.first, self.last = rows[start], rows[np.r_[start[1:], n] - 1]
        order = np.argsort(self.run_letter, kind="stable")
        to = np.zeros(len(start), np.int64)
        to[order] = np.cumsum(self.run_size[order]) - self.run_size[order]
        self.step = to - start  # a run's rows go to neighbouring rows in an LF step
        self.by_letter = self.run_letter[order] * len(start) + order
        self.order = order
        self.run_at = np.repeat(np.arange(len(start), dtype=np.int32), self.run_size)  # directory of the rows
        # of rows that share a window: the least piece
        owner = self.piece[rows]
        head = np.flatnonzero(np.r_[True, ~same])
        several = np.diff(np.r_[head, n]) > 1
        self.group_start, self.group_end = head[several], np.r_[head[1:], n][several]
        least = np.minimum.reduceat(owner, head)
        self.group_least = least[several]

    def _sorted(self, letters: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (text positions in suffix order) by prefix doubling, and for
        each but the first whether it shares a window with the one before."""
        n = len(letters)
        # eight letters in a number, none of them beyond the piece's end
        packed = letters.astype(U)
        for width in (1, 2, 4):
            more = np.zeros(n, U)
            more[:n - width] = packed[width:]
            more[left < width] = 0
            packed <<= U(8 * width)
            packed |= more
        self.packed = packed
        # a rank is the first row of the suffixes that are alike so far; only
        # those that have company are sorted again
        rows = np.argsort(packed, kind="quicksort")
        rank = np.zeros(n, np.int64)
        first = _group_starts(packed[rows])
        rank[rows] = first
        depth, reach, at, shared = 8, int(left.max()), np.arange(n), None
        while True:
            if shared is None and (depth >= self.window or 2 * depth > self.window):
                # the window as two overlapping stretches of ``depth`` letters
                if depth <= self.window:
                    shared = np.where(left >= self.window, rank * (n + 1) + rank[np.minimum(at + self.window - depth, n - 1)], -1)
                else:
                    shared = np.where(left >= self.window, (packed >> U(64 - 8 * self.window)).astype(np.int64), -1)
            alone = np.diff(np.r_[np.flatnonzero(np.r_[True, first[1:] != first[:-1]]), n])
            company = np.flatnonzero(np.repeat(alone > 1, alone))
            # suffixes that end before are alike to their ends
            company = company[left[rows[company]] >= depth]
            if depth > reach or not len(company):
                break
            some = rows[company]
            follow = np.where(left[some] > depth, rank[np.minimum(some + depth, n - 1)] + 1, 0)
            key = first[company] * (n + 1) + follow
            by = np.argsort(key, kind="quicksort")
            rows[company] = some[by]
            key = key[by]
            start = _group_starts(key)  # in the list of those with company
            group = _group_starts(first[company])
            first[company] += start - group
            rank[rows[company]] = first[company]
            depth *= 2
        if shared is None:  # no suffixes are alike that far
            shared = np.full(n, -1)
        # suffixes that are alike to their ends: in the order of the pieces
        tied = np.flatnonzero(np.repeat(alone > 1, alone))
        rows[tied] = rows[tied][np.argsort(first[tied] * n + rows[tied], kind="quicksort")]
        shared = shared[rows]
        return rows, (shared[1:] == shared[:-1]) & (shared[1:] >= 0)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Letters that the text has in common from ``a`` and ``b`` on."""
        out, live, n = np.zeros(len(a), np.int64), np.arange(len(a)), len(self.packed)
        for k in range(0, self.window + 8, 8):
            live = live[k < most[live]]
            if not len(live):
                break
            x, y = (np.where(p[live] + k < n, self.packed[np.minimum(p[live] + k, n - 1)], U(0)) for p in (a, b))
            same = x == y
            equal = np.full(len(live), 8)
            if not same.all():
                differ = x[~same] ^ y[~same]
                short = np.zeros(len(differ), np.int64)
                for j in range(8):
                    short += (differ >> U(56 - 8 * j)) == 0
                equal[~same] = short
            ended = (x & U(255)) == 0  # the text's end is among these letters
            out[live] += equal
            live = live[same & ~ended]
        return np.minimum(out, most)

    def stream(self, text: np.ndarray, size: np.ndarray):
        """Matching statistics of pieces, from their ends to their starts.
        Yields (piece, place in it, least piece of the index with the window)
        for the windows that the index has."""
        by = np.argsort(-size, kind="stable")
        size, ends = size[by], np.cumsum(size)[by]
        m = len(size)
        row, length, position = np.zeros(m, np.int64), np.zeros(m, np.int64), np.full(m, self.first[0])
        for step in range(int(size[0]) if m else 0):
            m = int(np.searchsorted(-size, -step, "left"))  # pieces longer than the step
            row, length, position = row[:m], length[:m], position[:m]
            letter = text[ends[:m] - (1 + step)] + np.uint8(1)
            run = self.run_at[row]
            other = np.flatnonzero(self.run_letter[run] != letter)
            lost = self._moved(other, letter[other].astype(np.int64), run, row, length, position) if len(other) else other
            row += self.step[run]
            position -= 1
            length += 1
            if len(lost):  # the index doesn't have the byte
                row[lost], position[lost], length[lost] = 0, self.first[0], 0
            if step >= self.window - 1:
                hit = np.flatnonzero(length >= self.window)
                if len(hit):
                    yield by[hit], size[hit] - 1 - step, self._least(row[hit], position[hit])

    def _moved(self, who, letter, run, row, length, position) -> np.ndarray:
        """Moves matches to the nearest run of the letter, above or below;
        returns those for whom there is none."""
        runs = len(self.run_start)
        below = np.searchsorted(self.by_letter, letter * runs + run[who])
        most = np.minimum(length[who], self.window)
        near = []
        for slot, sample in ((below - 1, self.last), (below, self.first)):
            r = self.order[np.clip(slot, 0, runs - 1)]
            inside = (slot >= 0) & (slot < runs) & (self.run_letter[r] == letter)
            near.append((np.where(inside, self._common(position[who], sample[r], most), -1), r, sample[r]))
        up = near[0][0] >= near[1][0]
        kept, r, place = (np.where(up, a, b) for a, b in zip(*near))
        run[who], position[who], length[who] = r, place, kept
        row[who] = self.run_start[r] + np.where(up, self.run_size[r] - 1, 0)
        return who[kept < 0]

    def _least(self, row: np.ndarray, position: np.ndarray) -> np.ndarray:
        own = self.piece[position]
        if not len(self.group_start):
            return own
        slot = np.maximum(np.searchsorted(self.group_start, row, "right") - 1, 0)
        grouped = (self.group_start[slot] <= row) & (row < self.group_end[slot])
        return np.where(grouped, self.group_least[slot], own)


def narrowed(pieces: Pieces, window: int) -> Pieces | None:
    """The pieces cut down to windows whose surroundings come twice: ten
    neighbouring windows share a stretch of the text, and equal windows have
    it at the same place. Anchors that recur in ever other texts end here."""
    ahead = pieces.anchor - pieces.start
    last = ahead - (pieces.size - window)  # the anchor's offset in the last window
    least = last // RANGE
    n = ahead // RANGE - least + 1
    piece = np.repeat(np.arange(len(n)), n)
    tens = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + least[piece]
    begin = np.cumsum(pieces.size) - pieces.size
    at = begin[piece] + ahead[piece] - RANGE * tens
    context = np.zeros(len(piece), U)
    # hashed a slice's bytes at a time, which is what the tables are made for
    cuts = np.searchsorted(begin, np.arange(0, len(pieces.text) + SLICE, SLICE))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            low, high = begin[a], begin[b - 1] + pieces.size[b - 1]
            mine = slice(*np.searchsorted(piece, [a, b]))
            context[mine] = hasher(pieces.text[low:high])(at[mine] - low, window - RANGE + 1)
    context += tens.astype(U)
    order = np.argsort(context, kind="quicksort")
    same = context[order][1:] == context[order][:-1]
    twice = np.zeros(len(context), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    piece, tens = piece[twice], tens[twice]
    if not len(piece):
        return None
    head = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    piece, low, high = piece[head], tens[head], tens[np.r_[head[1:], len(tens)] - 1]
    first = np.maximum(0, ahead[piece] - (RANGE * high + RANGE - 1))
    size = np.minimum(pieces.size[piece] - window, ahead[piece] - RANGE * low) - first + window
    where = np.repeat(begin[piece] + first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    return Pieces(pieces.key[piece], pieces.id[piece], pieces.rid[piece], pieces.start[piece] + first, pieces.anchor[piece], size, pieces.text[where])


def later_windows(pieces: Pieces, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(piece, place in it) of every window that an earlier piece has. The
    pieces are in the order of (key, id, anchor)."""
    by = np.lexsort((pieces.anchor, pieces.id))
    order = np.zeros(len(by), np.int64)
    order[by] = np.cumsum(np.r_[False, (pieces.id[by][1:] != pieces.id[by][:-1]) | (pieces.anchor[by][1:] != pieces.anchor[by][:-1])])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    reference = np.r_[True, pieces.key[1:] != pieces.key[:-1]]
    numbers = np.arange(len(order))
    rest = numbers[~reference]
    explained = np.zeros(len(order), np.int64)
    for members in (numbers[reference], None):
        if members is None:  # what no reference explains
            members = rest = rest[explained[rest] < pieces.size[rest] - window + 1]
        if not len(members) or not len(rest):
            break
        # numbered by order, so that the least number is the earliest
        members = members[np.argsort(order[members], kind="stable")]
        ranked = order[members]
        starts = np.cumsum(pieces.size) - pieces.size
        index = RunIndex(_bytes(pieces, starts, members), pieces.size[members], window)
        for a in range(0, len(rest), STREAM):
            some = rest[a:a + STREAM]
            for who, place, least in index.stream(_bytes(pieces, starts, some), pieces.size[some]):
                who = some[who]
                later = ranked[least] < order[who]
                out.append((who[later], place[later]))
                np.add.at(explained, who[later], 1)
    return out


def _bytes(pieces: Pieces, starts: np.ndarray, take: np.ndarray) -> np.ndarray:
    size = pieces.size[take]
    return pieces.text[np.repeat(starts[take] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


def _indexed(window: int):
    """Reduce side: one shard's blobs to the spans of its repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rids, spans, blobs = [], [], [], []
        for batch in batches:
            for kind, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                blob = value.as_buffer()
                if kind:
                    id_, rid = np.frombuffer(blob, "<i8", 2).tolist()
                    ids.append(id_)
                    rids.append(rid)
                    spans.append(blob.to_pybytes()[16:])
                else:
                    blobs.append(blob)
        keys = np.sort(np.concatenate([Pieces.keys_of(b) for b in blobs] or [np.zeros(0, np.uint32)]))
        again = np.unique(keys[1:][keys[1:] == keys[:-1]])
        del keys
        parts = []
        for blob in blobs if len(again) else ():
            key = Pieces.keys_of(blob)
            if (hit := again[np.minimum(np.searchsorted(again, key), len(again) - 1)] == key).any():
                parts.append(Pieces.unpacked(blob, window).only(hit))
        if parts:
            pieces = narrowed(Pieces.together(parts), window)
            del parts, blobs
        else:
            pieces = None
        if pieces is not None:
            by = np.lexsort((pieces.rid, pieces.anchor, pieces.id, pieces.key))
            starts = np.cumsum(pieces.size) - pieces.size
            columns = [getattr(pieces, f)[by] for f in Pieces.FIELDS]
            pieces = Pieces(*columns, _bytes(pieces, starts, by))
            found = later_windows(pieces, window)
            if found:
                who, place = (np.concatenate(x) for x in zip(*found))
                lo = pieces.start[who] + place
                for out, more in zip((ids, rids, spans), spans_of(pieces.id[who], pieces.rid[who], lo, lo + window)):
                    out += more
        if ids:
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(rids, pa.int64()), pa.array(spans, pa.binary())], names=["id", "rid", "spans"])

    return run


def hot_buckets(rows: DataFrame, how: Keying, finer: bool, bound: int) -> np.ndarray:
    """Buckets of the keys that more than ``bound`` pieces, or one in 2**20 of
    all, would go to: at most 2**20 of them."""
    counts = rows.mapInArrow(tokens.tidy(_counted(how, finer)), "shard int, blob binary")
    often = written(counts.repartitionById(how.shards, "shard").mapInArrow(tokens.tidy(_often), "bucket long, n long"), "hot-anchors")
    total = often.where("bucket = -1").agg(F.sum("n")).first()[0] or 0
    least = max(bound, total >> 20)
    return np.sort(np.array([r.bucket for r in often.where((F.col("bucket") >= 0) & (F.col("n") > least)).select("bucket").collect()], np.int64))


def identified(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("rid"), F.col(text_col).alias("text")]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, anchor: int = 16, bound: int = HOT) -> DataFrame:
    """(id, rid, spans): the byte ranges of each text that are covered by
    windows with an earlier start, maximal and in order."""
    if not RANGE < window or not 0 < anchor <= window:
        raise ValueError(f"windows of {window} bytes don't hold anchors of {anchor} or surroundings of {RANGE} windows")
    rows = docs.select(*identified(docs, id_col, text_col))
    none = np.zeros(0, np.int64)
    how = Keying(window, anchor, shard_count(docs, SHARD_BYTES), none, none)
    how.hot = hot_buckets(rows, how, False, bound)
    if len(how.hot):
        how.hotter = hot_buckets(rows, how, True, bound)
    dealt = rows.mapInArrow(tokens.tidy(_dealt(how)), "shard int, kind int, blob binary")
    found = dealt.repartitionById(how.shards, "shard").mapInArrow(tokens.tidy(_indexed(window)), SPANS)
    return found.groupBy("id", "rid").agg(F.collect_list("spans").alias("parts")).mapInArrow(_united, SPANS)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for parts in batch.column(2).to_pylist():
            lo, hi = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2).T
            zero = np.zeros(len(lo), np.int64)
            out += spans_of(zero, zero, lo, hi)[2]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "rid", "spans"])


PACKED = "id long, rid long, size long, packed binary"


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: what travels to meet the spans."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        size = [None if t is None else len(t) for t in (v.as_buffer() for v in texts)]
        packed = [None if t is None else codec.compress(t, asbytes=True) for t in (v.as_buffer() for v in texts)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(packed, pa.binary())], names=["id", "rid", "size", "packed"])


_unpacking = pa.Codec("zstd")


def _text(size: int | None, packed: bytes | None) -> bytes | None:
    return None if packed is None else _unpacking.decompress(packed, decompressed_size=size, asbytes=True)


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, packed, spans) of every document."""
    rows = docs.select(*identified(docs, id_col, text_col)).mapInArrow(tokens.tidy(_packed_texts), PACKED)
    held = spans.select(F.col("id").alias("s_id"), F.col("rid").alias("s_rid"), "spans")
    same = (F.coalesce("id", F.lit(LAST)) == F.col("s_id")) & (F.col("rid") == F.col("s_rid"))
    return rows.join(held, same, "left").select("id", "size", "packed", "spans")


def _kept(text: bytes, spans: bytes | None) -> tuple[list[bytes], int, int]:
    """What remains of a text, the bytes removed and the number of spans."""
    if not spans:
        return [text], 0, 0
    ranges = np.frombuffer(spans, "<i8").reshape(-1, 2).tolist()
    edges = [0, *[x for r in ranges for x in r], len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])], sum(b - a for a, b in ranges), len(ranges)


def repeat_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, anchor: int = 16, bound: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""

    def run(batches):
        for batch in batches:
            out = []
            for size, packed, spans in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                text = _text(size, packed) or b""
                kept, gone, n = _kept(text, spans)
                sha = hashlib.sha256()
                for part in kept:
                    sha.update(part)
                out.append((len(text), gone, n, sha.hexdigest()))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(),) * 3 + (pa.string(),))] if out else [pa.array([], t) for t in (pa.int64(),) * 3 + (pa.string(),)]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _with_spans(docs, repeated_spans(docs, id_col, text_col, window, anchor, bound), id_col, text_col)
    return joined.mapInArrow(tokens.tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, anchor: int = 16) -> DataFrame:
    """(doc_id, kept, spans): the bytes that remain of each text (null of a
    null text), and the ranges that went."""

    def run(batches):
        for batch in batches:
            sizes, packed, spans = (batch.column(i).to_pylist() for i in (1, 2, 3))
            kept = [None if (text := _text(n, z)) is None else b"".join(_kept(text, s)[0]) for n, z, s in zip(sizes, packed, spans)]
            ranges = [np.frombuffer(s or b"", "<i8").reshape(-1, 2).tolist() for s in spans]
            yield pa.record_batch([batch.column(0), pa.array(kept, pa.binary()), pa.array(ranges, pa.list_(pa.list_(pa.int64())))], names=["doc_id", "kept", "spans"])

    joined = _with_spans(docs, repeated_spans(docs, id_col, text_col, window, anchor), id_col, text_col)
    return joined.mapInArrow(tokens.tidy(run), "doc_id long, kept binary, spans array<array<long>>")
