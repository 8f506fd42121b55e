"""SentencePiece encoding and decoding with exact N-best lists (operator 4).

A text gets a space before it and is cut where a space follows another sign;
no piece reaches over such a cut (checked when a vocabulary is loaded; where
one does, texts are not cut), so a text's lattice is its chunks' lattices one
after the other. The distinct chunks of a slice share one lattice in numpy
arrays: a walk down the piece trie gives the edges, and a forward Viterbi
pass gives each position its best and second-best score.

N-best lists come from a backward A* search per chunk, from its end to its
start, with the forward scores as exact heuristic, so hypotheses complete in
order of score. Only a text's ``n - 1`` chunks with the least loss from best
to second best can take part in its ``n`` best segmentations; these are
searched, and a best-first walk over their choices combines them.

Scores add up along a segmentation, so they must be log-probabilities. The
scores in the file of a byte-pair model are merge ranks; ``fitted`` puts
log-probabilities in their place, from the model's own encoding of the
documents. The best segmentation is that of the unigram model, which on some
words is not what the byte-pair merges give.

Defined results: null and empty texts have no pieces and score 0. Signs
without a piece become byte pieces, or the unknown piece if the vocabulary
has none, at the least score less 10. Of equally good segmentations the one
whose last differing piece is longer comes first. Decoding the pieces gives
the text back, byte for byte, unless an unknown piece stands for a sign.
Repeated rows are encoded alike. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

SPACE = 0x20
UNKNOWN_LOSS = 10.0
SCORE_STEP = 2.0 ** -20  # fitted scores are multiples of it: sums are exact in any order
HELD_BYTES = 4 << 20  # of distinct chunks that a task counts before it encodes them


@dataclass
class Vocabulary:
    """Pieces as bytes, the space sign as a space. Small: it travels with the
    tasks."""

    pieces: list[bytes]
    scores: np.ndarray
    usable: np.ndarray  # pieces that may be matched in a text
    byte_ids: list[int]  # ids of the byte pieces, or empty
    unknown: int
    _trie: tuple | None = field(default=None, repr=False)
    _table: tuple | None = field(default=None, repr=False)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The pieces with the scores in the file, which are merge ranks if
        the model is a byte-pair one (see ``fitted``)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        bytes_of = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        usable = np.array([not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)])
        by_byte = {bytes_of[i]: i for i in range(n) if model.is_byte(i)}
        byte_ids = [by_byte[bytes([b])] for b in range(256)] if len(by_byte) == 256 else []
        return cls(bytes_of, np.array([model.get_score(i) for i in range(n)]), usable, byte_ids, model.unk_id())

    def __getstate__(self):
        return {**self.__dict__, "_trie": None, "_table": None}

    @property
    def unknown_score(self) -> float:
        return float(self.scores[self.usable].min()) - UNKNOWN_LOSS if self.usable.any() else -UNKNOWN_LOSS

    def cuts_at_spaces(self) -> bool:
        return not any(b" " in p.lstrip(b" ") for p, ok in zip(self.pieces, self.usable) if ok)

    def trie(self):
        """Open-addressed table of the transitions (node * 256 + byte -> node)
        and the piece that ends at each node, or -1."""
        if self._trie is None:
            step, ends = {}, [-1]
            for i in np.flatnonzero(self.usable):
                node = 0
                for b in self.pieces[i]:
                    key = node * 256 + b
                    if key not in step:
                        step[key] = len(ends)
                        ends.append(-1)
                    node = step[key]
                if node and (ends[node] < 0 or self.scores[i] > self.scores[ends[node]]):
                    ends[node] = int(i)
            bits = max(4, (3 * len(step)).bit_length())
            keys, values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
            for key, node in step.items():
                at = (key * 0x9E3779B97F4A7C15 % 2**64) >> (64 - bits)
                while keys[at] >= 0:
                    at = (at + 1) & ((1 << bits) - 1)
                keys[at], values[at] = key, node
            self._trie = keys, values, np.array(ends), bits
        return self._trie

    def walk(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node one byte further, or -1."""
        keys, values, _, bits = self.trie()
        key = node * 256 + byte
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
        out, open_ = np.full(len(key), -1), np.arange(len(key))
        while len(open_):
            found = keys[at]
            hit = found == key
            out[open_[hit]] = values[at[hit]]
            on = ~hit & (found >= 0)
            open_, key, at = open_[on], key[on], (at[on] + 1) & ((1 << bits) - 1)
        return out

    def table(self) -> tuple[dict[bytes, tuple[int, float]], int]:
        """Piece and score of each usable piece's bytes, and the longest."""
        if self._table is None:
            found: dict[bytes, tuple[int, float]] = {}
            for i in np.flatnonzero(self.usable).tolist():
                if self.pieces[i] and (self.pieces[i] not in found or self.scores[i] > found[self.pieces[i]][1]):
                    found[self.pieces[i]] = (i, float(self.scores[i]))
            self._table = found, max(map(len, found), default=1)
        return self._table

    def decode(self, ids) -> bytes:
        """The bytes that the pieces stand for."""
        raw = b"".join(map(self.pieces.__getitem__, ids))
        return raw[1:] if raw[:1] == b" " else raw


LONG_CHUNK = 64  # bytes; longer chunks are rare and go through a plain loop


class Lattice:
    """Lattices of chunks that lie one after the other in ``text``. Position p
    is the place before byte p, and each chunk has one more at its end.
    ``best`` and ``second`` are the forward Viterbi scores; ``via`` and
    ``piece`` are the last step of the best way into a position."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary):
        size = ends - starts
        self.vocabulary = vocabulary
        self.first = np.cumsum(size + 1) - size - 1
        self.last = self.first + size
        n = int(size.sum()) + len(size)
        depth = np.arange(n, dtype=np.int32) - np.repeat(self.first.astype(np.int32), size + 1)
        self.text = np.zeros(n, np.uint8)
        inside = np.ones(n, bool)
        inside[self.last] = False
        self.text[inside] = data[np.repeat(starts, size) + depth[inside]]
        opens = (inside & ((self.text & 0xC0) != 0x80)) | (depth == 0)  # signs begin here
        self.sign_ends = opens | ~inside
        self.best, self.second = np.full(n, -np.inf), np.full(n, -np.inf)
        self.best[self.first] = 0.0
        self.via, self.piece = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        long = size > LONG_CHUNK
        origin = np.flatnonzero(opens & inside & ~np.repeat(long, size + 1))
        by_depth = np.argsort(depth[origin], kind="stable")
        bounds = np.searchsorted(depth[origin][by_depth], np.arange(LONG_CHUNK + 1))
        stop = np.repeat(self.last.astype(np.int32), size + 1)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if lo < hi:
                self._push(origin[by_depth[lo:hi]], stop)
        for k in np.flatnonzero(long):
            self._push_long(int(k))

    def _push(self, origin: np.ndarray, stop: np.ndarray) -> None:
        """All pieces that start at these positions, which are of one depth,
        so that no two pieces of a length share their end."""
        of_node, scores = self.vocabulary.trie()[2], self.vocabulary.scores
        named = np.zeros(len(origin), bool)
        live, at, node = np.arange(len(origin)), origin, np.zeros(len(origin), np.int64)
        limit = stop[origin]
        while len(live):
            ok = at < limit
            live, at, node, limit = live[ok], at[ok], node[ok], limit[ok]
            node = self.vocabulary.walk(node, self.text[at].astype(np.int64))
            ok = node >= 0
            live, at, node, limit = live[ok], at[ok] + 1, node[ok], limit[ok]
            piece = of_node[node]
            hit = piece >= 0
            whole, to, piece = live[hit], at[hit], piece[hit]
            self._relax(origin[whole], to, piece, scores[piece])
            # a piece of one sign: it ends where the next sign begins, not before
            sign = self.sign_ends[to]
            named[whole[sign & ~self._crosses(origin[whole], to)]] = True
        lone = origin[~named]
        if len(lone):
            to = lone + 1
            while not (done := self.sign_ends[to]).all():
                to = np.where(done, to, to + 1)
            self._relax(lone, to, np.full(len(lone), -1), self.vocabulary.unknown_score)

    def _crosses(self, begin: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Whether more than one sign lies between the positions."""
        out = np.zeros(len(begin), bool)
        at = begin + 1
        while (on := at < to).any():
            out |= on & self.sign_ends[np.minimum(at, to)]
            at = at + 1
        return out

    def _relax(self, begin, to, piece, score) -> None:
        one, two, old = self.best[begin] + score, self.second[begin] + score, self.best[to]
        better = one > old
        self.second[to] = np.maximum(np.minimum(old, one), np.maximum(self.second[to], two))
        self.best[to] = np.maximum(old, one)
        self.via[to[better]], self.piece[to[better]] = begin[better], piece[better]

    def edges(self, chunk: int):
        """(begin, end, piece, score) of a chunk's edges, by begin."""
        lo, hi = int(self.first[chunk]), int(self.last[chunk])
        raw, table, longest = self.text[lo:hi].tobytes(), *self.vocabulary.table()
        places = [p for p in np.flatnonzero(self.sign_ends[lo:hi + 1]).tolist()]
        for begin, sign_end in zip(places, places[1:]):
            lone = True
            for end in range(begin + 1, min(begin + longest, len(raw)) + 1):
                if (found := table.get(raw[begin:end])) is not None:
                    yield lo + begin, lo + end, *found
                    lone = lone and end != sign_end
            if lone:
                yield lo + begin, lo + sign_end, -1, self.vocabulary.unknown_score

    def _push_long(self, chunk: int) -> None:
        best, second = self.best, self.second
        for begin, end, piece, score in self.edges(chunk):
            one, two, old = best[begin] + score, second[begin] + score, best[end]
            second[end] = max(min(old, one), second[end], two)
            if one > old:
                best[end], self.via[end], self.piece[end] = one, begin, piece

    def loss(self) -> np.ndarray:
        """What each chunk's second-best segmentation loses."""
        return self.best[self.last] - self.second[self.last]

    def best_paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(ends of the steps of all best paths in order, where each chunk's
        start)."""
        on = np.zeros(len(self.text) + 1, bool)
        at, first = self.last, self.first
        while len(at):
            on[at[at > first]] = True
            ok = at > first
            at, first = self.via[at[ok]], first[ok]
        steps = np.flatnonzero(on)
        return steps, np.r_[np.searchsorted(steps, self.first, "right"), len(steps)]

    def n_best(self, chunk: int, n: int) -> list[tuple[float, list[tuple[int, int, int]]]]:
        """The chunk's ``n`` best segmentations, best first, as steps (begin,
        end, piece): backward A*."""
        incoming: dict[int, list] = {}
        for begin, end, piece, score in self.edges(chunk):
            incoming.setdefault(end, []).append((begin, piece, score))
        start, goal = int(self.last[chunk]), int(self.first[chunk])
        best = self.best
        heap, count, out = [(-float(best[start]), 0, start, 0.0, None)], 0, []
        while heap and len(out) < n:
            total, _, at, tail, path = heapq.heappop(heap)
            if at == goal:
                steps = []
                while path:
                    steps.append(path[0])
                    path = path[1]
                out.append((-total, steps))
                continue
            for begin, piece, score in incoming.get(at, ()):
                count += 1
                gone = tail + score
                heapq.heappush(heap, (-(float(best[begin]) + gone), count, begin, gone, ((begin, at, piece), path)))
        return out


def chunks(s: tokens.Slice, cut: bool):
    """(bytes, starts, ends, bounds of each text, a place of each distinct
    chunk, which of these each chunk is) of a slice."""
    filled = np.diff(s.offsets) > 0
    data = np.insert(s.data, s.offsets[:-1][filled], SPACE)
    offsets = s.offsets + np.r_[0, np.cumsum(filled)]
    opens = np.zeros(len(data) + 1, bool)
    if cut:
        opens[1:-1] = (data[1:] == SPACE) & (data[:-1] != SPACE)
    opens[offsets[:-1][filled]] = True
    starts = np.flatnonzero(opens[:-1])
    ends = np.r_[starts[1:], len(data)] if len(starts) else starts
    bounds = np.searchsorted(starts, offsets)
    hashes = tokens.word_hashes(tokens.Slice(0, data, offsets, starts, ends, bounds))
    _, where, kind = np.unique(hashes, return_index=True, return_inverse=True)
    return data, starts, ends, bounds, where, kind


class Encoder:
    """Encodes the texts of a slice."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.vocabulary, self.n, self.cut = vocabulary, n, vocabulary.cuts_at_spaces()

    def ids(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of steps, and how many each step has: a sign without a
        piece has its bytes."""
        lone = piece < 0
        if not lone.any():
            return piece, np.ones(len(piece), int)
        if not self.vocabulary.byte_ids:
            return np.where(lone, self.vocabulary.unknown, piece), np.ones(len(piece), int)
        n = np.where(lone, end - begin, 1)
        out = np.repeat(piece, n)
        at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        raw = np.repeat(lone, n)
        out[raw] = np.array(self.vocabulary.byte_ids)[text[at[raw]]]
        return out, n

    def encode(self, s: tokens.Slice):
        """(ids of the best segmentation, scores of the n best, differences)
        of each text. A difference is what an alternative has in place of the
        best: a list of (chunk number, ids)."""
        data, starts, ends, bounds, where, kind = chunks(s, self.cut)
        net = Lattice(data, starts[where], ends[where], self.vocabulary)
        steps, cuts = net.best_paths()
        flat, per_step = self.ids(net.text, net.via[steps], steps, net.piece[steps])
        begin_ids = np.r_[0, np.cumsum(per_step)][cuts]
        n_ids, begin_ids = np.diff(begin_ids), begin_ids[:-1]
        loss, top = net.loss(), net.best[net.last]
        lists: dict[int, list] = {}
        for i in range(s.n_texts):
            mine = kind[bounds[i]:bounds[i + 1]]
            n = n_ids[mine]
            take = np.repeat(begin_ids[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
            total = float(top[mine].sum())
            yield flat[take], *self.alternatives(mine, loss, total, net, lists)

    def alternatives(self, mine, loss, total, net, lists):
        if not len(mine) or self.n < 2:
            return [total], [[]]
        lost = loss[mine]
        few = np.argpartition(lost, self.n - 2)[:self.n - 1] if len(mine) >= self.n else np.arange(len(mine))
        few = np.sort(few[np.isfinite(lost[few])])
        choices = []
        for place in few:
            k = int(mine[place])
            if k not in lists:
                lists[k] = net.n_best(k, self.n)
            choices.append(lists[k])
        # best-first over how far down each list to go
        heap, seen, scores, changes = [(0.0, (0,) * len(few))], {(0,) * len(few)}, [], []
        while heap and len(scores) < self.n:
            lost_now, ranks = heapq.heappop(heap)
            scores.append(total - lost_now)
            changes.append([(int(place), self.ids(net.text, *np.array(choices[j][r][1]).T)[0].tolist()) for j, (place, r) in enumerate(zip(few, ranks)) if r])
            for j, r in enumerate(ranks):
                following = ranks[:j] + (r + 1,) + ranks[j + 1:]
                if r + 1 < len(choices[j]) and following not in seen:
                    seen.add(following)
                    heapq.heappush(heap, (lost_now + choices[j][r][0] - choices[j][r + 1][0], following))
        return scores, changes


def own_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(piece, n): how often each piece stands in the model's own encoding of
    the documents' whole texts. Null and empty texts have none."""
    import sentencepiece

    proto, cut = sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto(), Vocabulary.load(path).cuts_at_spaces()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        space, total, held, size = model.piece_to_id("▁"), np.zeros(model.get_piece_size(), np.int64), {}, 0

        def settle() -> None:
            # the model puts the first space itself, but not into an empty text
            ids = [x or [space] for x in model.encode([c[1:].decode() for c in held], num_threads=1)]
            times = np.repeat(np.fromiter(held.values(), np.int64, len(held)), [len(x) for x in ids])
            np.add.at(total, np.array([i for x in ids for i in x], np.int64), times)
            held.clear()

        for batch in batches:
            for s in tokens.slices(batch.column(0), slice_bytes=1 << 20):
                data, starts, ends, _, where, kind = chunks(s, cut)
                raw = data.tobytes()
                for begin, end, n in zip(starts[where].tolist(), ends[where].tolist(), np.bincount(kind).tolist()):
                    chunk = raw[begin:end]
                    size += 0 if chunk in held else len(chunk)
                    held[chunk] = held.get(chunk, 0) + n
                if size > HELD_BYTES:
                    settle()
                    size = 0
        if held:
            settle()
        piece = np.flatnonzero(total)
        yield pa.record_batch([pa.array(piece, pa.int32()), pa.array(total[piece], pa.int64())], names=["piece", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(tokens.tidy(run), "piece int, n long")
    return rows.groupBy("piece").agg(F.sum("n").alias("n"))


def fitted(docs: DataFrame, path: str, text_col: str = "text") -> Vocabulary:
    """The model's pieces with the log-probabilities of the unigram model that
    is likeliest for the model's own encoding of the documents; each usable
    piece counts once more."""
    vocabulary, count = Vocabulary.load(path), {r.piece: r.n for r in own_counts(docs, path, text_col).collect()}  # one row per piece
    n = np.array([count.get(i, 0) for i in range(len(vocabulary.pieces))], float) + vocabulary.usable
    scores = np.log(np.maximum(n, 1) / max(n.sum(), 1))
    return replace(vocabulary, scores=np.round(scores / SCORE_STEP) * SCORE_STEP)


CHANGES = "array<array<struct<chunk:int,ids:array<int>>>>"
CHANGE_LISTS = pa.list_(pa.list_(pa.struct([("chunk", pa.int32()), ("ids", pa.list_(pa.int32()))])))


def change_lists(changes: list) -> list:
    return [[{"chunk": c, "ids": x} for c, x in one] for one in changes]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", n: int = 4) -> DataFrame:
    """(doc_id, ids, scores, alternatives): the best segmentation's pieces, the
    scores of the ``n`` best, and how each of these differs from the best:
    the chunks (by number within the text) that it cuts otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, n)
        for batch in batches:
            for s in tokens.slices(batch.column(1), slice_bytes=1 << 20):
                out = list(encoder.encode(s))
                changes = [change_lists(o[2]) for o in out]
                yield pa.record_batch([batch.column(0).slice(s.row, s.n_texts), id_lists([o[0] for o in out]),
                                       pa.array([o[1] for o in out], pa.list_(pa.float64())), pa.array(changes, CHANGE_LISTS)], names=["doc_id", "ids", "scores", "alternatives"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokens.tidy(run), f"doc_id long, ids array<int>, scores array<double>, alternatives {CHANGES}")


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(x) for x in ids], dtype=np.int64)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, int)]).astype(np.int32)))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with a column of the texts that its pieces stand for; null
    ids give a null text. Bytes that are no UTF-8 become the replacement sign."""

    @F.pandas_udf("string")
    def text_of(ids):
        return ids.map(lambda x: None if x is None else vocabulary.decode(x).decode("utf-8", "replace"))

    return encoded.withColumn(text_col, text_of(F.col(ids_col)))


def segmentation_digest(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", n: int = 4) -> DataFrame:
    """(doc_id, n_pieces, score, nbest_scores, ids_sha256, round_trip,
    alternatives): the hash is that of the best ids as little-endian 32-bit
    numbers; round_trip: decoding gives the text back; alternatives as in
    ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, n)
        for batch in batches:
            for s in tokens.slices(batch.column(1), slice_bytes=1 << 20):
                size, best, scores, sha, back, changes = [], [], [], [], [], []
                for i, (ids, top, others) in enumerate(encoder.encode(s)):
                    size.append(len(ids))
                    best.append(top[0])
                    scores.append(top)
                    changes.append(change_lists(others))
                    sha.append(hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest())
                    back.append(vocabulary.decode(ids.tolist()) == s.data[s.offsets[i]:s.offsets[i + 1]].tobytes())
                yield pa.record_batch([batch.column(0).slice(s.row, s.n_texts), pa.array(size, pa.int64()), pa.array(best, pa.float64()), pa.array(scores, pa.list_(pa.float64())),
                                       pa.array(sha, pa.string()), pa.array(back, pa.bool_()), pa.array(changes, CHANGE_LISTS)], names=["doc_id", "n_pieces", "score", "nbest_scores", "ids_sha256", "round_trip", "alternatives"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokens.tidy(run), f"doc_id long, n_pieces long, score double, nbest_scores array<double>, ids_sha256 string, round_trip boolean, alternatives {CHANGES}")
