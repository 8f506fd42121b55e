"""Substring dedup by seed and extend (operator 9).

Seeds are winnowed anchors: of every window of ``window`` words the ``anchor``
words whose hash is least. Equal windows choose the same anchor at the same
place, so repeats of ``window`` words or more meet at an anchor. An anchor's
row carries its extensions both ways: a hash of every window that chose it.
Rows are dealt out by anchor; only anchors that occur more than once are
extended. There each window's occurrences are compared with the first of
them, in the order of (document, position), and every later one is a repeat.
No match is grown word by word: a repeat longer than a window is the union of
its windows, which is made per document after all reducers, so that spans are
maximal. No pairs are made.

A map task combines its own windows first: of equal windows only the first
goes to the reducers, so a passage in a third of all documents costs a few
rows per map task. A phrase shorter than a window can be the anchor of very
many different windows; a pass over the texts before finds the anchors of
``HOT_WINDOWS`` windows and more, and their windows are dealt out one by one,
by their own hash: equal ones meet all the same, and no task gets the anchor
whole. Windows are compared by 64 bits, never word by word: there
by their own hash, in a reducer by one made of the anchor's 64 bits, 48 of the
window and the anchor's place in it.

Defined results: null or empty text has no words and no spans. Rows are
identified by id and text; repeated rows have equal ids, so none of them is
earlier than the other. Null ids come last. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import column, shard_count

U = np.uint64
LAST = np.iinfo(np.int64).max  # stands for a null id
SEED_BYTES = 1 << 20  # text that a map task combines at a time
SHARD_BYTES = 16 << 20  # input per reducer, whose anchors it holds at once
HOT_WINDOWS = 1 << 16  # windows of one anchor that a reducer may get
HOT_IN_SLICE = 32  # windows in one slice from which an anchor is counted
SPANS = "id long, rid long, spans binary"


def _ids(column) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _choose(grams: np.ndarray, n_windows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the position of its anchor and the anchor's hash."""
    best, at = grams[:n_windows].copy(), np.arange(n_windows)
    for step in range(1, width):
        other = grams[step:step + n_windows]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + step
    return at, best


def _spans_of(doc: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the windows (sorted by doc and start) as maximal spans."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (begin[1:] > begin[:-1] + window)] if len(doc) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    tail = np.r_[head[1:] - 1, len(doc) - 1] if len(head) else head
    return doc[head], begin[head], begin[tail] + window


def _span_rows(id_: np.ndarray, rid: np.ndarray, doc: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """One (id, rid, spans) for each document index in ``doc``."""
    order = np.lexsort((begin, doc))
    doc, lo, hi = _spans_of(doc[order], begin[order], window)
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, int)
    packed = np.stack([lo, hi], 1).astype(np.int32)
    cuts = np.r_[heads, len(doc)]
    return id_[doc[heads]], rid[doc[heads]], [packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def _chosen(s, window: int, anchor: int):
    """(windows within one text, place of each window's anchor, its hash) of a
    slice; None without any."""
    h = tokens.word_hashes(s)
    n = len(h) - window + 1
    if n <= 0:
        return None
    whole = np.flatnonzero(tokens.room(s)[:n] >= window)
    if not len(whole):
        return None
    return h, whole, *_choose(tokens.gram_hashes(h, anchor), n, window - anchor + 1)


def hot_anchors(texts: DataFrame, window: int, anchor: int, least: int) -> np.ndarray:
    """Sorted hashes of the anchors of ``least`` windows and more, so few that
    they travel with the tasks. Slices with fewer than HOT_IN_SLICE windows of
    an anchor are not counted for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tokens.slices(batch.column(0), slice_bytes=SEED_BYTES):
                if (found := _chosen(s, window, anchor)) is not None:
                    hashes, n = np.unique(found[3][found[1]], return_counts=True)
                    often = n >= HOT_IN_SLICE
                    yield pa.record_batch([pa.array(hashes[often].view(np.int64)), pa.array(n[often])], names=["anchor", "n"])

    counts = texts.mapInArrow(tokens.tidy(run), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r.anchor for r in counts.where(F.col("n") >= least).select("anchor").collect()], np.int64).view(U))


def _seeds(window: int, anchor: int, shards: int, hot: np.ndarray):
    """Map side: (shard, kind, blob) with kind 0 anchors and 1 spans found here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rids = _ids(batch.column(0)), batch.column(1).to_numpy()
            for s in tokens.slices(batch.column(2), slice_bytes=SEED_BYTES):
                at = slice(s.row, s.row + s.n_texts)
                yield from _slice_rows(s, ids[at], rids[at])

    def _slice_rows(s, ids, rids):
        if (found := _chosen(s, window, anchor)) is None:
            return
        h, whole, pos, seed = found
        n = len(pos)
        full = tokens.gram_hashes(h, window)
        doc = s.text_of_word()
        # this slice's own repeats: of equal windows only the first goes on
        keys = full[whole]
        order = np.argsort(keys, kind="stable")
        run_new = np.r_[True, keys[order][1:] != keys[order][:-1]]
        if not run_new.all():
            sizes = np.diff(np.r_[np.flatnonzero(run_new), len(order)])
            again = np.flatnonzero(np.repeat(sizes > 1, sizes))
            w = whole[order[again]]
            place = w - s.first[doc[w]]
            key = keys[order[again]]
            by = np.lexsort((place, ids[doc[w]], key))
            w, place, key = w[by], place[by], key[by]
            new = np.r_[True, key[1:] != key[:-1]]
            head = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
            later = (ids[doc[w]] != ids[doc[w[head]]]) | (place != place[head])
            if later.any():
                out_id, out_rid, spans = _span_rows(ids, rids, doc[w[later]], place[later], window)
                yield _rows((tokens.mix(out_rid.view(U)) % U(shards)).astype(np.int32), 1, [i.tobytes() + r.tobytes() + b for i, r, b in zip(out_id, out_rid, spans)])
                dropped = np.zeros(n, bool)
                dropped[w[later]] = True
                whole = whole[~dropped[whole]]
                if not len(whole):
                    return
        # one row for a run of windows that chose the same anchor occurrence,
        # and for each window of a hot anchor
        p = pos[whole]
        alone = np.isin(seed[whole], hot)
        head = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (whole[1:] != whole[:-1] + 1)] | alone)
        count = np.diff(np.r_[head, len(whole)])
        w0 = whole[head]
        hashes, d = seed[w0], doc[w0]
        shard = (tokens.mix(np.where(alone[head], full[w0], hashes)) % U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        windows = np.ascontiguousarray(full[whole].view(np.uint8).reshape(-1, 8)[:, :6])
        blobs, to = [], []
        for k in range(shards):
            o = order[cut[k]:cut[k + 1]]
            if not len(o):
                continue
            docs_here, local = np.unique(d[o], return_inverse=True)
            take = np.repeat(head[o] - np.cumsum(count[o]) + count[o], count[o]) + np.arange(count[o].sum())
            parts = [np.array([len(o), len(docs_here)], np.int64), ids[docs_here], rids[docs_here], hashes[o],
                     (w0[o] - s.first[d[o]]).astype(np.int32), local.astype(np.int32),
                     (pos[w0[o]] - w0[o]).astype(np.uint8), count[o].astype(np.uint8), windows[take]]
            blobs.append(b"".join(x.tobytes() for x in parts))
            to.append(k)
        yield _rows(np.array(to, np.int32), 0, blobs)

    return run


def _rows(shard: np.ndarray, kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(shard, pa.int32()), pa.array(np.full(len(shard), kind, np.int32)), pa.array(blobs, pa.binary())], names=["shard", "kind", "blob"])


def _unpack(blob: bytes):
    n, docs = np.frombuffer(blob, np.int64, 2)
    at = 16
    out = []
    for dtype, size in ((np.int64, docs), (np.int64, docs), (U, n), (np.int32, n), (np.int32, n), (np.uint8, n), (np.uint8, n)):
        out.append(np.frombuffer(blob, dtype, size, at))
        at += int(size) * np.dtype(dtype).itemsize
    return [*out, np.frombuffer(blob, np.uint8, offset=at).reshape(-1, 6)]


def _extend(window: int):
    """Reduce side, one shard: extend anchors that occur again, keep repeats."""

    def run(table: pa.Table) -> pa.Table:
        # the blocks stay where Arrow has them; only arrays over them are made
        kinds = table.column("kind").to_numpy()
        blobs = [v.as_buffer() for chunk in table.column("blob").chunks for v in chunk]
        out_id, out_rid, out = [], [], []
        for i in np.flatnonzero(kinds == 1):
            raw = blobs[i].to_pybytes()
            out_id.append(np.frombuffer(raw, np.int64, 1))
            out_rid.append(np.frombuffer(raw, np.int64, 1, 8))
            out.append(raw[16:])
        seeds = np.flatnonzero(kinds == 0)
        order = np.sort(np.concatenate([_unpack(blobs[i])[2] for i in seeds] or [np.zeros(0, U)]))
        again = np.unique(order[1:][order[1:] == order[:-1]])
        del order
        cols = [[] for _ in range(4)]
        for i in seeds if len(again) else []:
            ids, rids, h, start, local, offset, count, wins = _unpack(blobs[i])
            hit = again[np.minimum(np.searchsorted(again, h), len(again) - 1)] == h
            if not hit.any():
                continue
            end = np.cumsum(count.astype(np.int64))
            n = count[hit].astype(np.int64)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows = np.repeat((end - count)[hit], n) + step
            word = np.zeros((len(rows), 8), np.uint8)
            word[:, :6] = wins[rows]
            place = np.repeat(start[hit], n) + step
            shift = np.repeat(offset[hit], n) - step
            cols[0].append(tokens.mix(np.repeat(h[hit], n) + tokens.mix(word.view(U).ravel() * U(64) + shift.astype(U))))
            cols[1].append(place)
            cols[2].append(np.repeat(ids[local[hit]], n))
            cols[3].append(np.repeat(rids[local[hit]], n))
        if cols[0]:
            key, place, id_, rid = (np.concatenate(c) for c in cols[:4])
            by = np.lexsort((place, id_, key))
            key, place, id_, rid = key[by], place[by], id_[by], rid[by]
            new = np.r_[True, key[1:] != key[:-1]]
            head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            later = (id_ != id_[head]) | (place != place[head])
            if later.any():
                place, id_, rid = place[later], id_[later], rid[later]
                by = np.lexsort((rid, id_))
                id_, rid, place = id_[by], rid[by], place[by]
                doc = np.cumsum(np.r_[True, (id_[1:] != id_[:-1]) | (rid[1:] != rid[:-1])]) - 1
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                a, b, spans = _span_rows(id_[first], rid[first], doc, place, window)
                out_id.append(a)
                out_rid.append(b)
                out += spans
        cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table([pa.array(cat(out_id)), pa.array(cat(out_rid)), pa.array(out, pa.binary())], names=["id", "rid", "spans"])

    return run


def dealt(docs: DataFrame, id_col: str, text_col: str, window: int, anchor: int, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(shard, kind, blob): what the map side sends to the reducers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("rid"), F.col(text_col).alias("text"))
    hot = hot_anchors(rows.select("text"), window, anchor, hot_windows)
    return rows.mapInArrow(tokens.tidy(_seeds(window, anchor, shard_count(docs, SHARD_BYTES), hot)), "shard int, kind int, blob binary")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, anchor: int = 10, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(id, rid, spans): maximal word spans [start, end) of windows that also
    start earlier, one row per document with any; ``rid`` is the hash of id and
    text."""
    seeds = dealt(docs, id_col, text_col, window, anchor, hot_windows)
    found = seeds.groupBy("shard").applyInArrow(_extend(window), SPANS)
    return found.groupBy("id", "rid").agg(F.collect_list("spans").alias("parts")).mapInArrow(_unite, SPANS)


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of one document from several reducers as maximal ones."""
    for batch in batches:
        out = []
        for parts in batch.column(2):
            lo, hi = np.frombuffer(b"".join(parts.as_py()), np.int32).reshape(-1, 2).T
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            head = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
            out.append(np.stack([lo[head], hi[np.r_[head[1:] - 1, len(lo) - 1]]], 1).tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "rid", "spans"])


def _covered(s: tokens.Slice, lists: list) -> np.ndarray:
    """For every word of the slice, whether a span covers it."""
    edge = np.zeros(len(s.starts) + 1, np.int64)
    for i, spans in enumerate(lists):
        for raw in spans or ():
            span = np.frombuffer(raw, np.int32).reshape(-1, 2) + s.first[i]
            np.add.at(edge, span[:, 0], 1)
            np.add.at(edge, span[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, others: list[str]) -> DataFrame:
    """Documents joined with their spans: _id, _rid, _text, _spans, others."""
    by_doc = spans.select(F.col("id").alias("_sid"), F.col("rid").alias("_srid"), F.array("spans").alias("_spans"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("_rid"),
                       F.col(text_col).alias("_text"), *others)
    return rows.join(by_doc, (F.col("_id") == F.col("_sid")) & (F.col("_rid") == F.col("_srid")), "left").drop("_sid", "_srid")


def substring_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, anchor: int = 10) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per document."""

    def run(batches):
        for batch in batches:
            lists = batch.column(2).to_pylist()
            n_words, n_gone, sha = [], [], []
            for s in tokens.slices(batch.column(1)):
                gone = _covered(s, lists[s.row:s.row + s.n_texts])
                joined, starts, ends = tokens.join_words(s, ~gone)
                n = s.counts
                left = np.r_[0, np.cumsum(~gone)][s.first]
                for a, b in zip(left[:-1].tolist(), left[1:].tolist()):
                    sha.append(hashlib.sha256(joined[starts[a]:ends[b - 1]] if b > a else b"").hexdigest())
                n_words.append(n)
                n_gone.append(n - np.diff(left))
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column(0), pa.array(cat(n_words)), pa.array(cat(n_gone)), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = with_spans(docs, repeated_spans(docs, id_col, text_col, window, anchor), id_col, text_col, [F.col(id_col).cast("long").alias("_key")])
    return joined.select("_key", "_text", "_spans").mapInArrow(tokens.tidy(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, anchor: int = 10) -> DataFrame:
    """The documents with their repeated words cut out of the text. Other
    columns, and the white space between kept words, stay as they are; a text
    without repeats is returned byte for byte."""

    names = list(docs.columns)
    others = [c for c in names if c != text_col]  # the text itself travels once

    def run(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            texts = []
            for s in tokens.slices(batch.column(0)):
                gone = _covered(s, lists[s.row:s.row + s.n_texts])
                for i in range(s.n_texts):
                    lo, hi = s.first[i], s.first[i + 1]
                    text = s.data[s.offsets[i]:s.offsets[i + 1]]
                    if gone[lo:hi].any():
                        # each word owns the white space after it
                        cuts = np.r_[s.offsets[i], s.starts[lo:hi], s.offsets[i + 1]]
                        text = text[np.repeat(np.r_[True, ~gone[lo:hi]], np.diff(cuts))]
                    texts.append(text.tobytes())
            raw = pa.array(texts, pa.binary()).cast(pa.string())
            was_null = batch.column(0).is_null()
            new = pc.if_else(was_null, pa.scalar(None, pa.string()), raw)
            yield pa.record_batch([new if c == text_col else batch.column(2 + others.index(c)) for c in names], names=names)

    joined = with_spans(docs, repeated_spans(docs, id_col, text_col, window, anchor), id_col, text_col, [column(c).alias(f"_c{i}") for i, c in enumerate(others)])
    ordered = joined.select("_text", "_spans", *[f"_c{i}" for i in range(len(others))])
    return ordered.mapInArrow(tokens.tidy(run), docs.schema)
