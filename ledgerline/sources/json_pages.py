"""Entries of ONE large JSON page read by many tasks.

A snapshot page is a single document ``{"data": [{...}, {...}, ...]}``; read
as a whole (``multiLine``) it is one task and one row, however large. Here
Spark's text reader deals the file out by byte ranges, with ``}`` as the line
separator: every row is a stretch of text up to the next brace, wherever the
file is stored. What a brace means depends on all text before it, so there
are two passes over the ranges:

1. each range is summarised for both states it may start in (outside or
   inside a string): the state at its end, the change of nesting depth, and
   the last array opened at each depth with the key it belongs to. An escape
   can't reach over a range's start, which follows a brace. A range is a row
   of a few numbers; a fold over a file's ranges, in order, gives each range
   its state, depth and array;
2. with these each range cuts out the entries that lie in it. The entry that
   a range's end cuts apart leaves two fragments (or more, if it is longer than
   a range); fragments are put together by file, one entry at each border.

Quotes, escapes and brackets are found with numpy over a batch's bytes; an
entry's text is parsed by ``from_json`` in the JVM.

A document that ends inside a string or an open bracket, or closes more than
it opened, raises, as a malformed entry does. Entries that are not objects
(null, numbers, text) have no market id and are left out. A page without a
``data`` array has no entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRACE = b"}"
ENTRY_DEPTH = 3  # page object, data array, entry
KEY_BEFORE = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)
RANGE = "file string, start long"
SUMMARY = f"{RANGE}, size long, file_size long, ends array<int>, depths array<long>, lowest array<long>, opened array<map<long,string>>"
CUT = f"{RANGE}, at long, whole boolean, entry string"


def page_ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, file_size, value): the text of the pages by byte range,
    in order within a range; each value is followed by a brace."""
    text = spark.read.option("lineSep", BRACE.decode()).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"), "value")


class Scan:
    """Marks of a stretch of JSON: its brackets outside of strings and the
    nesting depth after each."""

    def __init__(self, data: np.ndarray, in_string: bool):
        slash = data == 0x5C
        quote = np.flatnonzero(data == 0x22)
        # a quote is escaped by an odd number of backslashes before it
        clear = np.flatnonzero(~slash)
        before = np.searchsorted(clear, quote) - 1
        run = quote - 1 - np.where(before >= 0, clear[np.maximum(before, 0)], -1)
        quote = quote[run % 2 == 0]
        marks = np.flatnonzero((data == 0x7B) | (data == 0x7D) | (data == 0x5B) | (data == 0x5D))
        inside = (np.searchsorted(quote, marks) + in_string) % 2 == 1
        self.at = marks[~inside]
        self.mark = data[self.at]
        self.step = np.where((self.mark == 0x7B) | (self.mark == 0x5B), 1, -1)
        self.depth = np.cumsum(self.step)
        self.in_string = (len(quote) + in_string) % 2 == 1


def key_before(data: bytes, at: int) -> str:
    """The key whose value starts at ``at``; '' without one."""
    found = KEY_BEFORE.search(data, max(0, data.rfind(b"}", 0, at) + 1), at)
    return found[1].decode() if found else ""


def _joined(values: pa.Array) -> bytes:
    """A batch's stretches with the brace that follows each."""
    return b"".join(piece for v in values.cast(pa.binary()).to_pylist() for piece in (v, BRACE))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of a batch by (file, start); rows of a range are neighbours."""
    files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    heads = [0] + [i for i in range(1, len(files)) if files[i] != files[i - 1] or starts[i] != starts[i - 1]] + [len(files)]
    for a, b in zip(heads[:-1], heads[1:]):
        if b > a:
            yield files[a], starts[a], batch.slice(a, b - a)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 1: one row for each range and batch, in order of ``at``."""
    now, out = None, []
    for batch in batches:
        for file, start, rows in _runs(batch):
            if now is None or (now["file"], now["start"]) != (file, start):
                out += [now] if now else []
                now = {"file": file, "start": start, "size": 0, "file_size": rows.column(2)[0].as_py(), "ends": [0, 1], "depths": [0, 0], "lowest": [0, 0], "opened": [{}, {}]}
            text = _joined(rows.column(3))
            data = np.frombuffer(text, np.uint8)
            now["size"] += len(data)
            scans = [Scan(data, False), Scan(data, True)]
            for state in (0, 1):
                scan = scans[now["ends"][state]]
                if len(scan.at):
                    # depths and arrays are counted from the range's start
                    now["lowest"][state] = min(now["lowest"][state], now["depths"][state] + int(scan.depth.min()))
                    arrays = np.flatnonzero(scan.mark == 0x5B)
                    depths = scan.depth[arrays]
                    for depth in np.unique(depths):
                        last = arrays[np.flatnonzero(depths == depth)[-1]]
                        now["opened"][state][now["depths"][state] + int(depth)] = key_before(text, int(scan.at[last]))
                    now["depths"][state] += int(scan.depth[-1])
                now["ends"][state] = int(scan.in_string)
    out += [now] if now else []
    yield pa.record_batch([pa.array([[list(o.items()) for o in r[f]] if f == "opened" else r[f] for r in out], t) for f, t in zip(
        ("file", "start", "size", "file_size", "ends", "depths", "lowest", "opened"),
        (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.map_(pa.int64(), pa.string()))))],
        names=["file", "start", "size", "file_size", "ends", "depths", "lowest", "opened"])


STATE = f"{RANGE}, in_string int, depth long, array string, offset long, size long"


def _states(ranges: pa.Table) -> pa.Table:
    """The fold over one file's ranges: how each of them starts, and where."""
    rows = sorted(ranges.to_pylist(), key=lambda r: r["start"])
    file, file_size, total = rows[0]["file"], rows[0]["file_size"], sum(r["size"] for r in rows)
    beyond = total - file_size  # 1 if no brace follows the last stretch in the file
    in_string, depth, array, offset, out = 0, 0, "", 0, []
    for r in rows:
        last = r is rows[-1]
        out.append((file, r["start"], in_string, depth, array, offset, r["size"] - (beyond if last else 0)))
        offset += r["size"]
        if depth + r["lowest"][in_string] < -(beyond if last else 0):
            raise ValueError(f"{file}: JSON closes more than it opens")
        array = dict(r["opened"][in_string]).get(ENTRY_DEPTH - 1 - depth, array)
        depth, in_string = depth + r["depths"][in_string], r["ends"][in_string]
    if in_string or depth + beyond:
        raise ValueError(f"{file}: JSON ends within a {'string' if in_string else 'bracket'}")
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=["file", "start", "in_string", "depth", "array", "offset", "size"])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)], names=["file", "start", "at", "whole", "entry"])


class _Range:
    """One byte range in pass 2."""

    def __init__(self, file: str, start: int, first: dict):
        self.key = (file, start)
        self.at, self.end = first["offset"], first["offset"] + first["size"]
        self.in_string, self.depth, self.array = bool(first["in_string"]), first["depth"], first["array"]
        # the entry that is open: begun here, or in an earlier range
        self.before = self.depth >= ENTRY_DEPTH and self.array == "data"
        self.open: list[bytes] | None = [] if self.before else None
        self.open_at = self.at

    def take(self, text: bytes) -> list[tuple]:
        text = text[:self.end - self.at]
        scan = Scan(np.frombuffer(text, np.uint8), self.in_string)
        depth = self.depth + scan.depth
        arrays = np.flatnonzero((depth == ENTRY_DEPTH - 1) & (scan.mark == 0x5B))
        keys = [self.array] + [key_before(text, int(scan.at[i])) for i in arrays]
        within = np.array([k == "data" for k in keys])[np.searchsorted(arrays, np.arange(len(depth)), "right")]
        begins = (scan.at[(scan.mark == 0x7B) & (depth == ENTRY_DEPTH) & within]).tolist()
        ends = (scan.at[(scan.mark == 0x7D) & (depth == ENTRY_DEPTH - 1) & within] + 1).tolist()
        out = []
        if self.open is not None:
            stop = ends.pop(0) if ends else None
            self.open.append(text[:stop])
            if stop is not None:
                out.append(self._closed())
        for a, b in zip(begins, ends):
            out.append((*self.key, self.at + a, True, text[a:b].decode()))
        if len(begins) > len(ends):
            self.open, self.open_at, self.before = [text[begins[-1]:]], self.at + begins[-1], False
        self.at += len(text)
        self.in_string, self.array = bool(scan.in_string), keys[-1]
        if len(depth):
            self.depth = int(depth[-1])
        return out

    def _closed(self) -> tuple:
        row = (*self.key, self.open_at, not self.before, b"".join(self.open).decode())
        self.open, self.before = None, False
        return row

    def finish(self) -> list[tuple]:
        """The fragment that the range's end leaves."""
        if self.open is None:
            return []
        self.before = True
        return [self._closed()]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 2: whole entries of each range, and the fragments at its borders."""
    now: _Range | None = None
    for batch in batches:
        out = []
        for file, start, rows in _runs(batch):
            if now is None or now.key != (file, start):
                out += now.finish() if now else []
                now = _Range(file, start, rows.slice(0, 1).to_pylist()[0])
            out += now.take(_joined(rows.column(3)))
        yield _rows(out)
    if now is not None:
        yield _rows(now.finish())


def _whole(fragments: pa.Table) -> pa.Table:
    """One file's fragments, in order, as whole entries: an entry ends where
    its braces are even."""
    rows = sorted(fragments.to_pylist(), key=lambda r: r["at"])
    out, held = [], None
    for r in rows:
        held = r if held is None else held | {"entry": held["entry"] + r["entry"]}
        scan = Scan(np.frombuffer(held["entry"].encode(), np.uint8), False)
        if not scan.in_string and len(scan.depth) and scan.depth[-1] == 0:
            out.append(held)
            held = None
    return pa.Table.from_batches([_rows([(r["file"], r["start"], r["at"], r["whole"], r["entry"]) for r in out])])


def page_entries(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """(file, at, fields of ``schema``): the objects of the pages' ``data``
    arrays; ``at`` is an entry's byte offset in its file."""
    from ..sinks.writers import published

    ranges = page_ranges(spark, path)
    states = ranges.mapInArrow(_summaries, SUMMARY).groupBy("file").applyInArrow(_states, STATE)
    # one row for each byte range of the scan, whatever its size
    states = published(spark, states, "page-ranges").select(F.col("file").alias("s_file"), F.col("start").alias("s_start"), "in_string", "depth", "array", "offset", "size")

    def cut(states: DataFrame) -> DataFrame:
        begun = ranges.join(F.broadcast(states), (F.col("file") == F.col("s_file")) & (F.col("start") == F.col("s_start"))).drop("s_file", "s_start")
        return begun.mapInArrow(_entries, CUT)

    entries = cut(states).where("whole")
    # only a border between ranges leaves fragments: pages of one range are read once
    dealt_out = states.join(states.where("s_start > 0").select("s_file").distinct(), "s_file", "left_semi")
    if not dealt_out.isEmpty():
        entries = entries.unionAll(cut(dealt_out).where("NOT whole").groupBy("file").applyInArrow(_whole, CUT))
    parsed = entries.select(
        F.element_at(F.split("file", "/"), -1).alias("file"), "at", F.from_json("entry", schema, {"mode": "FAILFAST"}).alias("entry"))
    return parsed.select("file", "at", "entry.*")
