"""Conversation structure repair by a grammar-compressed DP (operator 13).

A row of a conversation becomes one of nine symbols: the initial of its role
(s, u, a, other) as it is, the same with a truncated text, or a row that has
to go (blank, or a copy of an earlier row). The role initials that a repaired
conversation may have, ``(s?(ua)+)?``, are an automaton of four states. A
symbol's transfer matrix holds, for each pair of states, the least cost of
the edits that lead through the symbol from one to the other, and which audit
string of a row of the matrix comes first. Matrices are joined by the min-plus
product; the join of two keeps the state between them, so an audit is a rope
over the two parts' ropes and is spelled out only where it is asked for.

Symbol sequences are compressed by Re-Pair: the most frequent neighbours
become a rule, over all conversations of a batch, until no pair comes twice;
what is left of a sequence is paired up in a balanced way. Each rule's matrix
is computed once, bottom-up, and shared by all conversations that hold it.

Inserts stand before the row that follows them, or at the end of the
conversation. Then two audits through the same rows are never the beginning
of each other, and the automaton's next state follows from the letter, so the
ASCII-least of equal costs is found by comparing left parts first, by rank.

Rows are sorted over all tasks by (conversation, turn, role, SHA-256 of the
text); a long conversation runs through many tasks as pieces of at most
``PIECE`` rows. Each piece leaves one matrix; the few numbers of a
conversation's pieces are joined in order, and the edits of each piece are
then known. Copies of earlier rows are found by an aggregate over
(conversation, role, text) that combines map-side, and a join on the row's
whole key. The repaired text itself passes, sorted, through one task per
conversation as a stream: SHA-256 takes its input in order. That task holds
one letter per row (the audit it returns), never the texts.

Defined results: nulls count as one space (in the checksum, as role and as
text); a null conversation is a conversation; null turns come first. Rows of
one turn are taken by role, then by the SHA-256 of their text; equal rows stay
rows, all but the first of them duplicates. ``gaps`` is null if the turns
span more than a long. A conversation without rows has zeros, an empty audit
and the hash of the empty string; an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import shard_count, written
from .tokens import tidy

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
GONE = 8  # symbol of a row that has to be deleted
STATES = 4  # nothing yet, after the system's row, after a user's, after an assistant's
SPEAKS = (2, 2, 3, 2)  # the state after the next user or assistant row
ROLE_OF = {2: "user", 3: "assistant"}
TAIL = ((0, ""), (6, "II"), (3, "I"), (0, ""))  # from each state to an accepted end
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au
NEVER = 1 << 50
PIECE = 1 << 16  # rows of a conversation in one piece
BATCH = 1 << 18  # rows whose sequences share a grammar
SPACE = " \t\n\x0b\x0c\r"


def _next_by_keep(role: int, state: int) -> int | None:
    return {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}}.get(role, {}).get(state)


def _row_edits(symbol: int, state: int) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, letters) through one row, by the state it leads to."""
    best: dict[int, tuple[int, str]] = {}
    before, letters = 0, ""
    for _ in range(3):  # two inserts reach every state; more only cost
        options = [(state, DELETE, "D")]
        if symbol != GONE:
            extra = TRUNCATED * (symbol >= 4)
            options.append((SPEAKS[state], REROLE + extra, "R"))
            kept = _next_by_keep(symbol % 4, state)
            if kept is not None:
                options.append((kept, KEEP + extra, "K"))
        for to, cost, letter in options:
            best[to] = min(best.get(to, (NEVER, "")), (before + cost, letters + letter))
        before, letters, state = before + INSERT, letters + "I", SPEAKS[state]
    return best


def _terminals() -> tuple[np.ndarray, np.ndarray, dict[tuple[int, int, int], str]]:
    cost = np.full((GONE + 1, STATES, STATES), NEVER, np.int64)
    rank = np.full((GONE + 1, STATES, STATES), STATES, np.int64)
    spelled = {}
    for symbol in range(GONE + 1):
        for state in range(STATES):
            edits = _row_edits(symbol, state)
            for place, to in enumerate(sorted(edits, key=lambda t: edits[t][1])):
                cost[symbol, state, to], spelled[symbol, state, to] = edits[to]
                rank[symbol, state, to] = place
    return cost, rank, spelled


T_COST, T_RANK, T_SPELLED = _terminals()


def joined(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Min-plus product of arrays of matrices: costs, ranks and the states
    between the two parts. Of equal costs the left part's rank decides; it
    differs wherever the states between do."""
    (lc, lr), (rc, rr) = left, right
    total = np.minimum(lc[:, :, :, None] + rc[:, None, :, :], NEVER)
    mid = np.argmin(total * 8 + lr[:, :, :, None], axis=2)
    cost = np.take_along_axis(total, mid[:, :, None, :], 2)[:, :, 0, :]
    order = np.take_along_axis(lr, mid, 2) * 8 + rr[np.arange(len(rr))[:, None, None], mid, np.arange(STATES)[None, None, :]]
    order = np.where(cost >= NEVER, 1 << 20, order)
    return cost, np.argsort(np.argsort(order, axis=2, kind="stable"), axis=2), mid


class Grammar:
    """Re-Pair rules over symbol sequences, with one matrix for each rule."""

    def __init__(self, sequences: list[bytes]):
        self.cost, self.rank = T_COST, T_RANK
        self.mid = np.zeros((GONE + 1, STATES, STATES), np.int64)
        self.left, self.right = np.zeros(GONE + 1, np.int64), np.zeros(GONE + 1, np.int64)
        self.known: dict[tuple[int, int, int], str] = dict(T_SPELLED)
        self.symbols = np.frombuffer(b"".join(sequences), np.uint8).astype(np.int64)
        self.owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        while self._frequent_pairs():
            pass
        while self._balanced_pairs():
            pass
        self.roots = self.symbols  # one symbol for each sequence

    def _add(self, pairs: np.ndarray) -> np.ndarray:
        """New symbols for rows (left, right); all matrices in one product."""
        left, right = pairs[:, 0], pairs[:, 1]
        cost, rank, mid = joined((self.cost[left], self.rank[left]), (self.cost[right], self.rank[right]))
        first = len(self.cost)
        self.cost, self.rank, self.mid = (np.concatenate(x) for x in ((self.cost, cost), (self.rank, rank), (self.mid, mid)))
        self.left, self.right = np.r_[self.left, left], np.r_[self.right, right]
        return first + np.arange(len(pairs))

    def _replace(self, at: np.ndarray, new: np.ndarray) -> None:
        self.symbols[at] = new
        stay = np.ones(len(self.symbols), bool)
        stay[at + 1] = False
        self.symbols, self.owner = self.symbols[stay], self.owner[stay]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.owner[1:] == self.owner[:-1])
        return at, self.symbols[at] * len(self.cost) + self.symbols[at + 1]

    def _frequent_pairs(self) -> bool:
        """Replaces the most frequent pairs, as many as share no symbol."""
        at, key = self._pairs()
        found, count = np.unique(key, return_counts=True)
        used, chosen = set(), []
        for k in np.lexsort((found, -count)):
            if count[k] < 2:
                break
            pair = divmod(int(found[k]), len(self.cost))
            if used.isdisjoint(pair):
                used.update(pair)
                chosen.append(int(found[k]))
        if not chosen:
            return False
        chosen = np.sort(np.array(chosen))
        slot = np.minimum(np.searchsorted(chosen, key), len(chosen) - 1)
        hit = chosen[slot] == key
        at, slot = at[hit], slot[hit]
        # in a run of one symbol every second pair is free
        fresh = np.r_[True, (at[1:] != at[:-1] + 1) | (slot[1:] != slot[:-1])][:len(at)]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        free = (np.arange(len(at)) - start) % 2 == 0
        at, slot = at[free], slot[free]
        self._replace(at, self._add(np.stack(np.divmod(chosen, len(self.cost)), 1))[slot])
        return True

    def _balanced_pairs(self) -> bool:
        at, key = self._pairs()
        if not len(at):
            return False
        start = np.searchsorted(self.owner, self.owner[at])
        even = (at - start) % 2 == 0
        at, (found, slot) = at[even], np.unique(key[even], return_inverse=True)
        self._replace(at, self._add(np.stack(np.divmod(found, len(self.cost)), 1))[slot])
        return True

    def audit(self, symbol: int, start: int, end: int) -> str | None:
        """The rope of a matrix entry, spelled out; shared parts once."""
        if self.cost[symbol, start, end] >= NEVER:
            return None
        todo = [(int(symbol), start, end)]
        while todo:
            entry = todo[-1]
            if entry in self.known:
                todo.pop()
                continue
            s, i, j = entry
            m = int(self.mid[s, i, j])
            parts = (int(self.left[s]), i, m), (int(self.right[s]), m, j)
            missing = [p for p in parts if p not in self.known]
            if missing:
                todo += missing
            else:
                self.known[entry] = self.known[parts[0]] + self.known[parts[1]]
        return self.known[int(symbol), start, end]


PIECE_FIELDS = "piece long, p_turn {turn}, p_role string, p_hash binary, costs array<long>, ranks array<long>, audits array<string>, head int, last int, illegal long, blank long, duplicate long, truncated long"


class _Piece:
    def __init__(self, conv, number: int, key: tuple, whole: bool):
        self.conv, self.number, self.key, self.whole = conv, number, key, whole
        self.codes, self.classes, self.size = [], [], 0
        self.blank = self.duplicate = self.truncated = 0


def _pieces(schema: pa.Schema):
    """Sorted rows (conv, turn, role, hash, cls, blank, fresh, cut, n) to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: _Piece | None = None
        done: list[_Piece] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, turns, roles, hashes = (batch.column(i).to_pylist() for i in range(4))
            cls, n = (batch.column(i).to_numpy().astype(np.int64) for i in (4, 8))
            blank, fresh, cut = (batch.column(i).to_numpy(zero_copy_only=False) for i in (5, 6, 7))
            symbol = np.where(blank | ~fresh, GONE, cls + 4 * cut)
            heads = [0] + [i for i in range(1, len(convs)) if convs[i] != convs[i - 1]] + [len(convs)]
            for a, b in zip(heads[:-1], heads[1:]):
                same = open_ is not None and open_.conv == convs[a]
                row = a
                while row < b:
                    if open_ is None or not same or open_.size >= PIECE:
                        if open_ is not None:
                            done.append(open_)
                            held += open_.size
                        # the first piece of a task and later pieces of a conversation may start in any state
                        open_ = _Piece(convs[a], number, (turns[row], roles[row], hashes[row]), not same and number & 0xFFFFFFFF > 0)
                        number, same = number + 1, True
                    room = PIECE - open_.size
                    rows = int(np.searchsorted(np.cumsum(n[row:b]), room, "right"))
                    if rows:
                        part = slice(row, row + rows)
                        first = np.cumsum(n[part]) - n[part]
                        codes = np.full(int(n[part].sum()), GONE, np.uint8)
                        codes[first] = symbol[part]
                        _take(open_, codes, np.repeat(cls[part], n[part]).astype(np.uint8), blank[part], fresh[part], cut[part], n[part])
                        row += rows
                    else:  # more equal rows than the piece has room for
                        codes = np.full(room, GONE, np.uint8)
                        codes[0] = symbol[row]
                        one = slice(row, row + 1)
                        _take(open_, codes, np.full(room, cls[row], np.uint8), blank[one], fresh[one], cut[one], np.array([room]))
                        n[row] -= room
                        fresh, symbol = fresh.copy(), symbol.copy()
                        fresh[row], symbol[row] = False, GONE
            if held >= BATCH:
                yield _piece_rows(done, schema)
                done, held = [], 0
        if open_ is not None:
            done.append(open_)
        if done:
            yield _piece_rows(done, schema)

    return run


def _take(piece: _Piece, codes, classes, blank, fresh, cut, n) -> None:
    piece.codes.append(codes.tobytes())
    piece.classes.append(classes)
    piece.size += len(codes)
    piece.blank += int(n[blank].sum())
    piece.duplicate += int((n - fresh)[~blank].sum())
    piece.truncated += int((~blank & fresh & cut).sum())


def _piece_rows(pieces: list[_Piece], schema: pa.Schema) -> pa.RecordBatch:
    sequences = [b"".join(p.codes) for p in pieces]
    numbers: dict[bytes, int] = {}
    which = [numbers.setdefault(s, len(numbers)) for s in sequences]
    grammar = Grammar(list(numbers))
    rows = []
    for p, k in zip(pieces, which):
        root = int(grammar.roots[k])
        classes = np.concatenate(p.classes)
        starts = (0,) if p.whole else range(STATES)
        rows.append((p.conv, p.number, *p.key, grammar.cost[root].ravel().tolist(), grammar.rank[root].ravel().tolist(),
                     [grammar.audit(root, i, j) if i in starts else None for i in range(STATES) for j in range(STATES)],
                     int(classes[0]), int(classes[-1]), int((~LEGAL[classes[:-1], classes[1:]]).sum()), p.blank, p.duplicate, p.truncated))
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def cheapest(pieces: list[dict]) -> tuple[int, list[tuple[int, int]]]:
    """Least cost of a conversation, and the states (before, after) of each
    of its pieces on the path whose audit comes first."""
    cost = [np.array(p["costs"], np.int64).reshape(STATES, STATES) for p in pieces]
    rank = [np.array(p["ranks"], np.int64).reshape(STATES, STATES) for p in pieces]
    left = [np.array([t[0] for t in TAIL], np.int64)]  # cost from each state to the end
    for c in reversed(cost):
        left.append(np.minimum((c + left[-1][None, :]).min(axis=1), NEVER))
    left.reverse()
    state, path = 0, []
    for k, (c, r) in enumerate(zip(cost, rank)):
        best = np.flatnonzero(c[state] + left[k + 1] == left[k][state])
        end = int(best[np.argmin(r[state][best])])
        path.append((state, end))
        state = end
    return int(left[0][0]), path


def _paths(schema: pa.Schema):
    """(conv, pieces) to (conv, cost, illegal, path of (piece, entry, tail))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cost, path = cheapest(pieces)
                seams = sum(not LEGAL[a["last"], b["head"]] for a, b in zip(pieces[:-1], pieces[1:]))
                chosen = [{"piece": p["piece"], "entry": STATES * i + j, "tail": ""} for p, (i, j) in zip(pieces, path)]
                chosen[-1]["tail"] = TAIL[path[-1][1]][1]
                rows.append((conv, cost, seams, chosen))
            if rows:
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


class _Stream:
    """One conversation's repair, row by row."""

    def __init__(self, conv, counts: list[int]):
        self.conv, self.counts = conv, counts
        self.hash, self.state, self.audits, self.used, self.started = hashlib.sha256(), 0, [], 0, False
        self.rest, self.at = "", 0

    def edits(self, audit: str) -> None:
        self.audits.append(audit)
        self.rest, self.at = self.rest[self.at:] + audit, 0

    def letter(self) -> str:
        self.at += 1
        return self.rest[self.at - 1]

    def write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.started else "") + role + ":" + text).encode())
        self.started = True

    def speak(self, text: str) -> None:
        self.state = SPEAKS[self.state]
        self.write(ROLE_OF[self.state], text)

    def row(self, role: str, text: str) -> None:
        while (letter := self.letter()) == "I":
            self.speak("")
        if letter == "R":
            self.speak(text)
        elif letter == "K":
            self.state = _next_by_keep("sua".index(role[0]), self.state)
            self.write(role, text)

    def end(self) -> tuple:
        while self.at < len(self.rest) and self.letter() == "I":
            self.speak("")
        return (self.conv, *self.counts, "".join(self.audits), self.hash.hexdigest())


OUT_FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(schema: pa.Schema):
    """Sorted (conv, kind, role, n, body, counts) to one result a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Stream | None = None
        done, size = [], 0
        for batch in batches:
            for conv, kind, role, n, body, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if now is not None:
                        done.append(now.end())
                        size += 200 + len(done[-1][-2])
                    now = _Stream(conv, counts)
                elif kind == 1:
                    now.edits(body)
                else:
                    for _ in range(n):
                        now.row(role, body)
                if size > 1 << 20:
                    yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*done), schema.types)], schema=schema)
                    done, size = [], 0
        if now is not None:
            done.append(now.end())
        if done:
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*done), schema.types)], schema=schema)

    return run


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def damaged(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The rows after damage: (conv, turn, role, text, n), n equal rows each."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    chance = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank("turn"))) % 20
    role, text = blank("role"), blank("text")
    return conversations.where(chance != 0).select(
        F.col(conv_col).alias("conv"), F.col("turn").alias("turn"), F.when(chance == 4, "user").otherwise(role).alias("role"),
        F.when(chance == 1, "").when(chance == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(chance == 3, 2).otherwise(1).cast("long").alias("n"))


def repaired(conversations: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation in ``conversations``, whose rows
    (conv, turn, role, text, n) are to be repaired."""
    spark = rows.sparkSession
    conv_type, turn_type = rows.schema["conv"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    trimmed = F.rtrim("text", F.lit(SPACE))
    keyed = rows.withColumn("hash", F.unhex(F.sha2("text", 256)))
    # one row for each distinct row, without its text
    distinct = keyed.groupBy("conv", "turn", "role", "hash").agg(
        F.sum("n").alias("n"), F.max(trimmed == "").alias("blank"), F.max(~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"))
    distinct = written(distinct, "conversation-rows")
    earliest = distinct.groupBy("conv", "role", "hash").agg(F.min(F.struct("turn")).alias("first"))
    earliest = earliest.select(F.col("conv").alias("e_conv"), F.col("role").alias("e_role"), F.col("hash").alias("e_hash"), F.col("first.turn").alias("e_turn"))
    same = (F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("role") == F.col("e_role")) & (F.col("hash") == F.col("e_hash")) & F.col("turn").eqNullSafe(F.col("e_turn")))
    initial = F.substring("role", 1, 1)
    cls = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = distinct.join(earliest, same, "left").select(
        "conv", "turn", "role", "hash", cls.alias("cls"), "blank", F.col("e_hash").isNotNull().alias("fresh"), "cut", "n")
    order = ["conv", "turn", "role", "hash"]
    ranged = marked.repartitionByRange(shard_count(conversations, 16 << 20), *order).sortWithinPartitions(*order)
    piece_ddl = f"conv {conv_type}, " + PIECE_FIELDS.format(turn=turn_type)
    pieces = written(ranged.mapInArrow(tidy(_pieces(_arrow(spark, piece_ddl))), piece_ddl), "conversation-pieces")

    # a few numbers a piece; the pieces of a conversation in order
    per_conv = pieces.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("piece", "costs", "ranks", "head", "last"))).alias("pieces"))
    path_ddl = f"conv {conv_type}, cost long, seams long, path array<struct<piece:long,entry:int,tail:string>>"
    paths = written(per_conv.mapInArrow(_paths(_arrow(spark, path_ddl)), path_ddl), "conversation-paths")
    steps = paths.select(F.col("conv").alias("s_conv"), F.explode("path").alias("step"))
    headers = pieces.join(steps, (F.col("piece") == F.col("step.piece")) & F.col("conv").eqNullSafe(F.col("s_conv"))).select(
        "conv", F.col("p_turn").alias("turn"), F.col("p_role").alias("role"), F.col("p_hash").alias("hash"), "piece",
        F.concat(F.element_at("audits", F.col("step.entry") + 1), F.col("step.tail")).alias("body"))

    def sums(df: DataFrame, prefix: str, *aggregates) -> DataFrame:
        return df.groupBy(F.col("conv").alias(prefix)).agg(*aggregates)

    wide = lambda c: c.cast("decimal(38,0)")
    faults = sums(pieces, "f_conv", *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    turns = sums(distinct.where("turn IS NOT NULL").select("conv", "turn").distinct(), "t_conv",
                 (wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count(F.lit(1))).try_cast("long").alias("gaps"), F.lit(True).alias("turned"))
    costs = paths.select(F.col("conv").alias("c_conv"), "cost", "seams")
    base = conversations.select(F.col(conv_col).alias("conv")).distinct()
    for side, key in ((faults, "f_conv"), (turns, "t_conv"), (costs, "c_conv")):
        base = base.join(side, F.col("conv").eqNullSafe(F.col(key)), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    counts = F.array(F.when(F.col("turned"), F.col("gaps")).otherwise(F.lit(0).cast("long")), *[zero(F.col(c)) for c in ("blank", "duplicate", "truncated")],
                     zero(F.col("illegal") + F.col("seams")), zero(F.col("cost")))

    def records(df: DataFrame, kind: int, **given) -> DataFrame:
        empty = {"turn": turn_type, "role": "string", "hash": "binary", "piece": "long", "n": "long", "body": "string", "counts": "array<long>"}
        return df.select("conv", F.lit(kind).alias("kind"), *[given.get(c, F.lit(None).cast(t)).alias(c) for c, t in empty.items()])

    at = {c: F.col(c) for c in ("turn", "role", "hash")}
    every = records(base, 0, counts=counts)
    every = every.unionAll(records(headers, 1, **at, piece=F.col("piece"), body=F.col("body")))
    every = every.unionAll(records(keyed, 2, **at, n=F.col("n"), body=F.col("text")))
    # each conversation's summary, then each piece's edits before its rows
    dealt = every.repartition(shard_count(conversations, 16 << 20), "conv").sortWithinPartitions(
        "conv", F.col("kind") > 0, "turn", "role", "hash", "kind", "piece")
    out_ddl = f"{conv_col} {conv_type}, " + OUT_FIELDS
    return dealt.select("conv", "kind", "role", "n", "body", "counts").mapInArrow(tidy(_stream(_arrow(spark, out_ddl))), out_ddl)


def repair_damaged(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The damaged conversations, repaired."""
    return repaired(conversations, damaged(conversations, conv_col), conv_col)
