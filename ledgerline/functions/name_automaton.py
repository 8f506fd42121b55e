"""Known person names in texts: Aho-Corasick over words, held in arrays.

The names of a dimension become word sequences (lower-case, without closing
punctuation); a text becomes the numbers of its words, with a gap wherever two
words are not separated by white space alone, so that no name reaches over the
end of a sentence. The automaton's transitions are one sorted array of
(state, word), its failure and output links are arrays; the texts of a batch
go through it side by side, a word at a time. Of the matches in a text the
leftmost are kept, the longest of those that start together, none overlapping.

The automaton travels to the tasks only if the names' text is within a bound
(``known_spans`` measures it). Beyond it the word sequences of the texts are
joined with the names instead, as Spark sees fit; both ways give the same
spans.
"""

from __future__ import annotations

import re
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|['’.-])*")
CLOSING = "'’.-"
GAP = -1
NAME_TEXT_LIMIT = 64 << 20  # characters of names that an automaton is built from


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text and where they stand; '' stands for a gap."""
    found, places, end, closed = [], [], None, False
    for m in WORD.finditer(text):
        word = m.group().rstrip(CLOSING)
        # a dot after one letter is an initial's and closes nothing
        if end is not None and (closed or text[end:m.start()].strip()):
            found.append("")
            places.append((m.start(), m.start()))
        found.append(word.lower())
        places.append((m.start(), m.start() + len(word)))
        end, closed = m.end(), len(m.group()) > len(word) and len(word) > 1
    return found, places


class NameAutomaton:
    def __init__(self, names: list[str]):
        sequences = {tuple(w) for w in (words(n)[0] for n in names) if w and "" not in w}
        self.number: dict[str, int] = {}
        edges: list[dict[int, int]] = [{}]
        depth, name_length = [0], [0]
        for sequence in sorted(sequences):
            state = 0
            for word in sequence:
                w = self.number.setdefault(word, len(self.number))
                if w not in edges[state]:
                    edges[state][w] = len(edges)
                    edges.append({})
                    depth.append(depth[state] + 1)
                    name_length.append(0)
                state = edges[state][w]
            name_length[state] = depth[state]
        n = len(edges)
        self.fail, self.shorter = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.name_length = np.array(name_length)
        todo = deque(edges[0].values())
        while todo:
            state = todo.popleft()
            for w, to in edges[state].items():
                back = self.fail[state]
                while back and w not in edges[back]:
                    back = self.fail[back]
                self.fail[to] = edges[back].get(w, 0)
                todo.append(to)
            # the next state that ends a name, along the failure links
            back = self.fail[state]
            self.shorter[state] = back if self.name_length[back] else self.shorter[back]
        self.width = len(self.number) + 1
        keys = np.array([s * self.width + w for s, e in enumerate(edges) for w in e], np.int64)
        targets = np.array([t for e in edges for t in e.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], targets[order]

    def _next(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(state), np.int64)
        live = np.flatnonzero(word >= 0)
        at = state[live]
        while len(live):
            key = at * self.width + word[live]
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[slot] == key
            out[live[hit]] = self.targets[slot[hit]]
            again = ~hit & (at > 0)
            live, at = live[again], self.fail[at[again]]
        return out

    def matches(self, texts: list[list[int]]) -> list[list[tuple[int, int]]]:
        """Word ranges [start, end) of all names in each text."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not len(self.keys):
            return out
        size = np.array([len(t) for t in texts])
        by = np.argsort(-size, kind="stable")
        flat = np.array([w for t in texts for w in t] or [GAP], np.int64)
        start = (np.cumsum(size) - size)[by]
        size = size[by]
        state = np.zeros(len(texts), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -step, "left"))
            state = self._next(state[:m], flat[start[:m] + step])
            ends = np.where(self.name_length[state] > 0, state, self.shorter[state])
            live = np.flatnonzero(ends)
            while len(live):
                for i, length in zip(by[live].tolist(), self.name_length[ends[live]].tolist()):
                    out[i].append((step + 1 - length, step + 1))
                ends[live] = self.shorter[ends[live]]
                live = live[ends[live] > 0]
        return out

    def spans(self, texts: list[str]) -> list[list[str]]:
        found = [words(t) for t in texts]
        numbered = [[self.number.get(w, GAP) if w else GAP for w in ws] for ws, _ in found]
        return [[text[places[a][0]:places[b - 1][1]] for a, b in leftmost_longest(ranges)]
                for text, (_, places), ranges in zip(texts, found, self.matches(numbered))]


def leftmost_longest(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    kept, end = [], 0
    for a, b in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if a >= end:
            kept.append((a, b))
            end = b
    return kept


def person_names(candidate_dim: DataFrame) -> DataFrame:
    """(name): how a candidate may be written: first and last name, with and
    without the middle name; single words are no names."""
    spellings = F.array(F.concat_ws(" ", "first_name", "last_name"), F.concat_ws(" ", "first_name", "middle_name", "last_name"))
    names = candidate_dim.select(F.explode(spellings).alias("name"))
    return names.where(F.col("name").rlike(r"\S\s+\S")).distinct()


def known_spans(df: DataFrame, texts_col: str, names: DataFrame, out_col: str, limit: int = NAME_TEXT_LIMIT) -> DataFrame:
    """``df`` with ``out_col``: for each text of the array ``texts_col`` the
    array of known names in it, as they are written there."""
    size = names.agg(F.coalesce(F.sum(F.length("name") + 1), F.lit(0))).first()[0]
    if size > limit:
        return _joined_spans(df, texts_col, names, out_col)
    automaton = NameAutomaton([r.name for r in names.collect()])  # at most ``limit`` characters

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def find(texts: pd.Series) -> pd.Series:
        flat = [t or "" for row in texts if row is not None for t in row]
        found = iter(automaton.spans(flat))
        return pd.Series([None if row is None else [next(found) for _ in row] for row in texts])

    return df.withColumn(out_col, find(texts_col))


def _joined_spans(df: DataFrame, texts_col: str, names: DataFrame, out_col: str) -> DataFrame:
    """The same by a join of word sequences, for any number of names."""
    sequence = F.udf(lambda n: None if not n or "" in (w := words(n)[0]) or not w else " ".join(w), T.StringType())
    known = names.select(sequence("name").alias("phrase")).where("phrase IS NOT NULL").distinct()
    longest = known.agg(F.max(F.size(F.split("phrase", " ")))).first()[0] or 0

    @F.pandas_udf("array<struct<a:int,b:int,lo:int,hi:int,phrase:string>>")
    def phrases(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            ws, places = words(text)
            row = []
            for a in range(len(ws)):
                for b in range(a + 1, min(a + longest, len(ws)) + 1):
                    if not ws[b - 1]:
                        break
                    row.append({"a": a, "b": b, "lo": places[a][0], "hi": places[b - 1][1], "phrase": " ".join(ws[a:b])})
            out.append(row)
        return pd.Series(out)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def chosen(texts: pd.Series, matches: pd.Series) -> pd.Series:
        out = []
        for text, row in zip(texts, matches):
            places = {(m["a"], m["b"]): text[m["lo"]:m["hi"]] for m in row}
            out.append([places[r] for r in leftmost_longest(list(places))])
        return pd.Series(out)

    texts = df.select(F.explode(texts_col).alias("text")).where("text IS NOT NULL").distinct()
    found = texts.select("text", F.explode(phrases("text")).alias("m")).join(known, F.col("m.phrase") == F.col("phrase"), "left_semi")
    # as many matches of a text as it has words, times the longest name
    spans = found.groupBy("text").agg(F.collect_list("m").alias("ms")).select("text", chosen("text", "ms").alias("spans"))
    keyed = df.withColumn("_row", F.monotonically_increasing_id())
    from ..sinks.writers import published

    keyed = published(df.sparkSession, keyed, "name-texts")  # row numbers must not change between uses
    placed = keyed.select("_row", F.posexplode_outer(texts_col).alias("_at", "text")).join(spans, "text", "left")
    none = F.array().cast("array<string>")
    gathered = placed.where("_at IS NOT NULL").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", F.coalesce("spans", none).alias("spans")))).alias("all"))
    back = keyed.join(gathered, "_row", "left")
    found = F.coalesce(F.transform("all", lambda x: x["spans"]), F.array().cast("array<array<string>>"))
    return back.withColumn(out_col, F.when(F.col(texts_col).isNotNull(), found)).drop("_row", "all")
