import math
import re
import sys
import zlib
from collections import Counter
from os.path import dirname

import numpy as np

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import elias_fano, ngram_trie, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


class Brute:
    """The same model with dictionaries and exact probabilities."""

    def __init__(self, texts, discount=0.75, least=2):
        self.d = discount
        self.one, self.two, self.three, self.context = Counter(), Counter(), Counter(), Counter()
        for text in texts:
            w = ["<s>", *words(text), "</s>"]
            self.one.update(w[1:])
            self.context.update(w[:-1])
            self.two.update(zip(w, w[1:]))
            self.three.update(zip(w, w[1:], w[2:]))
        self.all_two = dict(self.two)
        self.two = {k: n for k, n in self.two.items() if n >= least}
        self.three = {k: n for k, n in self.three.items() if n >= least}
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.rest2, self.rest3 = Counter(), Counter()
        for (u, _), n in self.two.items():
            self.rest2[u] += (n - discount) / self.context[u]
        for (u, v, _), n in self.three.items():
            self.rest3[u, v] += (n - discount) / self.all_two[u, v]

    def p(self, u, v, w):
        p = (self.one[w] + 0.5) / (self.n + 0.5 * (self.v + 1))
        p = max(self.two.get((v, w), 0) - self.d, 0) / max(self.context[v], 1) + (1 - self.rest2[v]) * p
        if u is not None and (u, v) in self.two:
            p = max(self.three.get((u, v, w), 0) - self.d, 0) / self.all_two[u, v] + (1 - self.rest3[u, v]) * p
        return p

    def score(self, text):
        w = ["<s>", *words(text), "</s>"]
        return sum(math.log10(self.p(w[i - 2] if i > 1 else None, w[i - 1], w[i])) for i in range(1, len(w)))

    def base(self, text):
        return sum(math.log10((self.one[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in [*words(text), "</s>"])


def test_scores_match_a_dictionary_model(spark):
    rows = llm_cases.documents() + [(i + 1000 if i is not None else None, *rest) for i, *rest in llm_cases.odd_documents()]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(5))
    teach = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    brute = Brute([r[1] for r in rows if teach(r[0])])
    meta = ngram_trie.train(df, queries.remainder("doc_id", 5) != 1, shards=5)
    assert (meta.total, meta.n_words) == (brute.n, brute.v)
    want = sorted([(str(r[0]), len(words(r[1])) + 1, sum(brute.one[w] > 0 for w in [*words(r[1]), "</s>"]), round(brute.base(r[1]), 6), brute.score(r[1])) for r in rows])
    got = sorted([(str(r.id), r.n_tokens, r.n_known, round(r.base_score, 6), r.score) for r in ngram_trie.score(df, meta).collect()])
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert max(abs(g[4] - w[4]) / max(1, g[1]) for g, w in zip(got, want)) < 0.02  # one byte per probability


def test_probabilities_sum_to_one():
    brute = Brute([r[1] for r in llm_cases.documents()[:20]])
    for u, v in list(brute.two)[:8]:
        known = sum(brute.p(u, v, w) for w in brute.one)
        assert abs(known + (1 - brute.rest3[u, v]) * (1 - brute.rest2[v]) * 0.5 / (brute.n + 0.5 * (brute.v + 1)) - 1) < 1e-9


def test_held_out_texts_are_likelier_than_by_unigrams(spark):
    rows = [r for r in queries.op2_ngram_trie(spark, SF).collect() if r.held_out]
    assert len(rows) > 100 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_without_training_texts(spark):
    df = spark.createDataFrame(llm_cases.odd_documents()[4:8], llm_cases.DOCS)
    for docs in (df, df.limit(0)):
        meta = ngram_trie.train(docs, F.lit(False), shards=3)
        assert {(r.n_known, r.score) for r in ngram_trie.score(df, meta).collect()} == {(0, 0.0)}


def test_elias_fano_against_numpy():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (70, 100), (5000, 6000), (5000, 10**9), (3000, 2**60)):
        x = np.unique(rng.integers(0, top, n))
        if n == 5000:
            x = np.unique(np.r_[x, np.arange(2000, 3000)])  # a dense run
        e = elias_fano.EliasFano(elias_fano.encode(x))
        if len(x):
            assert (e.access(np.arange(len(x))) == x).all()
        probe = np.r_[x, x + 1, rng.integers(0, top + 5, 200)]
        lo = rng.integers(0, len(x) + 1, len(probe))
        hi = np.minimum(len(x), lo + rng.integers(0, len(x) + 1, len(probe)))
        at = np.searchsorted(x, probe)
        hit = (at < len(x)) & (x[np.minimum(at, max(len(x) - 1, 0))] == probe if len(x) else np.zeros(len(probe), bool)) & (at >= lo) & (at < hi)
        assert (e.find(probe, lo, hi) == np.where(hit, at, -1)).all()
    weak = np.sort(rng.integers(0, 50, 400))
    assert (elias_fano.EliasFano(elias_fano.encode(weak)).access(np.arange(400)) == weak).all()


class Counted:
    """An array that counts its look-ups."""

    def __init__(self, array):
        self.array, self.calls = array, 0

    def __getitem__(self, at):
        self.calls += 1
        return self.array[at]


def test_select_in_a_long_run_takes_few_steps():
    run = np.r_[np.arange(40_000), np.arange(1, 2001) * 10**6]  # a dense range, then few numbers far apart
    e = elias_fano.EliasFano(elias_fano.encode(run))
    for ones, total in ((True, e.n), (False, run[-1] >> e.bits)):
        k = np.arange(0, total, 7)
        places = np.flatnonzero(np.unpackbits(e.upper.view(np.uint8), bitorder="little") == ones)
        e.rank = Counted(e.rank)
        assert (e._select(k, ones) == places[k]).all()
        assert e.rank.calls < 20  # word by word: one look-up for each of 600
        e.rank = e.rank.array


def test_neighbours_of_a_sequence():
    rng = np.random.default_rng(6)
    for n, top in ((2, 3), (300, 400), (3000, 10**9)):
        x = np.sort(rng.integers(0, top, n))
        e, i = elias_fano.EliasFano(elias_fano.encode(x)), np.arange(n - 1)
        a, b = e.access_two(i)
        assert (a == x[:-1]).all() and (b == x[1:]).all()


def test_ranges_are_searched_as_dictionaries():
    rng = np.random.default_rng(8)
    group = np.sort(rng.choice([0, 1, 1, 1, 2, 5, 6, 6, 9], 400))
    x = rng.integers(0, 500, 400)
    group, x = np.unique(np.c_[group, x], axis=0).T
    for groups in (10, 12):
        pointers, members = (elias_fano.EliasFano(a) for a in ngram_trie.ranges(group, x, groups))
        row, value = np.repeat(np.arange(groups), 500), np.tile(np.arange(500), groups)
        got, begin = ngram_trie.find_in_ranges(pointers, members, np.arange(groups), row, value)
        known = {(g, v): i for i, (g, v) in enumerate(zip(group.tolist(), x.tolist()))}
        assert got.tolist() == [known.get(k, -1) for k in zip(row.tolist(), value.tolist())]
        assert (begin == np.searchsorted(group, row)).all()


def test_files_are_read_as_plain_arrays(tmp_path):
    ngram_trie.save(tmp_path.as_uri(), "x", {"a": np.arange(5)})
    a = ngram_trie.load(tmp_path.as_uri(), "x")["a"]
    assert type(a) is np.ndarray and a.tolist() == [0, 1, 2, 3, 4]  # a memmap builds an object at each look-up


def test_blocks_round_trip():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    counts = np.arange(1, 1001)
    a, b = ngram_trie.unpack(ngram_trie.pack(keys, counts))
    assert (a == keys).all() and (b == counts).all()
    k, c = ngram_trie.merge([(keys, counts), (keys[::2], counts[::2])])
    assert (k == keys).all() and c.sum() == counts.sum() + counts[::2].sum()
