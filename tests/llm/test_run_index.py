import hashlib
import random
import sys
from os.path import dirname

import numpy as np

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import run_index

order = lambda i: (i is None, i or 0)


def brute(rows, window):
    first = {}
    for i, text, *_ in rows:
        b = (text or "").encode()
        for s in range(len(b) - window + 1):
            k, at = b[s:s + window], (order(i), s)
            if k not in first or at < first[k]:
                first[k] = at
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if first[b[s:s + window]] < (order(i), s):
                gone[s:s + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not p for g, p in zip(gone, [False] + gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_digest_matches_brute_force(spark, monkeypatch):
    odd = [(i, t if t is None else t[:60000], *r) for i, t, *r in llm_cases.odd_documents()]
    rows = llm_cases.documents() + [(i + 1000 if i is not None else None, *rest) for i, *rest in odd]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(6))
    want = brute(rows, 100)
    assert sum(r[2] for r in want) > 1000
    assert collected(run_index.repeat_digest(df)) == want


def test_slices_blocks_and_hot_anchors(spark, monkeypatch):
    """Small slices, blocks of long texts, and anchors and contexts above the
    bound give the same result."""
    rng = random.Random(8)
    common = "a phrase that is much longer than an anchor and stands in every second document; " + "x" * 12
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit".split()
    fill = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    rows = [(i, fill(20) + common + fill(rng.choice([0, 3, 12])), "en", "s", 0) for i in range(150)]
    rows += [(i, rows[i % 7][1] + rows[i % 5][1], "en", "s", 0) for i in range(150, 170)] + [(170, rows[3][1], "en", "s", 0)] * 3 + [(171, "ab" * 400, "en", "s", 0)]
    df = spark.createDataFrame(rows, llm_cases.DOCS).repartition(4)
    want = brute(rows, 100)
    monkeypatch.setattr(run_index, "REPORT", 1)
    for slice_, block, bound in ((700, 400, 10), (1 << 20, 300, 3), (5000, 1 << 20, 1 << 14)):
        monkeypatch.setattr(run_index, "SLICE", slice_)
        monkeypatch.setattr(run_index, "BLOCK", block)
        assert collected(run_index.repeat_digest(df, bound=bound)) == want


def test_matching_statistics_against_all_suffixes():
    """The run index finds the longest match, up to the window, of every
    suffix; windows lead to the least piece that has them."""
    rng = np.random.default_rng(1)
    for trial in range(30):
        size = rng.integers(1, 40, 25)
        text = rng.integers(97, 97 + 1 + trial % 3, int(size.sum())).astype(np.uint8)
        cuts = np.r_[0, np.cumsum(size)]
        pieces = [text[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        for window in (3, 9, 12, 20):
            index = run_index.RunIndex(text, size, window)
            q_size = rng.integers(1, 50, 10)
            query = rng.integers(97, 100, int(q_size.sum())).astype(np.uint8)
            query[:min(len(query), 30)] = text[:min(len(query), 30)]
            q_cuts = np.r_[0, np.cumsum(q_size)]
            got = {(int(w), int(p)): int(v) for who, place, least in index.stream(query, q_size) for w, p, v in zip(who, place, least)}
            want = {}
            for k, (a, b) in enumerate(zip(q_cuts[:-1], q_cuts[1:])):
                for p in range(b - a - window + 1):
                    w = query[a + p:a + p + window].tobytes()
                    has = [j for j, t in enumerate(pieces) if w in t]
                    if has:
                        want[k, p] = has[0]
            assert got == want
            assert len(index.run_start) <= len(text) + len(size)


def test_bytes_that_remain(spark):
    passage = "".join(chr(0x4E00 + i) for i in range(60))
    rows = [(1, "start " + passage, None, None, 0), (2, passage + " end", None, None, 0), (3, None, None, None, 0), (4, "", None, None, 0)]
    out = {r.doc_id: r for r in run_index.remove_repeats(llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS))).collect()}
    assert out[2].kept == b" end" and out[2].spans == [[0, 180]]
    assert out[1].kept == rows[0][1].encode() and out[1].spans == [] and out[3].kept is None and out[4].kept == b""


def test_empty_table(spark):
    assert run_index.repeat_digest(spark.createDataFrame([], llm_cases.DOCS)).collect() == []
