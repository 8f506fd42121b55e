import hashlib
import re
import sys
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import substring


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window):
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text, *_ in rows:
        w = split(text)
        for s in range(len(w) - window + 1):
            k, at = tuple(w[s:s + window]), (order(i), s)
            if k not in first or at < first[k]:
                first[k] = at
    out = []
    for i, text, *_ in rows:
        w = split(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (order(i), s):
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digest_matches_brute_force(spark, monkeypatch):
    rows = llm_cases.documents() + [(i + 1000 if i is not None else None, *rest) for i, *rest in llm_cases.odd_documents()]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(6))
    for slice_bytes in (2 << 20, 2000):
        monkeypatch.setattr(substring, "SEED_BYTES", slice_bytes)
        got = sorted([tuple(r) for r in substring.substring_digest(df).collect()], key=str)
        assert got == brute(rows, 20)
    assert sum(r[2] for r in got) > 100


def test_short_window(spark):
    rows = llm_cases.odd_documents()[:6]
    df = spark.createDataFrame(rows, llm_cases.DOCS)
    assert sorted([tuple(r) for r in substring.substring_digest(df, window=5, anchor=2).collect()], key=str) == brute(rows, 5)


def test_texts_lose_only_their_repeats(spark):
    rows = llm_cases.odd_documents()
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS))
    out = substring.remove_repeats(df)
    assert out.columns == df.columns
    got = {(r.doc_id, i): r.text for i, r in enumerate(sorted(out.collect(), key=lambda r: (str(r.doc_id), str(r.text))))}
    texts = [t for (i, _), t in got.items() if i == 2]
    assert texts == ["Intro words here. and an end"]
    assert [t for (i, _), t in got.items() if i == 4] == [None] and [t for (i, _), t in got.items() if i == 5] == [""]
    assert len([1 for (i, _), t in got.items() if i == 3 and t == ""]) == 2


def test_empty_table(spark):
    assert substring.substring_digest(spark.createDataFrame([], llm_cases.DOCS)).collect() == []
