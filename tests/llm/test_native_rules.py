import hashlib
import re
import sys
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import llm_cases
import pyarrow.parquet as pq
from ledgerline.llm import decontaminate, host_rules
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_measures(text):
    w, text = split(text), text or ""
    at = {}
    for s in range(len(w) - 7):
        at.setdefault(tuple(w[s:s + 8]), []).append(s)
    inside = {s + k for places in at.values() if len(places) > 1 for s in places for k in range(8)}
    lines = [x for x in text.split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_measures_match_brute_force(spark):
    rows = llm_cases.documents() + llm_cases.odd_documents()
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(4))
    got = host_rules.host_quality(df).collect()
    want = []
    for r in rows:
        m = brute_measures(r[1])
        want.append((r[0], *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert sorted([(r.doc_id, *[r[c] for c in host_rules.BASE], r.base_failed) for r in got], key=str) == sorted(want, key=str)
    assert all(r.kept == (not r.base_failed and not r.host_rejected) for r in got)
    assert any(r.n_repeat_words for r in got) and any(r.n_dup_lines for r in got)


def test_bad_host_is_rejected_and_small_host_is_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(40))
    junk = " ".join(f"w{i}%%%" for i in range(40))
    rows = [(i, good, None, f"host{i % 20}", 1) for i in range(2000)]
    rows += [(5000 + i, junk, None, "farm", 1) for i in range(300)] + [(6000, good, None, "farm", 1), (6001, junk, None, "tiny", 1), (6002, good, None, "tiny", 1)]
    got = {r.doc_id: r for r in host_rules.host_quality(spark.createDataFrame(rows, llm_cases.DOCS)).collect()}
    assert not got[6000].kept and got[6000].host_rejected and not got[6000].base_failed
    assert got[6001].kept and got[6002].kept and got[0].kept


def test_rules_on_an_empty_table(spark):
    assert host_rules.host_quality(spark.createDataFrame([], llm_cases.DOCS)).collect() == []


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute_contamination(rows, items, window=10):
    grams = {}
    for item, text in items:
        w = plain(text)
        for s in range(max(1, len(w) - window + 1)) if w else ():
            grams.setdefault(tuple(w[s:s + window]), set()).add(str(item) if item is not None else None)
    out = []
    for i, text, *_ in rows:
        w = plain(text)
        hit, found = set(), set()
        for width in {len(g) for g in grams}:
            for s in range(len(w) - width + 1):
                if (g := tuple(w[s:s + width])) in grams:
                    hit |= set(range(s, s + width))
                    found |= grams[g] - {None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    items += [(900, "Two WORDS"), (901, None), (902, " ... "), (None, "alpha beta gamma"), (903, "fünf"), (3, "delta epsilon")]
    rows = llm_cases.documents() + llm_cases.odd_documents() + [(77, "x, " + items[0][1].upper() + " tail", "en", "s", 1), (78, items[1][1], "en", "s", 1)]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(4))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1)).withColumn("at", F.lit("x"))
    want = brute_contamination(rows, items)
    for limit in (64 << 20, 0):
        got = decontaminate.contamination(df, bench, max_broadcast_bytes=limit).collect()
        assert sorted([tuple(r) for r in got], key=str) == want
    assert sum(r[5] for r in want) > 5


def test_spans_and_documents_are_removed(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [(1, "(Keep) this: ONE, two; three\nfour! and. that", "en", "s", 1), (2, "one two three four", "en", "s", 1), (3, None, "en", "s", 1), (4, "clean", None, None, None)]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS))
    got = decontaminate.remove_spans(df, bench)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "(Keep) this: and. that", 2: "", 3: None, 4: "clean"}
    assert {r.doc_id for r in decontaminate.remove_spans(df, bench, max_hit_share=0.5).collect()} == {1, 3, 4}


def test_contamination_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.contamination(docs, bench).collect()] == [False]
    assert decontaminate.remove_spans(docs, bench).count() == 1
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []
