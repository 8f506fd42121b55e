import re
import sys
from itertools import permutations
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """The contract step by step: every document through every order."""
    seen = {}
    for i, text, *_ in rows:
        if i is not None:
            seen[text or ""] = min(i, seen.get(text or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": t in seen and (i is None or seen[t] < i)}
        mine = [x for x in labels if x[0] == i and i is not None]
        docs.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {d[0] for d in docs}:
        rows, shap = [], dict.fromkeys("ABCDE", 0)
        here = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = here
            for k, x in enumerate(order, 1):
                gone, kept = [d for d in left if d[1][x]], [d for d in left if not d[1][x]]
                fails = [d for d in here if d[1][x]]
                shap[x] += len(gone)
                rows.append([part, "".join(order), k, len(kept), len(gone), len(fails) - len(gone), sum(1 for d in fails if sum(d[1].values()) == 1),
                             sum(d[2] for d in gone), sum(d[3] for d in gone), x])
                left = kept
        out += [tuple(r[:-1]) + (shap[r[-1]],) for r in rows]
    return sorted(out)


def test_report_equals_every_order_run_by_hand(spark):
    rows = llm_cases.documents() + llm_cases.odd_documents() + [(i + 500, t, None if i % 3 else "xx", s, n) for i, t, _, s, n in llm_cases.documents()[:60]]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, 1, 1), (None, 1, 1), (7, None, None), (11, 1, 0), (510, 1, 1), (999, 1, 1), (1, 1, 0)] + [(i, i % 2, i % 5 == 0) for i in range(20, 120)]
    labels = [(i, q, int(t) if t is not None else None) for i, q, t in labels]
    docs = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(5))
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "'extra' AS mask", "'extra' AS id", "'extra' AS part")
    got = sorted(tuple(r) for r in filter_audit.filter_audit(docs, marks).collect())
    assert got == brute(rows, labels)
    assert {r[0] for r in got} >= {"", "xx"} and len(got) == 600 * len({r[0] for r in got})


def test_walk_toggles_every_subset_once():
    import numpy as np

    rng = np.random.default_rng(3)
    masks, weights = np.arange(32), rng.integers(0, 9, (32, 3))
    states = filter_audit.survivors(masks, weights, 5)
    for s in range(32):
        assert (states[s] == weights[(masks & s) == 0].sum(axis=0)).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(spark.createDataFrame([], llm_cases.DOCS), none).collect() == []
    one = filter_audit.filter_audit(spark.createDataFrame([(1, None, None, None, None)], llm_cases.DOCS), none).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and all(r.kept == 0 or "A" not in r.filter_order[:r.step] for r in one)
