"""Operators 3 and 8 against plain versions, document by document: EM over
every subset of the languages, and FTRL over a dictionary of features."""

import math
import re
import sys
from collections import Counter, defaultdict
from itertools import combinations
from os.path import dirname

import numpy as np

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import language_mix, quality_model
from pyspark.sql import functions as F

M = (1 << 64) - 1
small = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")


def mixed(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & M
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & M
    return x ^ x >> 33


def trigrams(text):
    """Buckets of the letter trigrams of a text, and how often each comes."""
    signs = [b if 97 <= b <= 122 or b >= 128 else 32 for b in small(text or "").encode()]
    signs = [s for i, s in enumerate(signs) if s != 32 or i == 0 or signs[i - 1] != 32]
    return Counter(mixed((a * 257 + b) * 257 + c) >> 48 for a, b, c in zip(signs, signs[1:], signs[2:]))


def subsets_em(counts, logs, penalty=2.0, rounds=12):
    """(value, languages, proportions) of every subset, the best first."""
    buckets, weight = np.array(list(counts)), np.array(list(counts.values()), float)
    p = np.exp(logs[:, buckets] - logs[:, buckets].max(0)).T
    out = []
    for size in range(1, len(logs) + 1):
        for chosen in combinations(range(len(logs)), size):
            mix = np.full(size, 1 / size)
            for _ in range(rounds):
                joint = p[:, chosen] * mix
                mix = (joint / np.maximum(joint.sum(1), 1e-300)[:, None] * weight[:, None]).sum(0) / weight.sum()
            fit = (weight * np.log(np.maximum((p[:, chosen] * mix).sum(1), 1e-300))).sum()
            out.append((fit - penalty * math.log(max(weight.sum(), 2)) * size, chosen, mix))
    return sorted(out, key=lambda x: -x[0])


def test_languages_are_those_of_the_best_subset(spark):
    rows = [r for r in llm_cases.documents() if len(r[1] or "") < 4000]
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r[1])
    two = [(1000 + i, by_lang[a][i][:400 + 100 * i] + "\n" + by_lang[b][i + 1][:300], a, "s", 0) for i, (a, b) in enumerate([("en", "de"), ("fr", "es"), ("de", "fr"), ("es", "en")] * 3)]
    docs = spark.createDataFrame(rows, llm_cases.DOCS)
    langs, model = language_mix.learn(docs, F.lit(True))
    table = np.zeros((len(langs), 1 << 16))
    for lang in langs:
        for text in by_lang[lang]:
            for bucket, n in trigrams(text).items():
                table[langs.index(lang), bucket] += n
    logs = np.log((table + 0.05) / (table + 0.05).sum(1, keepdims=True)).astype(np.float32).astype(float)
    assert np.abs(logs - model).max() < 1e-6
    got = {r.id: r for r in language_mix.predict(spark.createDataFrame(rows[:60] + two, llm_cases.DOCS), langs, model).collect()}
    alike = 0
    for i, text, *_ in rows[:60] + two:
        if not (counts := trigrams(text)):
            continue
        tried = subsets_em(counts, logs)
        value = {frozenset(langs[k] for k, share in zip(chosen, mix) if share > 1e-3): v for v, chosen, mix in reversed(tried)}
        best = {langs[k]: share for k, share in zip(tried[0][1], tried[0][2])}
        mine = frozenset(got[i].mixture)
        # elimination may end one step beside the best of all subsets, not far below it
        assert tried[0][0] - value[mine] <= 2.0 * math.log(sum(counts.values())), i
        assert got[i].lang_pred == max(sorted(best), key=best.get), i
        if mine == frozenset(k for k, share in best.items() if share > 1e-3):
            alike += 1
            assert all(abs(got[i].mixture[k] - best[k]) < 1e-6 for k in mine)
    assert alike > 0.95 * len(got)
    assert all(len(got[1000 + i].mixture) == 2 for i in range(12))


def shape(word):
    kinds = ["a" if 97 <= b <= 122 or b >= 128 else "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else chr(b) for b in word.encode()]
    return "".join(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)


def features(text):
    ws = split(text)
    low, shapes = [small(w) for w in ws], [shape(w) for w in ws]
    found = Counter()
    for i in range(len(ws)):
        found["word", low[i]] += 1
        found["shape", shapes[i]] += 1
        if i:
            found["pair", low[i - 1], low[i]] += 1
            found["shapes", shapes[i - 1], shapes[i]] += 1
            found["again"] += low[i - 1] == low[i]
    return {k: n / max(len(ws), 1) for k, n in found.items() if n}


def dictionary_ftrl(examples, epochs=4, alpha=1.0, beta=1.0, l1=0.002):
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= l1 else -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha)

    for _ in range(epochs):
        for values, label in examples:
            values = {**values, "bias": 1.0}
            w = {k: weight(k) for k in values}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[k] * v for k, v in values.items())))))
            for k, v in values.items():
                g = (p - label) * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * w[k]
                n[k] += g * g
    return weight


def test_scores_are_those_of_a_dictionary_model(spark):
    rows = [r for r in llm_cases.documents() if len(r[1] or "") < 3000][:90] + [(r[0] + 5000, *r[1:]) for r in llm_cases.odd_documents() if r[0] in (4, 5, 8, 9, 11)]
    labels = [(r[0], (r[0] * 7 + len(r[1] or "")) % 2) for r in rows[:60]]
    docs = spark.createDataFrame(rows, llm_cases.DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    weights = quality_model.train(docs, marks, F.lit(True), bits=22)  # few features share a bucket
    order = {r.doc_id: r.h for r in marks.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    text = {r[0]: r[1] for r in rows[:90]}
    seen = sorted((order[i], i, text[i] or "", y) for i, y in labels)
    weight = dictionary_ftrl([(features(t), y) for _, _, t, y in seen])
    close = []
    got = quality_model.score(docs, weights).collect()
    for r in rows:
        total = sum(weight(k) * v for k, v in features(r[1]).items()) + weight("bias")
        close.append((r[0], 1 / (1 + math.exp(-total))))
    by_id = defaultdict(list)
    for r in got:
        by_id[r.id].append(r.score)
    gaps = [min(abs(s - score) for s in by_id[i]) for i, score in close]
    assert np.median(gaps) < 1e-4 and max(gaps) < 0.02
    assert max(s for _, s in close) - min(s for _, s in close) > 0.1
