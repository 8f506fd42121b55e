import random
import sys
from os.path import dirname

import numpy as np
import xxhash

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import simhash


def brute_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, bits):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_components_match_brute_force(spark):
    rows = llm_cases.documents() + [(i + 1000 if i is not None else None, *rest) for i, *rest in llm_cases.odd_documents()]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(5))
    got = simhash.simhash_components(df).collect()
    prints = [brute_fingerprint(r[1]) for r in rows]
    label = brute_components(prints, 2)
    least = {}
    for r, k in zip(rows, label):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    want = sorted([(r[0], p, least.get(k)) for r, p, k in zip(rows, prints, label)], key=key)
    assert sorted([(r.id, r.fp % 2**64, r.component) for r in got], key=key) == want


def test_index_links_dense_groups_exactly():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    points = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(12)) for b in base for _ in range(40)}
    points |= {base[0] ^ i for i in range(256)}  # a full cube of eight bits
    points = sorted(points)
    for bits in (0, 1, 2, 4):
        fp = np.array(points, np.uint64)
        rank = fp.copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        fp = fp[np.argsort(rank)]
        label = simhash.local_components(len(fp), simhash.GrayIndex(fp, np.zeros(len(fp), int)).links(bits))
        assert label.tolist() == brute_components(fp.tolist(), bits)


def test_chain_of_links_is_one_component(spark):
    fps, x = [], 0
    for i in range(60):
        x ^= 0b11 << (2 * (i % 32))
        fps.append((x if x < 2**63 else x - 2**64,))
    df = spark.createDataFrame(fps, "fp long").distinct()
    roots = simhash.components(simhash.fingerprint_edges(df, 2)).collect()
    assert len({r.root for r in roots}) == 1 and len(roots) == df.count()


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], llm_cases.DOCS)).collect() == []
