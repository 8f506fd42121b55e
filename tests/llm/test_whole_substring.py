import random
import sys
from os.path import dirname

import numpy as np

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import substring
from test_substring import split


def repeats(rows, window):
    """Maximal spans of windows that also start earlier, by document."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w, gone = split(text), []
        for s in range(len(w) - window + 1):
            if (g := tuple(w[s:s + window])) in seen:
                if gone and s <= gone[-1][1]:
                    gone[-1][1] = s + window
                else:
                    gone.append([s, s + window])
            seen.add(g)
        if gone:
            out[i] = gone
    return out


def spans_of(df):
    got = [(r.id, np.frombuffer(r.spans, np.int32).reshape(-1, 2).tolist()) for r in df.collect()]
    assert len({i for i, _ in got}) == len(got)
    return dict(got)


def test_a_long_repeat_is_one_span(spark):
    rng = random.Random(3)
    long_ = [f"p{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(i)] + long_[10 * i:] + [f"b{i}x{k}" for k in range(30)])) for i in range(8)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], llm_cases.DOCS).repartition(8)
    assert spans_of(substring.repeated_spans(df)) == repeats(rows, 20)


def test_a_hot_anchor_spreads_over_tasks(spark):
    rng = random.Random(4)
    phrase = [f"hot{k}" for k in range(14)]
    rows = []
    for i in range(400):
        w = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        rows.append((i, " ".join(w[:20] + phrase + w[20:]) if i % 10 else " ".join(rows[-3][1].split()[5:45]) if i else "few"))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], llm_cases.DOCS).repartition(8)
    want = repeats(rows, 20)
    assert want
    for least in (100, 10**9):
        assert spans_of(substring.repeated_spans(df, hot_windows=least)) == want
        windows = {}
        for r in substring.dealt(df, "doc_id", "text", 20, 10, least).where("kind = 0").collect():
            _, _, h, _, _, _, count, _ = substring._unpack(bytes(r.blob))
            for a, n in zip(h.tolist(), count.tolist()):
                at = windows.setdefault(a, {})
                at[r.shard] = at.get(r.shard, 0) + n
        top = max(windows.values(), key=lambda x: sum(x.values()))
        assert sum(top.values()) > 300
        assert (max(top.values()) < 0.3 * sum(top.values())) == (least == 100)
