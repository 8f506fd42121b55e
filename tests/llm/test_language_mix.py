import re
import sys
from os.path import dirname

import numpy as np
import pyarrow as pa

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import language_mix, queries, tokens
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").collect()}
    got = queries.op3_language_mix(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_mixed_text_gets_both_languages(spark):
    docs = queries.table(spark, SF, "documents")
    langs, model = language_mix.learn(docs, F.lit(True))
    rows = docs.where("n_chars > 1500").collect()
    en, de = (next(r.text for r in rows if r.lang == k)[:1500] for k in ("en", "de"))
    df = spark.createDataFrame([(1, en + "\n" + de[:750])], "doc_id long, text string")
    r = language_mix.predict(df, langs, model).first()
    assert r.lang_pred == "en" and set(r.mixture) == {"en", "de"} and 0.5 < r.score < 0.8


def test_odd_rows(spark):
    rows = llm_cases.documents() + llm_cases.odd_documents() + [(50, "12 34 %%", "en", "s", 1), (51, "é", "fr", "s", 1), (52, "日本", None, "s", 1)]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS))
    langs, model = language_mix.learn(df, F.lit(True))
    assert langs == ["de", "en", "es", "fr"]
    got = language_mix.predict(df, langs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    letters = sorted((str(i), t is not None and bool(re.search(r"[^\W\d_]", t))) for i, t, *_ in rows)
    assert sorted((str(r.id), r.lang_pred != "und") for r in got) == letters


def test_without_languages(spark):
    df = spark.createDataFrame(llm_cases.odd_documents(), llm_cases.DOCS)
    langs, model = language_mix.learn(df, F.lit(False))
    assert langs == [] and {r.lang_pred for r in language_mix.predict(df, langs, model).collect()} == {"und"}
    assert language_mix.predict(df.limit(0), langs, model).collect() == []


def test_em_finds_planted_proportions():
    rng = np.random.default_rng(0)
    model = np.log(rng.dirichlet(np.full(64, 0.3), 3) + 1e-9).astype(np.float32)
    p = np.exp(model)
    x = np.r_[rng.choice(64, 700, p=p[0] / p[0].sum()), rng.choice(64, 300, p=p[2] / p[2].sum())]
    bucket, n = np.unique(x, return_counts=True)
    _, mix = language_mix.proportions(np.zeros(len(bucket), int), bucket, n, model, 2.0, 60)
    assert abs(mix[0, 0] - 0.7) < 0.08 and mix[0, 1] == 0 and abs(mix[0].sum() - 1) < 1e-9


def test_buckets_do_not_cross_texts():
    both = language_mix.buckets(next(tokens.slices(pa.array(["abc", "", "Ab  12 cd"]))), 3, 16)
    one = language_mix.buckets(next(tokens.slices(pa.array(["Ab  12 cd"]))), 3, 16)
    assert both[0].tolist().count(0) == 1 and (both[1][both[0] == 2] == one[1]).all()
