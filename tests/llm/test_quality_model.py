import sys
import zlib
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import queries, quality_model
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op8_quality_model(spark, SF).collect()
    truth = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum((s >= 0.5) == (y == 1) for s, y in held) / len(held) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_scores_do_not_depend_on_slices_or_other_columns(spark):
    docs = spark.createDataFrame(llm_cases.documents() + llm_cases.odd_documents(), llm_cases.DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 100)] + [(None, 1, 0), (5, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    weights = quality_model.train(docs, labels, F.lit(True))
    a = sorted(((str(r.id), r.score) for r in quality_model.score(docs, weights).collect()))
    b = sorted(((str(r.id), r.score) for r in quality_model.score(llm_cases.clashing(docs).repartition(9), weights).collect()))
    assert a == b and all(0 <= s <= 1 for _, s in a)


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame(llm_cases.odd_documents(), llm_cases.DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights = quality_model.train(docs, none, F.lit(True))
    assert {r.score for r in quality_model.score(docs, weights).collect()} == {0.5}
    assert quality_model.score(docs.limit(0), weights).collect() == []


def test_ftrl_learns_a_separable_rule():
    import numpy as np

    model, rng = quality_model.Ftrl(8, 1.0, 1.0, 0.0, 0.0), np.random.default_rng(0)
    for _ in range(400):
        y = int(rng.integers(2))
        model.learn(np.array([y, 5, 8]), np.array([1.0, 1.0, 1.0]), y)
    w = model.weights()
    assert w[1] > 1 and w[0] < -1 and abs(w[7]) < 1e-9
