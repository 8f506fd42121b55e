import re
import sys
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import corpus_pipeline
import llm_cases
import pyarrow.parquet as pq
from ledgerline.llm import pieces, quality_model
from ledgerline.llm.queries import table
from pyspark.sql import functions as F
from test_native_rules import plain
from test_simhash import brute_components, brute_fingerprint
from test_substring import split

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    weights = quality_model.train(docs, table(spark, SF, "labels"), F.lit(True))
    good = {r.id for r in quality_model.score(docs, weights).where("score >= 0.5").collect()}
    kept = sorted((r for r in llm_cases.documents() if r[0] in good), key=lambda r: r[0])
    assert 100 < len(kept) < 200
    label = brute_components([brute_fingerprint(r[1]) for r in kept], 2)
    kept = [r for i, r in enumerate(kept) if label[i] == i]
    # repeats of 20 words
    seen, cut = set(), []
    for r in kept:
        w = split(r[1])
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if (g := tuple(w[s:s + 20])) in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(g)
        if not all(gone):
            cut.append((r[0], " ".join(x for x, g in zip(w, gone) if not g)))
    # benchmark windows of 10 words
    grams = set()
    for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist():
        w = plain(r["text"])
        grams |= {tuple(w[s:s + 10]) for s in range(max(1, len(w) - 9))}
    want = {}
    for i, text in cut:
        w = plain(text)
        hit = {p for s in range(len(w) - 9) if tuple(w[s:s + 10]) in grams for p in range(s, s + 10)}
        if len(hit) <= len(w) / 2:
            want[i] = [x for p, x in enumerate(w) if p not in hit]
    want = {i: w for i, w in want.items() if w}
    vocabulary = pieces.Vocabulary.load(corpus_pipeline.PIECE_MODEL)
    got = {r.doc_id: plain(vocabulary.decode(r.ids).decode()) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_take_odd_rows(spark):
    docs = llm_cases.clashing(spark.createDataFrame(llm_cases.odd_documents() + llm_cases.documents()[20:60], llm_cases.DOCS))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        assert 0 < out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert len([r for r in kept if r.doc_id in (1, 3)]) == 1  # three copies of one passage
    assert len([r for r in kept if r.text is None or not re.search(r"\S", r.text)]) == 1


def test_keep_good_passes_rows_unchanged(spark):
    docs = llm_cases.clashing(spark.createDataFrame(llm_cases.documents()[:50], llm_cases.DOCS))
    out = corpus_pipeline.quality(spark, docs, SF)
    assert out.exceptAll(docs).count() == 0
