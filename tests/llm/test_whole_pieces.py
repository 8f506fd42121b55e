import hashlib
import sys
from collections import Counter
from os.path import dirname

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

sys.path.insert(0, dirname(__file__))
import corpus_pipeline
import llm_cases
from ledgerline.llm import pieces, queries, tokens
from test_pieces import MODEL, brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary(spark):
    return pieces.fitted(queries.table(spark, SF, "documents"), MODEL)


def first(vocabulary, text, n=1):
    return next(iter(pieces.Encoder(vocabulary, n).encode(next(tokens.slices(pa.array([text]))))))


def test_counts_are_those_of_the_models_own_encoding(spark, model):
    rows = llm_cases.documents() + llm_cases.odd_documents()
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(4))
    want = Counter(i for r in rows if r[1] for i in model.encode(r[1]))
    assert {r.piece: r.n for r in pieces.own_counts(df, MODEL).collect()} == want


def test_fitted_scores_are_log_probabilities(spark, vocabulary):
    n = {r.piece: r.n for r in pieces.own_counts(queries.table(spark, SF, "documents"), MODEL).collect()}
    total = sum(n.values()) + vocabulary.usable.sum()
    for i in range(259, 32000, 97):
        assert abs(vocabulary.scores[i] - np.log((n.get(i, 0) + 1) / total)) < 1e-6
    assert abs(np.exp(vocabulary.scores[vocabulary.usable]).sum() - 1) < 0.01


def test_common_words_are_whole_pieces(model, vocabulary):
    for text in ("the", "the and", "for it with that"):
        assert first(vocabulary, text)[0].tolist() == model.encode(text)


@pytest.mark.parametrize("text", ["hello", "the then", "  two", "naïve é", "日本語"])
def test_n_best_matches_brute_force(vocabulary, text):
    table = {vocabulary.pieces[i]: vocabulary.scores[i] for i in np.flatnonzero(vocabulary.usable)}
    assert first(vocabulary, text, 7)[1] == [s for s, _ in brute(text, table, vocabulary.unknown_score)][:7]


def test_query_and_pipeline_use_the_fitted_scores(spark, vocabulary):
    texts = {r[0]: r[1] for r in llm_cases.documents()}
    for r in queries.op4_nbest_pieces(spark, SF).collect():
        assert r.ids_sha256 == hashlib.sha256(first(vocabulary, texts[r.doc_id])[0].astype("<i4").tobytes()).hexdigest()
    docs = queries.table(spark, SF, "documents")
    for r in corpus_pipeline.encoded(spark, docs, SF).collect():
        assert r.ids == first(vocabulary, texts[r.doc_id])[0].tolist()


def test_nothing_to_fit(spark):
    v = pieces.fitted(spark.createDataFrame([], llm_cases.DOCS), MODEL)
    assert np.isfinite(v.scores).all() and v.decode(first(v, "a b")[0].tolist()) == b"a b"


def test_digest_returns_every_rank(spark, vocabulary):
    df = spark.createDataFrame([(1, "there", "en", "s", 5), (2, "", "en", "s", 0), (3, "of these and there", "en", "s", 18)], llm_cases.DOCS)
    got = {r.doc_id: r for r in pieces.segmentation_digest(df, vocabulary).collect()}
    for r in pieces.encode(df, vocabulary).collect():
        assert got[r.doc_id].alternatives == r.alternatives and len(r.alternatives) == len(r.scores)
    others = [change[0].ids for change in got[1].alternatives[1:]]
    assert len({tuple(x) for x in others}) == 3 and all(vocabulary.decode(x) == b"there" for x in others)
    assert [sum(vocabulary.scores[x]) for x in others] == got[1].nbest_scores[1:]
