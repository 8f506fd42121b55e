import sys
from os.path import dirname

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import pieces, tokens

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(MODEL)


def brute(text, table, unknown):
    """All segmentations of a text with their scores, best first."""
    def cut(rest):
        if not rest:
            return [(0.0, [])]
        out = []
        for k in range(1, len(rest) + 1):
            score = table.get(rest[:k].encode())
            if score is None and k == 1:
                score = unknown
            if score is not None:
                out += [(score + s, [rest[:k], *p]) for s, p in cut(rest[k:])]
        return out
    return sorted(cut(" " + text), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["hello", "ab cd", "  two", "x ", "naïve é", "日本語", "a\nb", "the then", "a b c d"])
def test_n_best_matches_brute_force(vocabulary, text):
    table = {vocabulary.pieces[i]: vocabulary.scores[i] for i in np.flatnonzero(vocabulary.usable)}
    want = [s for s, _ in brute(text, table, vocabulary.unknown_score)][:7]
    s = next(tokens.slices(pa.array([text])))
    ids, scores, changes = next(iter(pieces.Encoder(vocabulary, 7).encode(s)))
    assert scores == want
    assert vocabulary.decode(ids.tolist()).decode() == text
    assert len({str(c) for c in changes}) == len(scores)


def test_whole_table_round_trips(spark, vocabulary):
    rows = llm_cases.documents() + llm_cases.odd_documents() + [(70, "▁ sign ▁▁ and \u0000 and 🦊\r\n  x  ", "en", "s", 1)]
    df = llm_cases.clashing(spark.createDataFrame(rows, llm_cases.DOCS).repartition(4))
    got = pieces.segmentation_digest(df, vocabulary).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert all(r.nbest_scores == sorted(r.nbest_scores, reverse=True) and r.score == r.nbest_scores[0] for r in got)
    assert [(r.n_pieces, r.score) for r in got if r.doc_id in (4, 5)][-2:] == [(0, 0.0), (0, 0.0)]
    encoded = pieces.decode(pieces.encode(df.where("doc_id is null or doc_id < 20"), vocabulary), vocabulary)
    want = sorted([(r[0], r[1] or "") for r in rows if r[0] is None or r[0] < 20], key=str)
    assert sorted([(r.doc_id, r.text) for r in encoded.collect()], key=str) == want


def test_vocabulary_with_pieces_over_spaces():
    v = pieces.Vocabulary([b"<unk>", b" a", b"a b", b" b", b" ", b"a", b"b"], np.array([0, -3.0, -1.0, -3.0, -2.0, -4.0, -4.0]), np.array([False] + [True] * 6), [], 0)
    assert not v.cuts_at_spaces()
    ids, scores, _ = next(iter(pieces.Encoder(v, 3).encode(next(tokens.slices(pa.array(["a b"]))))))
    table = {v.pieces[i]: v.scores[i] for i in range(1, 7)}
    assert scores == [s for s, _ in brute("a b", table, v.unknown_score)][:3] and v.decode(ids) == b"a b"


def test_empty_table(spark, vocabulary):
    assert pieces.segmentation_digest(spark.createDataFrame([], llm_cases.DOCS), vocabulary).collect() == []
