import sys
import zlib
from os.path import dirname

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import queries
from test_ngram_trie import Brute

SF = "/root/testdata/sf0.001"


def test_registered_query_keeps_ngrams_seen_once(spark):
    rows = llm_cases.documents()
    brute = Brute([r[1] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1], least=1)
    assert 1 in brute.two.values() and 1 in brute.three.values()
    got = {r.doc_id: r for r in queries.op2_ngram_trie(spark, SF).collect()}
    assert len(got) == len(rows)
    assert max(abs(got[r[0]].score - brute.score(r[1])) / got[r[0]].n_tokens for r in rows) < 0.02  # one byte per probability
