import base64
import re
import sys
from collections import Counter
from os.path import dirname

import tiktoken
from public_tokenizers import PATTERN

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import queries

SF = "/root/testdata/sf0.001"


def test_bpe_query_matches_a_recount(spark):
    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs, n = Counter(), Counter()
    for i, text, lang, source, _ in llm_cases.documents():
        if i % 10 == 3 and i % 7:
            continue
        key = (source, lang, "byte-bpe-50k" if i % 7 else "signs-2")
        docs[key] += 1
        n[key] += len(bpe.encode_ordinary(text)) if i % 7 else len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", text))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.QUERIES["op7_token_ledger_bpe"](spark, SF).collect()}
    assert got == {k: (docs[k], n[k]) for k in docs}
