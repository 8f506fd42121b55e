import re
import sys
from collections import Counter
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import token_ledger
from ledgerline.llm.store import new_folder
from pyspark.sql import functions as F

FEED = "op string, seq long, doc_id long, text string, source string, lang string, tokenizer string"


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


def brute(batches):
    held = {}
    for rows in batches:
        last = {}
        for op, seq, i, *rest in rows:
            if i is not None and (i not in last or seq >= last[i][0]):
                last[i] = (seq, op, *rest)
        for i, (_, op, text, source, lang, tokenizer) in last.items():
            held.pop(i, None)
            if op != "delete":
                pattern = r"[^\x20\x09-\x0D]+" if tokenizer == "words-1" else r"[0-9A-Za-z\x80-\U0010FFFF]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
                held[i] = ((source, lang, tokenizer), len(re.findall(pattern, text or "")))
    docs, n = Counter(), Counter()
    for key, count in held.values():
        docs[key] += 1
        n[key] += count
    return {k: (docs[k], n[k]) for k in docs}


def test_batches_match_a_recount(spark):
    rows = llm_cases.documents()
    one = [("insert", 1, i, t, s, lang, "words-1") for i, t, lang, s, _ in rows] + [("insert", 1, None, "x", "s", "en", "words-1"), ("insert", 1, 900, None, None, None, "words-1"), ("insert", 2, 901, "", "s", "en", "signs-2")]
    two = [("delete", 1, i, None, None, None, None) for i in range(0, 60, 3)] + [("delete", 1, 12345, None, None, None, None), ("revise", 2, 5, "new text, longer", "other", "de", "signs-2"), ("revise", 3, 5, "a b c", "other", "de", "signs-2")]
    three = [("insert", 1, 0, "back again", "src0", "en", "words-1"), ("revise", 1, 7777, "was unknown", "s", "en", "words-1"), ("revise", 1, 5, "a b c d!", "third", None, "signs-2"), ("delete", 9, 900, None, None, None, None)]
    ledger = token_ledger.Ledger(spark, new_folder(spark, "ledger-test"))
    for k, batch in enumerate((one, two, three), 1):
        frame = llm_cases.clashing(spark.createDataFrame(batch, FEED))
        assert ledger.commit(f"b{k}", frame) and not ledger.commit(f"b{k}", frame)
        assert totals(ledger) == brute([one, two, three][:k])
    ledger.compact("c1")
    assert ledger.committed() == ["c1"] and totals(ledger) == brute([one, two, three])
    assert not ledger.commit("b2", spark.createDataFrame(two, FEED))
    assert ledger.commit("b4", spark.createDataFrame([("delete", 1, i, None, None, None, None) for i in range(9000)], FEED))
    assert totals(ledger) == {}


def test_a_broken_off_batch_is_written_anew(spark, monkeypatch):
    ledger = token_ledger.Ledger(spark, new_folder(spark, "ledger-test"))
    first = spark.createDataFrame([("insert", 1, 1, "a b", "s", "en", "words-1")], FEED)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger, "_fs", fail)
        with pytest.raises(OSError):
            ledger._write("b1", first.select("doc_id", "source", "lang", "tokenizer", F.lit(1).cast("long").alias("d_docs"), F.lit(9).cast("long").alias("d_tokens")), ledger.sequence())
    assert totals(ledger) == {}
    assert ledger.commit("b1", first) and totals(ledger) == {("s", "en", "words-1"): (1, 2)}


def test_empty_feed_and_unknown_tokenizer(spark):
    ledger = token_ledger.Ledger(spark, new_folder(spark, "ledger-test"))
    assert ledger.commit("none", spark.createDataFrame([], FEED)) and totals(ledger) == {}
    with pytest.raises(ValueError):
        ledger.commit("bad", spark.createDataFrame([("insert", 1, 1, "a", "s", "en", "nobody")], FEED))
    with pytest.raises(ValueError):
        ledger.commit("a@b", spark.createDataFrame([], FEED))


def test_byte_pair_counts(spark):
    from tokenizers import Tokenizer

    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    count = token_ledger.count_bpe("/opt/tokenizers/byte_bpe_50k.tiktoken", pattern)
    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    rows = [(i, t) for i, t, *_ in llm_cases.documents()[:40]] + [(900, None), (901, "")]
    got = {r.doc_id: r.n for r in spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", count("text").alias("n")).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in rows}


def test_overlapping_commits(spark):
    """A revision and a deletion of one document, both worked out after the
    first batch: the second to be written is worked out anew."""
    folder = new_folder(spark, "ledger")
    row = lambda op, seq, text: [(op, seq, 7, text, "s", "en", "words-1")]
    one, two = token_ledger.Ledger(spark, folder), token_ledger.Ledger(spark, folder)
    feed = lambda rows: spark.createDataFrame(rows, FEED)
    one.commit("b1", feed(row("insert", 1, "a b c")))
    base = two.sequence()
    revised = two.signed(feed(row("revise", 2, "a b c d e")))
    assert one.commit("b2", feed(row("delete", 2, None)))
    assert not two._write("b3", revised, base)
    assert totals(two) == {} and not two.is_committed("b3")
    assert two.commit("b3", feed(row("revise", 3, "a b c d e")))
    assert totals(one) == {("s", "en", "words-1"): (1, 5)} == totals(two)
    assert one.documents().count() == 1
