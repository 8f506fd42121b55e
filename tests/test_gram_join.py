"""The gram join equals the nested loop, whatever is hot."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import dims, gram_join
from ledgerline.plans import standins

PATTERNS = ["%small%ring%", "%RING%", "%Ri%Sm%", "%a%", "%o_d%", "%zzz%", "%l%r%g%", "%ring%ring%", "%ng%ng%", "r%", "%small", "%é%", "%aaa%aaaa%", "%b%a%"]


def nested_loop(patterns, candidates):
    return patterns.crossJoin(candidates).where(F.ilike(F.col("search_text"), F.col("pattern")))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select("pattern", *columns).collect()), key=str)


@pytest.mark.parametrize("hot,prefix,limit", [(1 << 16, 2, None), (3, 2, None), (3, 3, 0), (1, 1, None), (1, 4, 0)])
def test_equals_nested_loop_on_names(spark, hot, prefix, limit):
    cands = dims.build_candidate_dim(standins.part_candidate_master(spark, SF_SMALL)).select("cand_id", "cycle", "search_text")
    patterns = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    got = rows(gram_join.ilike_join(patterns, cands, limit, hot, prefix), "cand_id", "cycle", "search_text")
    assert got == rows(nested_loop(patterns, cands), "cand_id", "cycle", "search_text") and len(got) > 100


def test_equals_nested_loop_on_ties_and_one_hot_gram(spark):
    """Many rows share a text, and every text shares one gram."""
    texts = ["anna SMITH", "smith anna", "Smith, Bob", "smithsmith", "bob s. mith", "aaaaaa", "aaaab", "ba", "", None, "smi", "Café Smith\nline", "x" * 300 + "smith"]
    cands = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(400)], "id int, search_text string")
    patterns = spark.createDataFrame([(p,) for p in ["%smith%", "%smi%", "%ann%smith%", "%smith%ann%", "%smith%smith%", "%bob%smith%", "%mith%bob%", "%aaa%aab%", "%é%smith%", "%line%", "_mith%", "%xx%smith%"]], "pattern string")
    want = rows(nested_loop(patterns, cands), "id")
    for hot, prefix in ((1 << 16, 2), (2, 2), (1, 2), (4, 5)):
        assert rows(gram_join.ilike_join(patterns, cands, None, hot, prefix), "id") == want


def test_long_posting_lists_are_split_and_grams_exploded_once(spark):
    texts = spark.createDataFrame([(f"name{i} smith",) for i in range(3000)], "search_text string")
    patterns = spark.createDataFrame([("%smith%",), ("%name7%smith%",)], "pattern string")
    pairs = gram_join.ilike_pairs(patterns, texts, broadcast_limit=0, hot=50)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # the posting lists are read, not made again
    assert "sequence" in plan and "pmod" in plan
    assert pairs.count() == 3000 + sum("name7" in f"name{i}" for i in range(3000))


def test_composite_keys_leave_out_texts_in_the_wrong_order(spark):
    postings = gram_join.posting_lists(
        spark.createDataFrame([("abc then xyz",), ("xyz then abc",), ("abc only",)], "search_text string"),
        spark.createDataFrame([("abc",), ("xyz",)], "gram string"))
    keys = spark.createDataFrame([("%abc%xyz%", ["abc", "xyz"])], "pattern string, key array<string>")
    assert [r.search_text for r in gram_join.keyed_postings(keys, postings).collect()] == ["abc then xyz"]
