"""Known persons in texts, and the rule of the capitalised form."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import name_automaton, names

PERSONS = ["DONALD TRUMP", "Kamala D. Harris", "trump jr", "Ann Lee", "Ann Lee Smith", "Lee Smith", "José Niño", "solo", "O'Brien-Smith Jr.", "a b c d", "c d"]


def by_hand(persons, text):
    """Leftmost-longest names over the words of a text, position by position."""
    known = {tuple(name_automaton.words(p)[0]) for p in persons}
    ws, places = name_automaton.words(text)
    out, i = [], 0
    while i < len(ws):
        sizes = [n for n in range(1, len(ws) - i + 1) if tuple(ws[i:i + n]) in known]
        if sizes:
            out.append(text[places[i][0]:places[i + max(sizes) - 1][1]])
            i += max(sizes)
        else:
            i += 1
    return out


def test_whole_lists(spark):
    texts = ["AP. Donald Trump won.", "kamala d harris and Kamala D. Harris", "Ann Lee. Smith", "ann lee smith", "Nobody Known Here", "José NIÑO; o'brien-smith jr", None, ""]
    df = spark.createDataFrame([(texts,), (["All Big City"],), ([],), (None,)], "t array<string>")
    known = spark.createDataFrame([(p,) for p in PERSONS], "name string")
    out = [r.candidate_names for r in names.with_candidate_names(df, F.col("t"), known).collect()]
    assert out[0] == ["Donald Trump", "kamala d harris", "Kamala D. Harris", "Ann Lee", "ann lee smith", "Nobody Known Here", "José NIÑO", "o'brien-smith jr"]
    assert out[1:] == [[], [], None]


@pytest.mark.parametrize("limit", [name_automaton.NAME_TEXT_LIMIT, 0])
def test_spans_equal_search_by_hand(spark, limit):
    rng = random.Random(6)
    pieces = ["ann", "Lee", "Smith", "a", "b", "c", "d", "solo", "Trump", "Jr.", "Donald", ".", ",", "\n", "x1", "é", "Kamala", "D.", "harris", "  ", "—"]
    rows = [([" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 4))],) for _ in range(60)] + [(None,), ([None, "solo"],), (["solo"],), (["solo"],)]
    df = spark.createDataFrame(rows, "t array<string>").repartition(3)
    known = spark.createDataFrame([(p,) for p in PERSONS], "name string")
    for r in name_automaton.known_spans(df, "t", known, "k", limit).collect():
        assert r.k == (None if r.t is None else [by_hand(PERSONS, t or "") for t in r.t])


def test_no_persons(spark):
    df = spark.createDataFrame([(["Ann Lee"],)], "t array<string>")
    none = spark.createDataFrame([], "name string")
    for limit in (name_automaton.NAME_TEXT_LIMIT, -1):
        assert [r.k for r in name_automaton.known_spans(df, "t", none, "k", limit).collect()] == [[[]]]


def test_names_of_a_dimension(spark):
    dim = spark.createDataFrame([("ANN", None, "LEE"), ("ANN", "B", "LEE"), (None, None, "SOLO"), ("", "", "")], "first_name string, middle_name string, last_name string")
    assert sorted(r.name for r in name_automaton.person_names(dim).collect()) == ["ANN B LEE", "ANN LEE"]


def test_capitalised_form_depends_on_alphabetic_words(spark):
    """Hand-derived: words with digits, dots or hyphens inside don't count."""
    want = {"joe biden": True, "joe Biden": False, "the U.S. won": True, "the 24th, well-Known day": True, "ends Here.": False, "ends here.": True, "123 4.5": False, "": False,
            "trump's win": True, "Trump's win": False, "漢字 text": False, "x (Yes)": False}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert {r.t: r.v for r in df.select("t", names.needs_title_variant(F.col("t")).alias("v")).collect()} == want
