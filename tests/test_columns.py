"""Column steps against the hand-traced rows of FIXTURES.md §2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import classify, names, parsing, text
from ledgerline.operators import catalog


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


C3_ROWS = [
    ("SMITH, JOHN A JR", ("JOHN", "A", "SMITH", None, "JR")),
    ("Smith, Dr Jane", ("JANE", None, "SMITH", "DR", None)),
    ("SMITH, DR. JANE", ("DR.", "JANE", "SMITH", None, None)),
    ("SMITH, JOHN, JR", ("JOHN", None, "SMITH", None, None)),
    ("SMITH, JR", ("JR", None, "SMITH", None, "JR")),
    ("SMITH, DR", (None, None, "SMITH", "DR", None)),
    ("SMITH, JOHN DR", ("JOHN", "DR", "SMITH", None, None)),
    ("SMITH,", (None, None, "SMITH", None, None)),
    (", JOHN", ("JOHN", None, None, None, None)),
    ("jane q  public", ("JANE", "Q", "PUBLIC", None, None)),
    ("MADONNA", ("MADONNA", None, None, None, None)),
    ("JOHN SMITH JR", ("JOHN", "SMITH", "JR", None, None)),
    ("", (None, None, None, None, None)),
    ("   ", (None, None, None, None, None)),
    (None, (None, None, None, None, None)),
]


def test_name_parts(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(C3_ROWS)], "i int, n string")
    named = text.add_name_parts(df.withColumn("normalized_name", text.normalize_text(F.col("n"))))
    got = {r.i: (r.first_name, r.middle_name, r.last_name, r.prefix, r.suffix) for r in named.collect()}
    assert got == {i: want for i, (_, want) in enumerate(C3_ROWS)}


def test_normalize_text(spark):
    got = _one(spark, [("  a \t b ",), ("straße",), ("José",), (None,)], "n string", text.normalize_text(F.col("n")))
    assert got[0] == "A B"
    assert got[1] == "STRASSE"
    assert got[2] == "JOSÉ" and len(got[2]) == 5
    assert got[3] is None


def test_normalize_query(spark):
    got = _one(spark, [("Smith, John",), ("a|A",), (", ,",), ("",)], "n string", text.normalize_query(F.col("n")))
    assert got == ["%Smith%John%", "%a|A%", "%", "%"]


def test_extract_queries(spark):
    rows = [("A B, C D",), ("Trump",), ("a|A",), ("nan",), ("None",), ("  ",), (None,), (", ,",)]
    got = _one(spark, rows, "n string", text.extract_queries(F.col("n")))
    assert got == [["A B, C D", "A B", "C D"], ["Trump"], ["a|A", "a"], [], [], [], [], [", ,"]]


def test_parse_float(spark):
    rows = [("12.5",), (" 12 ",), ("",), ("null",), ("abc",), (None,), ("inf",), ("1_000",), ("1.0d",)]
    got = _one(spark, rows, "v string", parsing.parse_float(F.col("v")))
    assert got[:6] == [12.5, 12.0, None, None, None, None]
    assert got[6] == float("inf") and got[7] == 1000.0 and got[8] is None


WINNER_ROWS = [
    ('["Yes","No"]', '["0","1"]', ["Yes", "No"], "No"),
    ('["Yes","No"]', '["0.8","0.2"]', ["Yes", "No"], "Yes"),
    ('["A","B"]', '["0.9","0.95"]', ["A", "B"], "A"),
    ('["Yes","No"]', '["0.5","0.5"]', ["Yes", "No"], None),
    ("['Yes','No']", '["1"]', ["Yes", "No"], None),
    ('["Yes","No"]', '["x","1"]', ["Yes", "No"], None),
    ('["Yes",null]', '["1","0"]', [], None),
    ("oops", '["1","0"]', [], None),
    (None, '["1","0"]', [], None),
]


def test_outcomes_and_winner(spark):
    df = spark.createDataFrame([(o, p) for o, p, _, _ in WINNER_ROWS], "o string, p string")
    got = df.select(parsing.parse_string_list("o"), parsing.infer_winner("o", "p")).collect()
    for (o, p, lst, win), row in zip(WINNER_ROWS, got):
        assert (row[0], row[1]) == (lst, win), (o, p)


def test_parse_iso_datetime(spark):
    rows = [("2024-11-05T12:00:00Z",), ("2024-11-05 12:00:00+00",), ("2024-11-05T12:00:00-05:00",),
            ("2024-11-05",), ("junk",), ("2024",), ("T12:00",), (None,)]
    got = _one(spark, rows, "v string", parsing.parse_iso_datetime(F.col("v")))
    assert got[0] == dt.datetime(2024, 11, 5, 12) and got[1] == dt.datetime(2024, 11, 5, 12)
    assert got[2] == dt.datetime(2024, 11, 5, 17) and got[3] == dt.datetime(2024, 11, 5)
    assert got[4:] == [None, None, None, None]


def test_safe_int_and_tags(spark):
    got = _one(spark, [("2024",), (" 2024 ",), ("2024.0",), (None,)], "v string", parsing.safe_int(F.col("v")))
    assert got == [2024, 2024, None, None]
    got = _one(spark, [('["a","b"]',), ("a, b ,,c",), (None,)], "v string", parsing.normalize_tags(F.col("v")))
    assert got == [["a", "b"], ["a", "b", "c"], []]


OFFICE_ROWS = [
    ("vice president debate", "President"), ("VP pick", "Vice President"), ("vice-presidential", "Vice President"),
    ("state senate", "Senate"), ("state house", "State Legislature"), ("lieutenant governor", "Governor"),
    ("European Parliament", "Parliament"), ("White House", "President"), ("councilmember", "City Council"),
    ("attorney general", "Attorney General"), ("nothing", None), ("", None),
]


def test_office(spark):
    got = _one(spark, [(t,) for t, _ in OFFICE_ROWS], "t string", classify.infer_office(F.col("t")))
    assert got == [o for _, o in OFFICE_ROWS]


JURISDICTION_ROWS = [
    ("Pennsylvania primary", "Pennsylvania", "state"), ("West Virginia primary", "Virginia", "state"),
    ("Arkansas race", "Arkansas", "state"), ("PA-07 race", "Pennsylvania", "district"),
    ("PA 7", "Pennsylvania", "district"), ("Who wins in the Senate", "Indiana", "state"),
    ("Who is up\nSenate", "United States", "national"), ("U.S. Senate control", "United States", "national"),
    ("Ukraine vote", "United Kingdom", "national"), ("Milwaukee vote", "United Kingdom", "national"),
    ("Jerusalem vote", "United States", "national"), ("Scotland vote", "United Kingdom - Scotland", "subnational"),
    ("Mayor: London", "United Kingdom - London", "city"), ("Mayor: New York", "New York", "state"),
    ("parliament vote", "European Union", "supra-national"), ("something else", "Unclassified", "unknown"),
]


def test_jurisdiction(spark):
    got = _one(spark, [(t,) for t, _, _ in JURISDICTION_ROWS], "t string", classify.infer_jurisdiction(F.col("t")))
    assert [(r["name"], r["level"]) for r in got] == [(n, lv) for _, n, lv in JURISDICTION_ROWS]


def test_election_filters(spark):
    got = _one(spark, [([" Election "],), (["Politics"],), (["NFL", "President"],), (["US election"],), ([],), (None,)],
               "t array<string>", classify.is_election_by_tags(F.col("t")))
    assert got == [True, False, True, False, False, False]
    got = _one(spark, [("Household income",), ("weather",)], "t string",
               classify.is_election_event(F.col("t"), F.lit(None), F.lit(None), F.lit(None), F.lit(None)))
    assert got == [True, False]
    got = _one(spark, [("Will X win?",), ("Winter storm?",), ("D-nom?",)], "q string",
               classify.is_election_question(F.col("q")))
    assert got == [True, False, True]


def test_names_post_steps(spark):
    spans = ["Donald Trump", "trump", "DONALD TRUMP", "Senate Race", "Jr", '"Kamala  Harris".']
    got = _one(spark, [(spans,)], "s array<string>", names.candidate_names_from_spans(F.col("s")))
    assert got == [["Donald Trump", "Kamala Harris"]]


def test_feasibility(spark):
    rows = [([("a", "u", "d", "x", "f", "Medium", "n1"), ("b", "u", "d", "x", "f", "High", "n2"),
              ("c", "u", "d", "x", "f", "High", "n3")],), ([],)]
    df = spark.createDataFrame(rows, "s array<struct<name:string,url:string,description:string,access:string,"
                                     "update_frequency:string,feasibility:string,feasibility_notes:string>>")
    got = df.select(catalog.best_feasibility(F.col("s"))).collect()
    assert tuple(got[0][0]) == ("High", "n2")
    assert got[1][0][0] == "Unknown"
