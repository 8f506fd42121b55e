"""Name and query text columns (Column -> Column).

C1 normalize_text, C2 strip_punctuation, C3 name parts, C4 search pattern,
C5 lookup queries. Everything is a built-in expression except Unicode NFKD,
which Spark has no function for; that one runs as an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocab
from .regex import NON_WORD_CLASS, SPACE_CLASS, WORD_CLASS

_PY_SPACES = re.compile(r"\s+")


@F.pandas_udf(T.StringType())
def _nfkd_upper(values: pd.Series) -> pd.Series:
    # NFKD, then upper-case, collapse whitespace runs, strip: one Arrow pass.
    def one(v):
        if v is None:
            return None
        return _PY_SPACES.sub(" ", unicodedata.normalize("NFKD", v).upper()).strip()

    return values.map(one, na_action="ignore")


_ASCII_SPACE_RUN = r"[\s\x1c-\x1f]+"


def normalize_text(col: Column | str) -> Column:
    """NULL stays NULL; NFKD; upper-case; whitespace runs -> one space; trim.

    NFKD leaves ASCII unchanged, so ASCII values take a built-in path and
    only the others are sent (Arrow-batched) to Python; ASCII rows reach the
    UDF as NULL and cost next to nothing."""
    c = F.col(col) if isinstance(col, str) else col
    non_ascii = c.rlike(r"[^\x00-\x7F]")
    ascii_path = F.regexp_replace(F.regexp_replace(F.upper(c), _ASCII_SPACE_RUN, " "), r"^ | $", "")
    return F.coalesce(_nfkd_upper(F.when(non_ascii, c)), F.when(~non_ascii, ascii_path))


def strip_punctuation(col: Column | str) -> Column:
    """Every character that is neither a word character nor a space -> space."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}_{SPACE_CLASS[1:-1]}]", " ")


def py_strip(col: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(col, rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def py_split_words(col: Column) -> Column:
    """Python ``str.split()``: whitespace runs separate words, no empty words."""
    return F.filter(F.split(col, rf"{SPACE_CLASS}+"), lambda t: t != F.lit(""))


def _tokens(part: Column) -> Column:
    # parts come from C1 output: only single spaces remain, ends already trimmed
    return F.array_remove(F.split(part, " "), "")


def _comma_parts(norm: Column) -> Column:
    """``[p.strip() for p in norm.split(",")]`` on C1 output (single spaces,
    no outer spaces): a comma takes at most one space on each side."""
    return F.split(norm, " ?, ?")


def normalize_query(col: Column | str) -> Column:
    """C4: commas -> spaces, words joined by '%' and wrapped in '%'; no words -> '%'.

    User '%' and '_' stay wildcards, as in the original."""
    c = F.col(col) if isinstance(col, str) else col
    words = py_split_words(F.regexp_replace(c, ",", " "))
    return F.when(c.isNull(), F.lit(None)).when(
        F.size(words) == 0, F.lit("%")
    ).otherwise(F.concat(F.lit("%"), F.array_join(words, "%"), F.lit("%")))


def first_spelling(arr: Column) -> Column:
    """Keep the first spelling of each case-insensitive value, order kept
    (A10/A11). One left fold, so ``arr`` is evaluated once."""
    init = F.struct(
        F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out")
    )

    def step(acc, x):
        key = F.lower(x)
        return F.when(F.array_contains(acc["seen"], key), acc).otherwise(
            F.struct(F.array_append(acc["seen"], key).alias("seen"), F.array_append(acc["out"], x).alias("out"))
        )

    return F.aggregate(arr, init, step, lambda acc: acc["out"])


def extract_queries(col: Column | str) -> Column:
    """Lookup queries for a candidate-names cell.

    Blank / nan / none / null -> []. Otherwise the whole text, then each part
    split on '|' or ',', stripped; first spelling per lower-cased value.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = py_strip(c)
    blank = text.isNull() | (text == "") | F.lower(text).isin(*vocab.EMPTY_NAME_MARKERS)
    parts = F.filter(F.transform(F.split(text, r"[|,]"), py_strip), lambda p: p != F.lit(""))
    ordered = F.concat(F.array(text), parts)
    return F.when(blank, F.array().cast("array<string>")).otherwise(first_spelling(ordered))


__all__ = [
    "normalize_text",
    "strip_punctuation",
    "py_strip",
    "py_split_words",
    "normalize_query",
    "first_spelling",
    "extract_queries",
    "WORD_CLASS",
    "NON_WORD_CLASS",
]


def add_name_parts(df, norm_col: str = "normalized_name", names=("first_name", "middle_name", "last_name",
                                                                 "prefix", "suffix")):
    """C3 as staged projections over a DataFrame: the intermediate token
    arrays become columns, so each is computed once and the generated code
    stays small (the single-expression form repeats them in every branch).
    Adds the five name-part columns."""
    n = F.col(norm_col)
    keep = [F.col(c) for c in df.columns]
    s = df.select(*keep, _comma_parts(n).alias("_np_parts"))
    s = s.select("*", _tokens(F.get(F.col("_np_parts"), 0)).alias("_np_toks"),
                 _tokens(F.get(F.col("_np_parts"), 1)).alias("_np_rest"))
    rest = F.col("_np_rest")
    s = s.select("*", ((F.size(rest) > 0) & F.get(rest, 0).isin(*vocab.NAME_PREFIXES)).alias("_np_pre"))
    s = s.select("*", F.when(F.col("_np_pre"), F.slice(rest, 2, F.greatest(F.size(rest) - 1, F.lit(0))))
                 .otherwise(rest).alias("_np_rest2"))
    rest2 = F.col("_np_rest2")
    n2 = F.size(rest2)
    s = s.select("*", ((n2 > 0) & F.get(rest2, n2 - 1).isin(*vocab.NAME_SUFFIXES)).alias("_np_suf"))
    s = s.select("*", F.when(F.col("_np_suf"), F.slice(rest2, 1, F.greatest(n2 - 1, F.lit(0))))
                 .otherwise(rest2).alias("_np_rest3"))
    parts, toks, rest3 = F.col("_np_parts"), F.col("_np_toks"), F.col("_np_rest3")
    one = F.size(parts) == 1
    nt, n3 = F.size(toks), F.size(rest3)
    valid = n.isNotNull()
    first = F.when(one, F.get(toks, 0)).otherwise(F.get(rest2, 0))
    middle = F.when(one, F.when(nt > 2, F.array_join(F.slice(toks, 2, F.greatest(nt - 2, F.lit(1))), " "))).otherwise(
        F.when(n3 > 1, F.array_join(F.slice(rest3, 2, F.greatest(n3 - 1, F.lit(1))), " ")))
    last = F.when(one, F.when(nt > 1, F.get(toks, nt - 1))).otherwise(
        F.when(F.get(parts, 0) != F.lit(""), F.get(parts, 0)))
    prefix = F.when(~one & F.col("_np_pre"), F.get(rest, 0))
    suffix = F.when(~one & F.col("_np_suf"), F.get(rest2, n2 - 1))
    out = [F.when(valid, e).alias(a) for e, a in zip((first, middle, last, prefix, suffix), names)]
    return s.select(*keep, *out)
