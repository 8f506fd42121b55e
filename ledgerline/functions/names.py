"""Person-name extraction columns.

The original finds person spans with a statistical tagger, then cleans,
tokenises, filters and deduplicates them. Here spans are the names of a
candidate dimension (``name_automaton``); a text without any is left to a
pluggable ``Column -> array<string>`` function (default: runs of
capitalised words). Every step after it reproduces the original rules,
as higher-order array expressions evaluated per row.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .name_automaton import known_spans
from .regex import NON_WORD_CLASS, SPACE_CLASS
from .text import first_spelling

SpanFinder = Callable[[Column], Column]

_CAP_WORD = r"[A-Z][A-Za-z'.-]*"
# a run starts where the previous character is not an ASCII word character
CAPITALISED_RUN = rf"(?<![A-Za-z0-9_]){_CAP_WORD}(?: +{_CAP_WORD})*"


def capitalised_runs(text: Column) -> Column:
    """Default span finder: maximal runs of capitalised words."""
    return F.regexp_extract_all(text, F.lit(CAPITALISED_RUN), 0)


def clean_name(span: Column) -> Column:
    """Whitespace runs -> one space, trimmed; then the edge characters
    . , ; : " ' ( ) [ ] { } stripped from both ends."""
    collapsed = F.regexp_replace(F.regexp_replace(span, rf"{SPACE_CLASS}+", " "), r"^ | $", "")
    edge = "[" + re.escape(vocab.NAME_EDGE_CHARACTERS) + "]"
    return F.regexp_replace(collapsed, rf"^{edge}+|{edge}+$", "")


def name_tokens(name: Column) -> Column:
    """ASCII word-like tokens of a name."""
    return F.regexp_extract_all(name, F.lit(vocab.NAME_TOKEN_PATTERN), 0)


@lru_cache(maxsize=None)
def _word_arrays() -> tuple[Column, Column]:
    return (F.array(*[F.lit(t) for t in vocab.PERSON_SUFFIX_TOKENS]),
            F.array(*[F.lit(t) for t in vocab.PERSON_EXCLUSION_TOKENS]))


def is_plausible(tokens: Column) -> Column:
    """at least one token that is not a generation suffix, and none of
    those tokens an excluded word."""
    suffixes, excluded_words = _word_arrays()
    meaningful = F.array_except(F.transform(tokens, lambda t: F.lower(t)), suffixes)
    return (F.size(meaningful) > 0) & ~F.arrays_overlap(meaningful, excluded_words)


# characters that end a word wherever they stand
_WORD_ENDS = r"\s,;:@#$%&?!\"()\[\]{}<>'`"


def needs_title_variant(text: Column) -> Column:
    """Among the words there are alphabetic ones, and all of these are
    lower-case. Words with other characters (u.s., well-known, 24th) don't count."""
    found = F.regexp_extract_all(F.regexp_replace(text, r"\.\s*$", ""), F.lit(f"[^{_WORD_ENDS}]+"), 0)
    alphabetic = F.filter(found, lambda w: w.rlike(r"^\p{L}+$"))
    return (F.size(alphabetic) > 0) & F.forall(alphabetic, lambda w: (w == F.lower(w)) & (w != F.upper(w)))


def capwords(text: Column) -> Column:
    """Python ``string.capwords``: words split on whitespace, capitalised,
    joined by one space."""
    collapsed = F.regexp_replace(F.regexp_replace(text, rf"{SPACE_CLASS}+", " "), r"^ | $", "")
    return F.initcap(collapsed)


def text_variants(text: Column) -> Column:
    """The text, plus its capitalised form when it is all lower-case."""
    title = capwords(text)
    return F.when(needs_title_variant(text) & (title != text), F.array(text, title)).otherwise(F.array(text))


def drop_subsumed_single_names(names: Column) -> Column:
    """drop a one-token name whose token belongs to a multi-token name."""
    tokenised = F.transform(names, lambda n: F.struct(n.alias("n"), name_tokens(n).alias("t")))

    def keep(entries):
        multi = F.transform(
            F.flatten(F.transform(F.filter(entries, lambda e: F.size(e["t"]) > 1), lambda e: e["t"])),
            lambda t: F.lower(t),
        )
        single = F.filter(
            entries,
            lambda e: ~((F.size(e["t"]) == 1) & F.array_contains(multi, F.lower(F.get(e["t"], 0)))),
        )
        return F.transform(single, lambda e: e["n"])

    return keep(tokenised)


def candidate_names_from_spans(spans: Column) -> Column:
    """C6 -> C7 -> F14 -> A10 -> F15 over already-found spans, order kept."""
    cleaned = F.filter(F.transform(spans, clean_name), lambda s: s != F.lit(""))
    plausible = F.filter(cleaned, lambda s: is_plausible(name_tokens(s)))
    return drop_subsumed_single_names(first_spelling(plausible))


def searched_texts(texts: Column) -> Column:
    """The texts as they are searched: empty ones are skipped; each as written
    and, when its words are all lower-case, also in capitalised form."""
    kept = F.filter(texts, lambda t: t.isNotNull() & (t != ""))
    return F.flatten(F.transform(kept, text_variants))


def extract_candidate_names(texts: Column, finder: SpanFinder = capitalised_runs) -> Column:
    """Person names from an array of texts (tags, then notes)."""
    return candidate_names_from_spans(F.flatten(F.transform(searched_texts(texts), finder)))


def with_candidate_names(df: DataFrame, texts: Column, known: DataFrame | None = None, finder: SpanFinder = capitalised_runs) -> DataFrame:
    """``df`` with ``candidate_names``. In each text the names of ``known``
    (column ``name``) are looked up; ``finder`` serves texts that have none."""
    if known is None:
        return df.withColumn("candidate_names", extract_candidate_names(texts, finder))
    searched = known_spans(df.withColumn("_searched", searched_texts(texts)), "_searched", known, "_known")
    spans = F.zip_with("_searched", "_known", lambda text, found: F.when(F.size(found) > 0, found).otherwise(finder(text)))
    return searched.withColumn("candidate_names", candidate_names_from_spans(F.flatten(spans))).drop("_searched", "_known")


__all__ = [
    "capitalised_runs",
    "clean_name",
    "name_tokens",
    "is_plausible",
    "text_variants",
    "drop_subsumed_single_names",
    "candidate_names_from_spans",
    "searched_texts",
    "extract_candidate_names",
    "with_candidate_names",
    "NON_WORD_CLASS",
]
