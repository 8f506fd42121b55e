"""Market classification columns: election filters (F3-F5), office (C18),
US state / district (C19) and jurisdiction (C20).

Rules that take "the first match" follow list order, not text position, so
they are ordered ``CASE WHEN`` chains. Regexes are the original Python
patterns rewritten by rule into Java syntax with Python's Unicode meaning
of word boundaries, spaces and digits (see ``regex.py``).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .regex import SPACE_CLASS, WORD_CLASS, any_of, required_literal, trie_alternation
from .text import py_strip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_nonempty(*parts) -> Column:
    """``' '.join(p for p in parts if p)``: NULL and '' parts are skipped."""
    return F.concat_ws(" ", *[F.nullif(_col(p), F.lit("")) for p in parts])


def election_event_text(title, description, ticker, slug, category) -> Column:
    """Lower-cased text of the non-empty event fields, joined by spaces."""
    return F.lower(join_nonempty(title, description, ticker, slug, category))


def mentions_election_word(hay: Column) -> Column:
    """F3 on a materialised lower-case text column: any election word occurs
    as a substring."""
    cond = None
    for w in vocab.ELECTION_KEYWORDS:
        cond = hay.contains(w) if cond is None else cond | hay.contains(w)
    return F.coalesce(cond, F.lit(False))


def is_election_event(title, description, ticker, slug, category) -> Column:
    """any election word occurs as a substring of the lower-cased text
    of the non-empty fields, joined by spaces."""
    return mentions_election_word(election_event_text(title, description, ticker, slug, category))


@lru_cache(maxsize=None)
def _literal_array(values: tuple) -> Column:
    return F.array(*[F.lit(v) for v in values])


def is_election_question(question, low: Column | None = None) -> Column:
    """any of the question patterns matches (case-insensitive).
    ``low``: the question lower-cased, when already a column."""
    q = _col(question)
    low = F.lower(q) if low is None else low
    return F.coalesce(_prechecked(low, q, vocab.QUESTION_PATTERNS, "(?i)"), F.lit(False))


def _prechecked(low: Column, text: Column, patterns, flags: str = "") -> Column:
    """``text rlike any(patterns)``, evaluated only when the lower-cased text
    contains one of the literals the patterns require (a cheap scan)."""
    literals = sorted({required_literal(p) for p in patterns})
    if any(not lit for lit in literals):
        return text.rlike(flags + any_of(patterns))
    pre = None
    for lit in literals:
        c = low.contains(lit)
        pre = c if pre is None else pre | c
    return F.when(pre, text.rlike(flags + any_of(patterns))).otherwise(F.lit(False))


def is_election_by_tags(tags) -> Column:
    """some trimmed, lower-cased tag equals an election tag.

    The original also checks a list of other-domain tags, but both of its
    branches return the same test, so that list changes nothing."""
    lowered = F.transform(F.filter(_col(tags), lambda t: t.isNotNull() & (t != "")), lambda t: F.lower(py_strip(t)))
    return F.coalesce(F.arrays_overlap(lowered, _literal_array(vocab.ELECTION_TAGS)), F.lit(False))


def infer_office(text, lowered: bool = False) -> Column:
    """The first office (in priority order) with a matching pattern in
    the lower-cased text; a 'House' hit does not count when the text
    mentions 'white house'. Empty text -> NULL.

    Pass an already lower-cased *column* with ``lowered=True``: the text is
    referenced by every pattern, and a column reference is not recomputed."""
    t = _col(text) if lowered else F.lower(_col(text))
    expr = None
    for office, patterns in vocab.OFFICE_PATTERNS:
        cond = _prechecked(t, t, patterns)
        if office == "House":
            cond = cond & ~t.contains(vocab.HOUSE_EXCEPTION_PHRASE)
        expr = F.when(cond, F.lit(office)) if expr is None else expr.when(cond, F.lit(office))
    return F.when((t.isNotNull()) & (t != ""), expr)




@lru_cache(maxsize=None)
def _abbr_map() -> Column:
    pairs = []
    for a, n in vocab.US_DIVISIONS:
        pairs += [F.lit(a), F.lit(n)]
    return F.create_map(*pairs)


def _abbr_to_state(abbr: Column) -> Column:
    return _abbr_map()[abbr]


_W = WORD_CLASS
_NW = f"(?<!{_W})"
_EW = f"(?!{_W})"
# (b) district code such as PA-07 or PA 7, case-sensitive, first occurrence
DISTRICT_RE = rf"(?d){_NW}([A-Z]{{2}})[-– ]?(\p{{Nd}}{{1,2}}){_EW}"
# (c)/(d) two letters followed later on the same line by senate / governor
SENATE_RE = rf"(?di){_NW}([A-Z]{{2}}){_EW}.*{_NW}senate{_EW}"
GOVERNOR_RE = rf"(?di){_NW}([A-Z]{{2}}){_EW}.*{_NW}governor"


_STATE_NAMES_LOWER = [n.lower() for _, n in vocab.US_DIVISIONS]
# every position where some state name starts as a whole word; a zero-width
# match per position, so names inside longer names are found too
STATE_NAME_SCAN = "(?=" + _NW + "(" + trie_alternation(_STATE_NAMES_LOWER) + ")" + _EW + ")"


@lru_cache(maxsize=None)
def _state_lists() -> tuple[Column, Column]:
    names = [n for _, n in vocab.US_DIVISIONS]
    lower_in_order = F.array(*[F.lit(n.lower()) for n in names])
    proper = F.create_map(*sum(([F.lit(n.lower()), F.lit(n)] for n in names), []))
    return lower_in_order, proper


def _first_state_in_list_order(hits: Column) -> Column:
    """The hit that comes first in the division list (not in the text).

    ``array_intersect`` keeps the order of its first argument, so no
    per-element lambda is needed (lambdas are not compiled)."""
    lower_in_order, proper = _state_lists()
    return proper[F.get(F.array_intersect(lower_in_order, hits), 0)]


def _st(name: Column, level: str) -> Column:
    return F.struct(name.cast("string").alias("name"), F.lit(level).alias("level"))


def state_parts(text, low: Column | None = None) -> Column:
    """The four C19 rules evaluated side by side:
    struct(by_name, district, senate, governor), each a state name or NULL."""
    t = _col(text)
    low = F.lower(t) if low is None else low
    hits = F.regexp_extract_all(low, F.lit(STATE_NAME_SCAN), 1)
    # the two-letter rules scan to the end of each line from every two-letter
    # word; skip them unless the keyword occurs at all
    senate = F.when(low.contains("senate"), F.nullif(F.regexp_extract(t, SENATE_RE, 1), F.lit("")))
    governor = F.when(low.contains("governor"), F.nullif(F.regexp_extract(t, GOVERNOR_RE, 1), F.lit("")))
    return F.struct(
        _first_state_in_list_order(hits).alias("by_name"),
        _abbr_to_state(F.nullif(F.regexp_extract(t, DISTRICT_RE, 1), F.lit(""))).alias("district"),
        _abbr_to_state(F.upper(senate)).alias("senate"),
        _abbr_to_state(F.upper(governor)).alias("governor"),
    )


def state_from_parts(p: Column) -> Column:
    """C19 priority over ``state_parts``: name, district, senate, governor."""
    return (
        F.when(p["by_name"].isNotNull(), _st(p["by_name"], "state"))
        .when(p["district"].isNotNull(), _st(p["district"], "district"))
        .when(p["senate"].isNotNull(), _st(p["senate"], "state"))
        .when(p["governor"].isNotNull(), _st(p["governor"], "state"))
    )


def match_us_state(text, low: Column | None = None) -> Column:
    """struct(name, level) of a US state reference, or NULL.

    (a) the first state name in list order found as a whole word (lower
    case); (b) the first district code, if its letters are a known state;
    (c) two letters before 'senate' on one line; (d) two letters before
    'governor' on one line. (c) and (d) ignore case."""
    return state_from_parts(state_parts(text, low))


def country_keyword(low: Column) -> Column:
    """struct(name, level) of the first country keyword (list order) found
    as a substring of ``low`` (a materialised lower-case column), or NULLs."""
    expr = None
    for keyword, name, level in vocab.COUNTRY_KEYWORDS:
        hit = F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"))
        cond = low.contains(keyword)
        expr = F.when(cond, hit) if expr is None else expr.when(cond, hit)
    return expr.otherwise(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("level")))


def jurisdiction_parts(text, low: Column | None = None) -> Column:
    """All C20 candidates side by side (each computed once): the C19 parts,
    the first country keyword and the fallback tests."""
    t = _col(text)
    low = F.lower(t) if low is None else low
    mayor = low.contains("mayor")
    return F.struct(
        (t.isNull() | (t == "")).alias("empty"),
        state_parts(t, low).alias("state"),
        country_keyword(low).alias("country"),
        (mayor & (low.contains("london"))).alias("london"),
        (mayor & (low.contains("new york"))).alias("nyc"),
        ((low.contains("senate")) | (low.contains("house")) | (low.contains("congress"))).alias("us"),
        (low.contains("parliament")).alias("eu"),
    )


def jurisdiction_from_parts(p: Column) -> Column:
    """C20 priority over ``jurisdiction_parts``."""

    def lit_st(name, level):
        return F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"))

    unclassified = lit_st(*vocab.UNCLASSIFIED)
    state = state_from_parts(p["state"])
    return (
        F.when(p["empty"], unclassified)
        .when(state.isNotNull(), state)
        .when(p["country"]["name"].isNotNull(), p["country"])
        .when(p["london"], lit_st("United Kingdom - London", "city"))
        .when(p["nyc"], lit_st("United States - New York City", "city"))
        .when(p["us"], lit_st("United States", "national"))
        .when(p["eu"], lit_st("European Union", "supra-national"))
        .otherwise(unclassified)
    )


def infer_jurisdiction(text, low: Column | None = None) -> Column:
    """C20: struct(name, level) for a market's text blob.

    US state (C19); else the first country keyword (list order) occurring
    as a substring; else London / New York mayoral races; else senate,
    house or congress -> United States; parliament -> European Union;
    else Unclassified. (Jobs stage ``jurisdiction_parts`` into a column
    first; see ``operators.markets.with_jurisdiction``.)"""
    return jurisdiction_from_parts(jurisdiction_parts(text, low))


__all__ = [
    "join_nonempty",
    "is_election_event",
    "is_election_question",
    "is_election_by_tags",
    "infer_office",
    "match_us_state",
    "infer_jurisdiction",
    "SPACE_CLASS",
]
