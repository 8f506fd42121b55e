"""Market value parsing columns (C10-C17), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import py_strip



def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_DIGITS = r"\d+(?:_\d+)*"
# a number as Python's float() reads it, without the outer white space
_NUMBER = rf"^[+-]?(?:inf|infinity|nan|(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?)$"


def parse_float(value) -> Column:
    """NULL / '' / 'null' / unparsable -> NULL; 'inf', '+nan', '1_000'
    and surrounding spaces accepted, like Python float(). The whole text is
    held against the number grammar before it is cast."""
    text = F.lower(py_strip(_col(value)))
    plain = F.regexp_replace(F.regexp_replace(text, "_", ""), r"^[+-](?=nan)", "")
    return F.when(text.rlike(_NUMBER), plain.try_cast("double"))


_QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
_ITEM = rf"(?:{_QUOTED}|[+-]?(?:\d[\d_]*\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
# the whole text of a list of quoted texts and numbers; nothing before or
# after it, and no bare words
_LIST = rf"^\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?\]\s*$"


def _list_items(text: Column) -> Column:
    """array<string> of a list text, NULL where the text is no such list."""
    closed = F.regexp_replace(text, r",\s*\]\s*$", "]")
    return F.when(text.rlike(_LIST), F.from_json(closed, "array<string>"))


def parse_string_list(value) -> Column:
    """C11: list text (JSON or Python quotes) -> array<string>; anything
    else, or a list holding a null, -> []."""
    arr = _list_items(_col(value))
    # a list holding a null is not a Python literal list of strings
    has_null = F.size(F.array_compact(arr)) != F.size(arr)
    return F.when(arr.isNull() | has_null, F.array().cast("array<string>")).otherwise(arr)


def infer_winner(outcomes_text, prices_text) -> Column:
    """The first outcome whose price is >= 0.8.

    NULL when either list is unparsable or empty, the lengths differ, any
    price is not a number, or no price reaches the threshold."""
    outcomes = _list_items(_col(outcomes_text))
    prices = F.transform(_list_items(_col(prices_text)), lambda p: parse_float(p))
    pairs = F.zip_with(outcomes, prices, lambda o, p: F.struct(o.alias("o"), p.alias("p")))
    hits = F.filter(pairs, lambda x: (x["p"] >= F.lit(vocab.WINNER_PRICE_THRESHOLD)) & ~F.isnan(x["p"]))
    valid = (
        outcomes.isNotNull()
        & prices.isNotNull()
        & (F.size(outcomes) > 0)
        & (F.size(outcomes) == F.size(prices))
        & (F.size(F.array_compact(prices)) == F.size(prices))
        & (F.size(F.array_compact(outcomes)) == F.size(outcomes))
    )
    return F.when(valid, F.get(hits, 0)["o"])


# ISO 8601 as Python's datetime.fromisoformat reads it: extended or basic
# date, any one separator character, hours with optional minutes, seconds
# and a fraction ('.' or ','), an optional +-HH[:MM[:SS[.f]]] offset.
_ISO_GRAMMAR = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d{1,9}))?)?)?)?"
    r"(?:([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d{1,6})?)?)?)?$"
)


_WEEK_DATE = r"^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?(.*)$"


def _week_date_to_calendar(v: Column) -> Column:
    """ISO week dates (YYYY-Www[-D], basic YYYYWww[D]) -> YYYY-MM-DD: the
    Monday of week 1 is the Monday on or before 4 January."""
    y = F.regexp_extract(v, _WEEK_DATE, 1).try_cast("int")
    w = F.regexp_extract(v, _WEEK_DATE, 3).try_cast("int")
    d = F.coalesce(F.nullif(F.regexp_extract(v, _WEEK_DATE, 4), F.lit("")).try_cast("int"), F.lit(1))
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    day = F.date_add(F.date_sub(jan4, F.weekday(jan4)), (w - 1) * 7 + (d - 1))
    is_week = v.rlike(_WEEK_DATE) & (w >= 1) & (w <= 53)
    return F.when(is_week, F.concat(F.date_format(day, "yyyy-MM-dd"), F.regexp_extract(v, _WEEK_DATE, 5))).otherwise(v)


def _iso_group(v: Column, i: int) -> Column:
    return F.nullif(F.regexp_extract(v, _ISO_GRAMMAR, i), F.lit(""))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable,
    so a body that reads it many times does not copy its expression."""
    return F.get(F.transform(F.array(value), body), 0)


def _assemble_iso(v: Column) -> Column:
    y, mo, d = _iso_group(v, 1), _iso_group(v, 3), _iso_group(v, 4)
    h, mi, sec, frac = _iso_group(v, 5), _iso_group(v, 7), _iso_group(v, 8), _iso_group(v, 9)
    sign, oh, om, osec = _iso_group(v, 10), _iso_group(v, 11), _iso_group(v, 12), _iso_group(v, 13)
    fraction = F.when(frac.isNotNull(), F.concat(F.lit("."), F.substring(frac, 1, 6))).otherwise(F.lit(""))
    offset = F.when(sign.isNotNull(), F.concat(sign, oh, F.lit(":"), F.coalesce(om, F.lit("00")))).otherwise(
        F.lit("+00:00"))
    canonical = F.concat(
        y, F.lit("-"), mo, F.lit("-"), d, F.lit("T"), F.coalesce(h, F.lit("00")), F.lit(":"),
        F.coalesce(mi, F.lit("00")), F.lit(":"), F.coalesce(sec, F.lit("00")), fraction, offset,
    )
    ts = F.try_to_timestamp(canonical)
    # an offset with seconds moves the instant by those seconds as well
    shift = F.when(sign.isNotNull() & osec.isNotNull(),
                   F.when(sign == "-", -1).otherwise(1) * osec.try_cast("int"))
    return F.when(shift.isNull(), ts).otherwise(ts - F.make_interval(secs=shift))


def parse_iso_datetime(value) -> Column:
    """ISO-like text -> UTC timestamp; anything else NULL.

    Trimmed; 'Z' means +00:00; a space separates date and time; '+HH' is
    read as '+HH:00'; then the ISO grammar Python accepts (extended or basic
    date, week dates, any separator, fractions, offsets with seconds). The
    parts are reassembled with an explicit offset (text without one is UTC,
    Q21), so the result does not depend on the session time zone.

    (A space is replaced even when the text also holds a 'T': such text is
    invalid either way.)"""
    v = F.regexp_replace(F.regexp_replace(py_strip(_col(value)), "Z$", "+00:00"), " ", "T")
    v = F.regexp_replace(v, r"(\+\d{2})$", "$1:00")
    return _let(v, lambda x: _let(_week_date_to_calendar(x), _assemble_iso))


def first_timestamp(*values) -> Column:
    """C14: the first parsable of several timestamp texts."""
    return F.coalesce(*[parse_iso_datetime(v) for v in values])


def iso_text(ts) -> Column:
    """Python ``datetime.isoformat()`` of a UTC timestamp: seconds, then
    microseconds only when non-zero, then '+00:00'."""
    total = F.unix_micros(_col(ts))
    second = F.floor(total / F.lit(1000000)).cast("long")
    micros = F.pmod(total, F.lit(1000000))
    of_day = F.pmod(second, F.lit(86400))
    day = F.date_from_unix_date(((second - of_day) / 86400).cast("int"))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(of_day / 3600)), two(F.floor(of_day / 60) % 60), two(of_day % 60))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(day.cast("string"), F.lit("T"), clock, frac, F.lit("+00:00"))


_DATE_FORMS = ("yyyy/M/d", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm",
               "MMM d yyyy", "MMM d yyyy H:mm:ss", "MMM d yyyy H:mm", "d MMM yyyy", "d MMM yyyy H:mm:ss", "MMM yyyy")


def lenient_timestamp(value) -> Column:
    """Lenient parse of a market start/end value; unparsable -> NULL.

    ISO texts as in C13 (so compact dates too), then dates with slashes and
    with month names, day or month first as written; text without an offset is
    UTC, whatever the session's zone is."""
    v = py_strip(_col(value).cast("string"))
    spaced = F.regexp_replace(F.initcap(F.regexp_replace(v, r"[,\s]+", " ")), r"(?<=^| )(Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]+(?= |$)", "$1")
    dates = [F.try_to_timestamp(F.concat(spaced, F.lit(" +00:00")), F.lit(f"{form} XXX")) for form in _DATE_FORMS]
    return F.coalesce(parse_iso_datetime(v), *dates)


def safe_int(value) -> Column:
    """Integer text -> int, anything else (including '2024.0') NULL."""
    v = py_strip(_col(value).cast("string"))
    return F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast("int"))


def normalize_tags(value) -> Column:
    """C17: tags given as a JSON list -> its strings; as text -> comma split,
    trimmed, empties dropped; NULL -> []."""
    v = _col(value)
    as_list = F.from_json(v, "array<string>")
    as_text = F.filter(F.transform(F.split(v, ","), lambda t: py_strip(t)), lambda t: t != F.lit(""))
    listed = F.filter(as_list, lambda t: t.isNotNull())
    return (
        F.when(v.isNull(), F.array().cast("array<string>"))
        .when(py_strip(v).startswith("[") & as_list.isNotNull(), listed)
        .otherwise(as_text)
    )
