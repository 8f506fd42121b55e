"""Jurisdiction tagging and the data-source catalog (C19-C24, A8, A9, J10,
J11, K6/K7 shapes).

Jurisdictions come from fixed vocabularies, so the catalog has a proven
size bound (a few hundred entries at most) however many markets there are;
it is built with one aggregation over the markets and joined back with a
broadcast. The per-jurisdiction source lists are literal expressions over
the seed values, not per-row Python.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab

SOURCE_FIELDS = ("name", "url", "description", "access", "update_frequency", "feasibility", "feasibility_notes")
SOURCE_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in SOURCE_FIELDS])
SOURCES_TYPE = T.ArrayType(SOURCE_TYPE)


def _source(values) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(f)
                      for f, v in zip(SOURCE_FIELDS, values)])


def _template(template, name: Column, url: Column | None = None) -> Column:
    """A source template with '{name}' / '{slug}' filled from a column."""
    slug = F.regexp_replace(name, " ", "_")

    def fill(text):
        if text is None:
            return url
        if "{name}" not in text and "{slug}" not in text:
            return F.lit(text)
        parts = []
        rest = text
        while rest:
            i_name, i_slug = rest.find("{name}"), rest.find("{slug}")
            hits = [(i, t) for i, t in ((i_name, "{name}"), (i_slug, "{slug}")) if i >= 0]
            if not hits:
                parts.append(F.lit(rest))
                break
            i, tok = min(hits)
            if i:
                parts.append(F.lit(rest[:i]))
            parts.append(name if tok == "{name}" else slug)
            rest = rest[i + len(tok):]
        return F.concat(*parts)

    return _source([fill(v) for v in template])


@lru_cache(maxsize=None)
def _library_map() -> Column:
    by_country: dict[str, list] = {}
    for row in vocab.COUNTRY_SOURCE_LIBRARY:
        by_country.setdefault(row[0], []).append(row[2:])
    pairs = []
    for country, sources in by_country.items():
        pairs += [F.lit(country), F.array(*[_source(s) for s in sources])]
    return F.create_map(*pairs)


@lru_cache(maxsize=None)
def _sites_map() -> Column:
    pairs = []
    for name, url in vocab.STATE_OFFICIAL_SITES:
        pairs += [F.lit(name), F.lit(url)]
    return F.create_map(*pairs)


_LIBRARY_LEVEL = {row[0]: row[1] for row in vocab.COUNTRY_SOURCE_LIBRARY}
_STATE_NAMES = sorted({n for _, n in vocab.US_DIVISIONS} | {n for n, _ in vocab.STATE_OFFICIAL_SITES})


@lru_cache(maxsize=None)
def _lib_level_map() -> Column:
    return F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in _LIBRARY_LEVEL.items()), []))


def state_sources(state: Column) -> Column:
    """Official office site (High) or directory fallback (Medium),
    encyclopedia page (Medium), results feed (High)."""
    site = _sites_map()[state]
    first = F.when(site.isNotNull(), _template(vocab.STATE_OFFICE_SOURCE, state, site)).otherwise(
        _template(vocab.STATE_DIRECTORY_SOURCE, state)
    )
    return F.array(first, _template(vocab.STATE_ENCYCLOPEDIA_SOURCE, state), _template(vocab.STATE_RESULTS_FEED_SOURCE, state))


def generic_sources(name: Column) -> Column:
    """Wire-service coverage (Medium) and local commission (Low)."""
    return F.array(_template(vocab.GENERIC_WIRE_SOURCE, name), _template(vocab.GENERIC_LOCAL_SOURCE, name))


def assessment(jurisdiction: Column, level: Column) -> Column:
    """struct(level, sources) — country library, else US state or
    territory, else 'United States - X' (city when it says City), else the
    generic pair."""
    lib = _library_map()[jurisdiction]
    is_state = jurisdiction.isin(*_STATE_NAMES)
    us_prefixed = jurisdiction.startswith("United States -")
    # the text after the first '-', trimmed
    us_rest = F.trim(F.regexp_extract(jurisdiction, r"(?s)^[^-]*-(.*)$", 1))
    lib_level = _lib_level_map()[jurisdiction]

    def st(lv, srcs):
        return F.struct(lv.alias("level"), srcs.cast(SOURCES_TYPE).alias("sources"))

    return (
        F.when(lib.isNotNull(), st(lib_level, lib))
        .when(is_state, st(level, state_sources(jurisdiction)))
        .when(
            us_prefixed,
            st(F.when(jurisdiction.contains("City"), F.lit("city")).otherwise(F.lit("state")), state_sources(us_rest)),
        )
        .otherwise(st(level, generic_sources(jurisdiction)))
    )


def best_feasibility(sources: Column) -> Column:
    """struct(rating, note) of the best-rated source, the first on ties;
    no sources -> Unknown with the fixed note."""
    score_map = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in vocab.FEASIBILITY_ORDER), []))
    init = F.struct(F.lit(-1).alias("score"), F.lit(None).cast("string").alias("rating"),
                    F.lit(None).cast("string").alias("note"))

    def merge(acc, s):
        score = F.coalesce(score_map[s["feasibility"]], F.lit(0))
        return F.when(score > acc["score"], F.struct(score.alias("score"), s["feasibility"].alias("rating"),
                                                      s["feasibility_notes"].alias("note"))).otherwise(acc)

    best = F.aggregate(sources, init, merge)
    unknown, note = vocab.NO_SOURCES_FEASIBILITY
    return F.when(
        F.coalesce(F.size(sources), F.lit(0)) <= 0,
        F.struct(F.lit(unknown).alias("rating"), F.lit(note).alias("note")),
    ).otherwise(F.struct(best["rating"].alias("rating"), best["note"].alias("note")))


@lru_cache(maxsize=None)
def _assessment_of(jurisdiction_col: str, level_col: str) -> Column:
    # expressions over fixed column names are built once per process
    return assessment(F.col(jurisdiction_col), F.col(level_col))


@lru_cache(maxsize=None)
def _best_of(sources_col: str) -> Column:
    return best_feasibility(F.col(sources_col))


def build_catalog(tagged: DataFrame, order_col: str = "market_id") -> DataFrame:
    """One catalog entry per jurisdiction; the level of the first
    record (by ``order_col``) fixes a state's entry level (Q26).

    Columns: jurisdiction, level, sources, feasibility, feasibility_notes."""
    # a total order: numeric ids as numbers, before others, then the level itself
    number = F.col(order_col).cast("string").try_cast("decimal(38,0)")
    order = F.struct(number.isNull(), number, F.col(order_col), F.col("jurisdiction_level"))
    first = tagged.groupBy("jurisdiction").agg(F.min_by("jurisdiction_level", order).alias("_lvl"))
    a = first.select("jurisdiction", _assessment_of("jurisdiction", "_lvl").alias("_a"))
    best = _best_of("_a.sources")
    return a.select(
        "jurisdiction", F.col("_a.level").alias("level"), F.col("_a.sources").alias("sources"),
        best["rating"].alias("feasibility"), best["note"].alias("feasibility_notes"),
    )


def with_sources(tagged: DataFrame) -> DataFrame:
    """J10 without a join: each record's source names and aggregate rating,
    derived from its jurisdiction (they do not depend on the level)."""
    a = _assessment_of("jurisdiction", "jurisdiction_level")
    staged = tagged.select("*", a["sources"].alias("_asrc"))
    return staged.select(
        *[F.col(c) for c in tagged.columns],
        F.transform("_asrc", lambda s: s["name"]).alias("jurisdiction_sources"),
        _best_of("_asrc")["rating"].alias("jurisdiction_feasibility"),
    )


def explode_catalog(catalog: DataFrame, with_best: bool = False) -> DataFrame:
    """K6 shape: one row per (jurisdiction, source); ``with_best`` adds the
    jurisdiction's aggregate rating and note."""
    extra = [F.col("feasibility").alias("jurisdiction_feasibility"),
             F.col("feasibility_notes").alias("jurisdiction_feasibility_notes")] if with_best else []
    rows = catalog.select("jurisdiction", "level", *extra, F.explode("sources").alias("s"))
    return rows.select(
        "jurisdiction", "level", F.col("s.name").alias("source_name"), F.col("s.url").alias("url"),
        F.col("s.description").alias("description"), F.col("s.access").alias("access"),
        F.col("s.update_frequency").alias("update_frequency"), F.col("s.feasibility").alias("feasibility"),
        F.col("s.feasibility_notes").alias("feasibility_notes"),
        *[F.col(c) for c in ("jurisdiction_feasibility", "jurisdiction_feasibility_notes") if with_best],
    )
