"""Market -> candidate linkage (X8: C4, C5, J8, J9, F11-F13, A11, A12, P18).

The original ran one name search per distinct query text (a subprocess
and a database ILIKE scan each) and looped over market rows. Here it is
set-based:

1. markets reduce to distinct *match keys* (names text, office, start
   year, end year) — equal keys get equal matches, so work is done once
   per key (a set-based memo), and the result is joined back;
2. each key's lookup queries (C5) become ILIKE patterns (C4);
3. patterns and candidates are joined by ``gram_join.ilike_join``: an
   equi-join on each pattern's rarest n-grams, with long posting lists split;
4. the year and office rules filter the pairs, duplicates per (key,
   candidate, cycle) are dropped, and markets are left-joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.parsing import lenient_timestamp, safe_int
from ..functions.text import extract_queries, normalize_query, py_strip
from .common import broadcast_if_small
from .gram_join import ilike_join, literal_runs

KEY = ("_k_names", "_k_office", "_k_start_year", "_k_end_year")


def _office_code(office: Column) -> Column:
    m = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in vocab.OFFICE_FILTER_CODES), []))
    return m[office]


def candidate_matches(keys: DataFrame, candidate_dim: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """Matches per key: key columns + cand_id, cycle, matched name."""
    queries = keys.select(*KEY, F.posexplode(extract_queries(F.col("_k_names"))).alias("_query_at", "_query"))
    queries = queries.withColumn("pattern", normalize_query(F.col("_query")))
    # Q10: a query without words would match every candidate; not used
    queries = queries.filter(F.size(literal_runs(F.col("pattern"))) > 0)
    patterns = queries.select("pattern").distinct()

    cands = candidate_dim.select(
        "cand_id", "search_text",
        safe_int(F.col("cycle")).alias("_cycle"),
        F.coalesce(F.nullif(safe_int(F.col("candidate_election_year")), F.lit(0)), safe_int(F.col("cycle"))).alias("_eyear"),
        F.lower(py_strip(F.col("office_full"))).alias("_ofull"),
        F.lower(py_strip(F.col("office"))).alias("_ocode"),
        F.coalesce(F.nullif(F.col("normalized_name"), F.lit("")), F.col("display_name")).alias("matched_candidate_name"),
        F.col("display_name").alias("_display"),
    ).filter(F.col("cand_id").isNotNull() & (F.col("cand_id").cast("string") != ""))  # F13
    hits = ilike_join(patterns, cands, broadcast_limit)

    pairs = queries.join(hits, "pattern")
    # election year within the market's years (a missing side passes)
    year_ok = (
        (F.col("_k_start_year").isNull() | F.col("_eyear").isNull() | (F.col("_eyear") >= F.col("_k_start_year")))
        & (F.col("_k_end_year").isNull() | F.col("_eyear").isNull() | (F.col("_eyear") <= F.col("_k_end_year")))
    )
    # office must agree only for president / senate / house markets
    wanted = F.lower(F.col("_k_office"))
    enforce = F.coalesce(wanted.isin(*[o for o, _ in vocab.OFFICE_FILTER_CODES]), F.lit(False))
    have = F.coalesce(F.nullif(F.col("_ofull"), F.lit("")), F.col("_ocode"), F.lit(""))
    office_ok = ~enforce | (have == wanted) | (have == _office_code(wanted))
    kept = pairs.filter(year_ok & office_ok)
    # One row per (key, candidate, cycle): that of the first query which finds it
    found = kept.groupBy(*KEY, "cand_id", "_cycle").agg(F.min(F.struct("_query_at", "_display", "matched_candidate_name")).alias("_first"))
    return found.select(*KEY, "cand_id", "_cycle", "_first.*")


# Matches of a market in the order in which its queries find them
MATCH_ORDER = ("_query_at", "_cycle", "_display")


def match_order() -> list[Column]:
    """The order of a market's matches: by query, then as the search returns
    them (O1). Needs the columns that ``keep_order`` leaves in."""
    return [F.col("_query_at").asc_nulls_first(), F.col("_cycle").desc_nulls_first(), F.col("_display").asc_nulls_last(), F.col("matched_candidate_id").asc_nulls_last()]


def link_markets(
    markets: DataFrame,
    candidate_dim: DataFrame,
    names_col: str = "candidate_names",
    office_col: str = "office",
    start: Column | None = None,
    end: Column | None = None,
    broadcast_limit: int | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """Every market row once per matching candidate (a candidate found
    in two cycles appears twice, Q12), or once with NULL match columns.

    Output: the market columns + matched_candidate_id, matched_candidate_name,
    and with ``keep_order`` the columns of MATCH_ORDER."""
    cols = markets.columns
    if start is None:
        start = _first_present(markets, ("start_time", "start_date"))
    if end is None:
        end = _first_present(markets, ("end_time", "end_date"))
    start_ts = start if start is None or _is_timestamp(markets, start) else lenient_timestamp(start)
    end_ts = end if end is None or _is_timestamp(markets, end) else lenient_timestamp(end)
    start_ts = start_ts if start_ts is not None else F.lit(None).cast("timestamp")
    end_ts = end_ts if end_ts is not None else F.lit(None).cast("timestamp")

    keyed = markets.select(
        "*",
        F.col(names_col).cast("string").alias("_k_names"),
        F.col(office_col).cast("string").alias("_k_office"),
        F.year(start_ts).alias("_k_start_year"),
        F.year(end_ts).alias("_k_end_year"),
    )
    keys = keyed.select(*KEY).distinct()
    matches = candidate_matches(keys, candidate_dim, broadcast_limit).select(
        *[F.col(k).alias("_m" + k) for k in KEY],
        F.col("cand_id").alias("matched_candidate_id"),
        "matched_candidate_name",
        *MATCH_ORDER,
    )
    cond = None
    for k in KEY:
        c = F.col(k).eqNullSafe(F.col("_m" + k))
        cond = c if cond is None else cond & c
    joined = keyed.join(broadcast_if_small(matches, broadcast_limit), cond, "left")
    return joined.select(*[F.col(c) for c in cols], "matched_candidate_id", "matched_candidate_name", *[c for c in MATCH_ORDER if keep_order])


def _first_present(df: DataFrame, names) -> Column | None:
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        return None
    # the original takes the first *truthy* value
    return F.coalesce(*[F.nullif(p.cast("string"), F.lit("")) for p in present])


def _is_timestamp(df: DataFrame, col: Column) -> bool:
    try:
        return df.select(col).schema[0].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    except Exception:
        return False
