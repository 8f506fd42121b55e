"""Market dataset job (X7): flatten, gate, enrich, recency (P14-P16, F3-F7,
J7, J12, A7, A13, C10-C18).

Events arrive nested (an event holds its markets); one ``explode`` gives a
row per market. Everything after that is row-local column work plus one left
join with the analytics snapshot keyed by market id; the gate is a filter on
that join's columns. Neither side is collected.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, names, parsing, vocab

# output column order of a market record
DATASET_COLUMNS = (
    "event_id", "market_id", "platform", "event_title", "market_question", "jurisdiction",
    "jurisdiction_level", "jurisdiction_sources", "jurisdiction_feasibility", "category", "start_date",
    "end_date", "closed_time", "total_volume", "volume_24h", "volume_1w", "volume_1m", "volume_1y",
    "liquidity", "liquidity_amm", "liquidity_clob", "open_interest", "num_outcomes", "outcomes",
    "winning_outcome", "resolution_source", "resolution_notes", "clob_token_ids",
    "analytics_market_volume", "analytics_market_open_interest", "analytics_outcome_yes_price",
    "analytics_outcome_no_price", "analytics_event_slug", "analytics_source", "analytics_event_tags",
    "candidate_names", "office",
)


def falsy_fallback(first: Column, second: Column) -> Column:
    """``a or b`` for text: NULL or '' falls back."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def _falsy_number_text(v: Column) -> Column:
    # Python truthiness of a JSON value read as text: null, '', 0 are falsy
    return v.isNull() | (v == "") | (v.try_cast("double") == F.lit(0.0))


def flatten_markets(events: DataFrame) -> DataFrame:
    """One row per market of each event, ids as text.

    Falsy market values fall back to the event's: resolution source,
    closed time, AMM liquidity (0 also falls back) and notes (description).
    A NULL market list gives no rows (Q23)."""
    m = events.select(F.col("*"), F.explode("markets").alias("m")).drop("markets")
    return m.select(*_flatten_columns())


@lru_cache(maxsize=None)
def _flatten_columns() -> tuple:
    # Column expressions over fixed input names: built once per process
    amm_text = F.when(_falsy_number_text(F.col("m.liquidityAmm")), F.col("liquidityAmm")).otherwise(
        F.col("m.liquidityAmm")
    )
    outcomes_text = F.coalesce(F.col("m.outcomes"), F.lit("[]"))
    return (
        F.col("id").alias("event_id"),
        F.col("m.id").alias("market_id"),
        F.lit(vocab.PLATFORM).alias("platform"),
        F.coalesce(F.col("title"), F.lit("")).alias("event_title"),
        F.coalesce(F.col("m.question"), F.lit("")).alias("market_question"),
        F.col("category"),
        F.col("startDate").alias("start_date"),
        F.col("endDate").alias("end_date"),
        falsy_fallback(F.col("m.closedTime"), F.col("closedTime")).alias("closed_time"),
        parsing.parse_float(F.col("m.volume")).alias("total_volume"),
        parsing.parse_float(F.col("m.volume24hr")).alias("volume_24h"),
        parsing.parse_float(F.col("m.volume1wk")).alias("volume_1w"),
        parsing.parse_float(F.col("m.volume1mo")).alias("volume_1m"),
        parsing.parse_float(F.col("m.volume1yr")).alias("volume_1y"),
        parsing.parse_float(F.col("m.liquidity")).alias("liquidity"),
        parsing.parse_float(amm_text).alias("liquidity_amm"),
        parsing.parse_float(F.col("liquidityClob")).alias("liquidity_clob"),
        parsing.parse_float(F.col("openInterest")).alias("open_interest"),
        F.size(parsing.parse_string_list(outcomes_text)).alias("num_outcomes"),
        parsing.parse_string_list(outcomes_text).alias("outcomes"),
        parsing.infer_winner(outcomes_text, F.coalesce(F.col("m.outcomePrices"), F.lit("[]"))).alias("winning_outcome"),
        falsy_fallback(F.col("m.resolutionSource"), F.col("resolutionSource")).alias("resolution_source"),
        falsy_fallback(F.col("m.description"), F.col("description")).alias("resolution_notes"),
        parsing.parse_string_list(F.coalesce(F.col("m.clobTokenIds"), F.lit("[]"))).alias("clob_token_ids"),
        # event text kept for the fallback election filter
        F.col("description").alias("_event_description"),
        F.col("ticker").alias("_event_ticker"),
        F.col("slug").alias("_event_slug"),
    )


def latest_analytics(entries: DataFrame) -> DataFrame:
    """One analytics entry per market id, the latest one winning.

    Order is (``_file``, ``_pos``) when present. ``max_by`` aggregates
    partially before the shuffle, so a market repeated many times costs one
    row per map task."""
    order_cols = [c for c in ("_file", "_pos") if c in entries.columns]
    data_cols = [c for c in entries.columns if c not in ("_file", "_pos")]
    order = F.struct(*[F.col(c) for c in order_cols]) if order_cols else F.lit(0)
    keyed = entries.filter(F.col("market_id").isNotNull())
    best = keyed.groupBy("market_id").agg(F.max_by(F.struct(*[F.col(c) for c in data_cols]), order).alias("_e"))
    return best.select("_e.*")


def analytics_columns(analytics: DataFrame) -> DataFrame:
    """Analytics fields as they are merged into a market record, and
    whether the entry's tags are of an election (F4)."""
    parsed = analytics.select(*_analytics_select())
    return parsed.withColumn("_a_election", classify.is_election_by_tags(F.col("analytics_event_tags")))


@lru_cache(maxsize=None)
def _analytics_select() -> tuple:
    return (
        F.col("market_id").alias("_a_market_id"),
        parsing.parse_float(F.col("market_volume")).alias("analytics_market_volume"),
        parsing.parse_float(F.col("market_open_interest")).alias("analytics_market_open_interest"),
        parsing.parse_float(F.col("outcome_1_price")).alias("analytics_outcome_yes_price"),
        parsing.parse_float(F.col("outcome_2_price")).alias("analytics_outcome_no_price"),
        F.col("event_slug").alias("analytics_event_slug"),
        F.col("source").alias("analytics_source"),
        parsing.normalize_tags(F.col("event_tags")).alias("analytics_event_tags"),
        F.col("market_close_date").alias("_a_market_close_date"),
        F.col("event_end_date").alias("_a_event_end_date"),
        F.col("event_title").alias("_a_event_title"),
        F.col("event_description").alias("_a_event_description"),
        F.lit(True).alias("_a_present"),
    )


def with_analytics(markets: DataFrame, analytics: DataFrame | None = None) -> DataFrame:
    """The fields of each market's analytics entry, NULL without one.
    The only join with the snapshot: gate and enrichment both read its columns."""
    no_tags = F.array().cast("array<string>")
    if analytics is None:
        absent = {c: F.lit(None).cast("double") for c in (
            "analytics_market_volume", "analytics_market_open_interest", "analytics_outcome_yes_price",
            "analytics_outcome_no_price")}
        absent.update({c: F.lit(None).cast("string") for c in (
            "analytics_event_slug", "analytics_source", "_a_market_close_date", "_a_event_end_date",
            "_a_event_title", "_a_event_description")})
        return markets.withColumns(absent | {"_a_present": F.lit(None).cast("boolean"), "_a_election": F.lit(None).cast("boolean"), "analytics_event_tags": no_tags})
    a = analytics_columns(analytics)
    joined = markets.join(a, markets.market_id == a._a_market_id, "left").drop("_a_market_id")
    return joined.withColumn("analytics_event_tags", F.coalesce("analytics_event_tags", no_tags))


def election_markets(markets: DataFrame, with_tags: bool) -> DataFrame:
    """The election markets among those of ``with_analytics``.

    With an analytics snapshot: the market's entry must exist and carry an
    election tag. Without: the event text must mention an election word and
    the question must read as an electoral outcome."""
    if with_tags:
        return markets.filter(F.col("_a_election"))
    hay = classify.election_event_text(
        F.col("event_title"), F.col("_event_description"), F.col("_event_ticker"), F.col("_event_slug"),
        F.col("category"),
    )
    # both texts are referenced by many tests: materialise them once
    staged = markets.select("*", hay.alias("_hay"), F.lower(F.col("market_question")).alias("_qlow"))
    keep = classify.mentions_election_word(F.col("_hay")) & classify.is_election_question(
        F.col("market_question"), F.col("_qlow"))
    return staged.filter(keep).drop("_hay", "_qlow")


def gate_markets(markets: DataFrame, analytics: DataFrame | None = None) -> DataFrame:
    """The election markets, with the columns of ``markets``."""
    return election_markets(with_analytics(markets, analytics), analytics is not None).select(*markets.columns)


def with_names_and_office(markets: DataFrame, known_names: DataFrame | None = None, finder: names.SpanFinder = names.capitalised_runs) -> DataFrame:
    """Candidate names, from the tags, then the resolution notes, and
    the office."""
    texts = F.concat(F.col("analytics_event_tags"), F.array(F.col("resolution_notes")))
    return with_office(names.with_candidate_names(markets, texts, known_names, finder))


def enrich_markets(
    markets: DataFrame, analytics: DataFrame | None = None, known_names: DataFrame | None = None, finder: names.SpanFinder = names.capitalised_runs
) -> DataFrame:
    """Analytics fields, candidate names and office."""
    return with_names_and_office(with_analytics(markets, analytics), known_names, finder)


def office_text(*cols) -> Column:
    return classify.join_nonempty(*cols)


def enrich_markets(
    markets: DataFrame, analytics: DataFrame | None = None, finder: names.SpanFinder = names.capitalised_runs
) -> DataFrame:
    """Analytics fields, candidate names and office.

    Candidate names come from the tags, then the resolution notes."""
    if analytics is not None:
        a = analytics_columns(analytics)
        m = markets.join(a, markets.market_id == a._a_market_id, "left").drop("_a_market_id")
        tags = F.coalesce(F.col("analytics_event_tags"), F.array().cast("array<string>"))
    else:
        absent = {c: F.lit(None).cast("double") for c in (
            "analytics_market_volume", "analytics_market_open_interest", "analytics_outcome_yes_price",
            "analytics_outcome_no_price")}
        absent.update({c: F.lit(None).cast("string") for c in (
            "analytics_event_slug", "analytics_source", "_a_market_close_date", "_a_event_end_date",
            "_a_event_title", "_a_event_description")})
        absent["_a_present"] = F.lit(None).cast("boolean")
        m = markets.withColumns(absent)
        tags = F.array().cast("array<string>")
    m = m.withColumns({"analytics_event_tags": tags, "candidate_names": _names_column(analytics is not None, finder)})
    return with_office(m)


@lru_cache(maxsize=None)
def _names_column(with_analytics: bool, finder) -> Column:
    tags = (F.coalesce(F.col("analytics_event_tags"), F.array().cast("array<string>")) if with_analytics
            else F.array().cast("array<string>"))
    return names.extract_candidate_names(F.concat(tags, F.array(F.col("resolution_notes"))), finder)


def with_office(df: DataFrame) -> DataFrame:
    """C18 on a materialised lower-cased text column (referenced by every
    office pattern; a column is not recomputed per reference)."""
    text_col, office_col = _office_columns()
    staged = df.select("*", text_col)
    return staged.select(*[F.col(c) for c in df.columns], office_col)


@lru_cache(maxsize=None)
def _office_columns() -> tuple[Column, Column]:
    text = office_text(
        F.col("event_title"), F.col("market_question"), F.col("category"), F.col("resolution_notes"),
        F.array_join(F.col("analytics_event_tags"), " "),
    )
    return F.lower(text).alias("_otext"), classify.infer_office(F.col("_otext"), lowered=True).alias("office")


def with_jurisdiction(df: DataFrame) -> DataFrame:
    """Jurisdiction name and level, from materialised text columns."""
    cols = [F.col(c) for c in df.columns if c not in ("jurisdiction", "jurisdiction_level")]
    text, low, parts_col, from_parts = _jurisdiction_columns()
    staged = df.select(*cols, text).select("*", low)
    parts = staged.select(*cols, parts_col)
    j = parts.select(*cols, from_parts)
    return j.select(*cols, F.col("_j.name").alias("jurisdiction"), F.col("_j.level").alias("jurisdiction_level"))


@lru_cache(maxsize=None)
def _jurisdiction_columns() -> tuple:
    return (
        jurisdiction_text().alias("_jtext"),
        F.lower(F.col("_jtext")).alias("_jlow"),
        classify.jurisdiction_parts(F.col("_jtext"), F.col("_jlow")).alias("_jp"),
        classify.jurisdiction_from_parts(F.col("_jp")).alias("_j"),
    )


@lru_cache(maxsize=None)
def closed_timestamp() -> Column:
    """C14: closed, end, start, then (with an analytics entry) its market
    close date and event end date."""
    return parsing.first_timestamp(
        F.col("closed_time"), F.col("end_date"), F.col("start_date"),
        F.col("_a_market_close_date"), F.col("_a_event_end_date"),
    )


def recent_markets(markets: DataFrame, as_of, lookback_days: int = vocab.RECENT_WINDOW_DAYS) -> DataFrame:
    """markets whose best closed time is within the look-back window
    before ``as_of`` (a timestamp or ISO text; a job parameter, Q22).
    An empty closed_time is filled with the ISO text of that time."""
    closed = closed_timestamp()
    # text or a datetime without a zone is UTC; the window is counted in whole
    # days of 24 hours, so neither depends on the session's zone
    moment = parsing.parse_iso_datetime(F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()))
    cutoff = moment - F.make_dt_interval(days=F.lit(lookback_days))
    kept = markets.select("*", closed.alias("_closed_ts")).filter(F.col("_closed_ts") >= cutoff)
    filled = F.when(F.coalesce(F.col("closed_time"), F.lit("")) == "", parsing.iso_text(F.col("_closed_ts"))).otherwise(
        F.col("closed_time"))
    return kept.select(*[filled.alias(c) if c == "closed_time" else F.col(c) for c in kept.columns])


def jurisdiction_text() -> Column:
    return classify.join_nonempty(
        F.col("event_title"), F.col("market_question"), F.col("category"), F.col("resolution_notes"),
        F.col("_a_event_title"), F.col("_a_event_description"),
    )
