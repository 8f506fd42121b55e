"""Driver queries for the prediction-market side.

Markets come from ``standins.market_events`` (conversations) and the
analytics snapshot from ``standins.analytics_entries`` (events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, dims, linkage, markets
from . import standins

AS_OF = "2024-01-01 00:00:00"  # recency reference time (a job parameter)


def _utc(fn):
    """Market times are read and written in UTC (Q21), whatever the caller's
    session default is."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _json_arrays(df: DataFrame) -> DataFrame:
    """Driver-query presentation: list columns as JSON text (the engine-neutral
    form the JSON sink writes), so result checks compare plain strings."""
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ])


def _flat_markets(spark, sf_dir) -> DataFrame:
    return markets.flatten_markets(standins.market_events(spark, sf_dir))


def _analytics(spark, sf_dir) -> DataFrame:
    return markets.latest_analytics(standins.analytics_entries(spark, sf_dir))


def _enriched(spark, sf_dir) -> DataFrame:
    return markets.enrich_markets(_flat_markets(spark, sf_dir), _analytics(spark, sf_dir))


def _tagged(spark, sf_dir) -> DataFrame:
    return markets.with_jurisdiction(_enriched(spark, sf_dir))


def q_market_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per market with fallbacks and parsed values."""
    fm = _flat_markets(spark, sf_dir)
    return _json_arrays(fm.drop(*[c for c in fm.columns if c.startswith("_")]))


def q_analytics_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest analytics entry per market, parsed."""
    return latest_columns(_analytics(spark, sf_dir))


def latest_columns(analytics: DataFrame) -> DataFrame:
    a = markets.analytics_columns(analytics)
    return _json_arrays(a).select(
        F.col("_a_market_id").alias("market_id"), "analytics_market_volume", "analytics_market_open_interest",
        "analytics_outcome_yes_price", "analytics_outcome_no_price", "analytics_event_slug", "analytics_source",
        "analytics_event_tags", F.col("_a_market_close_date").alias("market_close_date"),
    )


def q_tag_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets whose analytics entry carries an election tag."""
    return markets.gate_markets(_flat_markets(spark, sf_dir), _analytics(spark, sf_dir)).select("event_id", "market_id")


def q_election_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the fallback gate on event text and question wording."""
    return markets.gate_markets(_flat_markets(spark, sf_dir)).select("event_id", "market_id")


def q_closed_time_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best closed time, two-year window before AS_OF, fill."""
    r = markets.recent_markets(_enriched(spark, sf_dir), AS_OF)
    # a zone-free timestamp, so clients read the same wall-clock UTC value
    return r.select("market_id", "closed_time", F.col("_closed_ts").cast("timestamp_ntz").alias("closed_ts"))


def q_office_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Office from title, question, category, notes and tags."""
    return _enriched(spark, sf_dir).select("market_id", "office")


def q_jurisdiction_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """US state / district / country / fallback jurisdiction."""
    return _tagged(spark, sf_dir).select("market_id", "jurisdiction", "jurisdiction_level")


def q_source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (jurisdiction, source)."""
    cat = catalog.build_catalog(_tagged(spark, sf_dir), order_col="market_id")
    return catalog.explode_catalog(cat, with_best=True)


def q_name_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate names from tags and notes: known persons,
    else runs of capitalised words."""
    merged = markets.with_analytics(_flat_markets(spark, sf_dir), _analytics(spark, sf_dir))
    named = markets.with_names_and_office(merged, standins.person_names(spark, sf_dir))
    return _json_arrays(named.select("market_id", "candidate_names"))


def q_market_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets named after parts linked to
    the part-named candidates."""
    cand = dims.build_candidate_dim(standins.part_candidate_master(spark, sf_dir))
    mk = standins.link_markets_input(spark, sf_dir)
    return linkage.link_markets(mk, cand)


QUERIES = {
    "market_flatten": q_market_flatten,  # noqa: E501 (wrapped below)
    "analytics_latest": q_analytics_latest,
    "tag_gate": q_tag_gate,
    "election_text_filter": q_election_text_filter,
    "closed_time_recent": q_closed_time_recent,
    "office_inference": q_office_inference,
    "jurisdiction_inference": q_jurisdiction_inference,
    "source_catalog": q_source_catalog,
    "name_candidates": q_name_candidates,
    "market_links": q_market_links,
}


def q_market_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 end to end: gate, analytics merge, names, office, recency,
    jurisdiction, catalog; the 37 output columns."""
    from .pipelines import build_market_dataset

    dataset, _ = build_market_dataset(
        standins.market_events(spark, sf_dir), standins.analytics_entries(spark, sf_dir), AS_OF
    )
    return _json_arrays(dataset)


QUERIES["market_dataset"] = q_market_dataset


def q_winning_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome lists and the winner from settlement prices
    derived from event values (outcome text by event type)."""
    from ..functions import parsing

    ev = standins.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    outcomes = (
        F.when(F.col("event_type") == "click", F.lit('["Yes","No"]'))
        .when(F.col("event_type") == "view", F.lit("['Up','Down']"))
        .when(F.col("event_type") == "error", F.lit('["A","B","C"]'))
        .when(F.col("event_type") == "signup", F.lit("[]"))
        .otherwise(F.lit("oops"))
    )
    p = F.floor("value")
    prices = F.concat(
        F.lit('["'), (p / 100).cast("string"), F.lit('","'), ((F.lit(100) - p) / 100).cast("string"), F.lit('"]')
    )
    t = ev.select("event_id", outcomes.alias("outcomes_text"), prices.alias("prices_text"))
    lst = parsing.parse_string_list(F.col("outcomes_text"))
    return _json_arrays(t.select(
        "event_id", "outcomes_text", "prices_text", lst.alias("outcomes"), F.size(lst).alias("num_outcomes"),
        parsing.infer_winner(F.col("outcomes_text"), F.col("prices_text")).alias("winning_outcome"),
    ))


QUERIES["winning_outcome"] = q_winning_outcome


QUERIES = {name: _utc(fn) for name, fn in QUERIES.items()}


def q_catalog_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the source catalogue as one JSON object per jurisdiction."""
    cat = catalog.build_catalog(_tagged(spark, sf_dir), order_col="market_id")
    return cat.select("jurisdiction", F.to_json(F.struct("level", "sources")).alias("entry"))


QUERIES["catalog_json"] = _utc(q_catalog_json)
