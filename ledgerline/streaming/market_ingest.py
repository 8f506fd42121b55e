"""Incremental market ingest with Structured Streaming.

The original pages through the market API and processes every page in one
process. Here pages land as JSON files in a folder; a streaming query picks
up new files, flattens and gates their markets, merges the (static)
analytics snapshot, extracts names and office, and appends the result to a
Parquet table. Progress lives in a checkpoint under the shared
``spark.checkpoint.dir``, so a restarted or failed run resumes without
re-processing or losing files. Repeated events are not deduplicated (Q25).

Recency and jurisdiction tagging depend on the whole set of markets and a
reference time; they stay in the batch job (``plans.pipelines``), which can
read this table as its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import markets
from ..session import ensure_checkpoint_dir
from ..sources.markets import EVENT_SCHEMA


def market_stream(spark: SparkSession, events_dir: str, analytics: DataFrame | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of gated, enriched markets from landed event files.

    ``analytics`` is a static DataFrame of analytics entries (S12 shape);
    stream-static joins attach it without shuffling the stream."""
    # like the batch reader: a page that is no JSON stops the query
    reader = spark.readStream.schema(EVENT_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.json(events_dir)
    latest = markets.latest_analytics(analytics) if analytics is not None else None
    merged = markets.with_analytics(markets.flatten_markets(events), latest)
    enriched = markets.with_names_and_office(markets.election_markets(merged, latest is not None))
    return enriched.drop(*[c for c in enriched.columns if c.startswith("_a_") or c.startswith("_event_")])


def start_market_ingest(
    spark: SparkSession,
    events_dir: str,
    out_dir: str,
    analytics: DataFrame | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append new markets to Parquet at ``out_dir``.

    ``available_now`` processes what has landed and stops (a scheduled
    batch); otherwise the query keeps running."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/market_ingest"
    writer = (
        market_stream(spark, events_dir, analytics)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", ckpt)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)
