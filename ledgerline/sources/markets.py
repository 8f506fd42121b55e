"""Landed prediction-market JSON.

Fetching pages from the market APIs is not part of this library; pages are
landed as JSON files and read here with explicit schemas. Scalars are read
as strings (the API mixes numbers and numeric text; a string field keeps the
raw JSON text of either), the list-valued fields are list *text*.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sinks.writers import CSV_CELLS
from .json_pages import page_entries

_S = T.StringType()

MARKET_FIELDS = (
    "id", "question", "description", "outcomes", "outcomePrices", "clobTokenIds", "closedTime",
    "resolutionSource", "volume", "volume24hr", "volume1wk", "volume1mo", "volume1yr", "liquidity",
    "liquidityAmm",
)
EVENT_FIELDS = (
    "id", "title", "description", "ticker", "slug", "category", "startDate", "endDate", "closedTime",
    "resolutionSource", "liquidityClob", "liquidityAmm", "openInterest",
)
ANALYTICS_FIELDS = (
    "market_id", "market_volume", "market_open_interest", "outcome_1_price", "outcome_2_price", "event_slug",
    "source", "event_tags", "market_close_date", "event_end_date", "event_title", "event_description",
)

MARKET_SCHEMA = T.StructType([T.StructField(f, _S) for f in MARKET_FIELDS])
EVENT_SCHEMA = T.StructType(
    [T.StructField(f, _S) for f in EVENT_FIELDS] + [T.StructField("markets", T.ArrayType(MARKET_SCHEMA))]
)
ANALYTICS_ENTRY_SCHEMA = T.StructType([T.StructField(f, _S) for f in ANALYTICS_FIELDS])


def read_events(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Event pages as JSON Lines, each line an event or an array of
    events; with ``multi_line`` each file is one (indented) event or array.
    Text that is no JSON, or an indented page read by lines, raises."""
    reader = spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST")
    return reader.option("multiLine", multi_line).json(path)


def read_analytics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Analytics snapshot pages ``{"data": [...]}``; one large page is
    read by many tasks (see ``json_pages``). Text that is no such page raises.

    Entries keep their order: ``_file`` and ``_pos`` (byte offset in the
    page) order repeated market ids so the latest entry wins (A7)."""
    entries = page_entries(spark, path, ANALYTICS_ENTRY_SCHEMA)
    return entries.withColumnsRenamed({"file": "_file", "at": "_pos"})


def read_market_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The market dataset written as CSV (quoted, may span lines)."""
    reader = spark.read.options(**CSV_CELLS).option("multiLine", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


_CATALOG_CELLS = ("jurisdiction", "level", "source_name", "url", "description", "access", "update_frequency", "feasibility", "feasibility_notes")
CATALOG_CSV_SCHEMA = T.StructType([T.StructField(c, _S) for c in _CATALOG_CELLS])
CATALOG_JSON_SCHEMA = T.StructType([
    T.StructField("jurisdiction", _S), T.StructField("level", _S),
    T.StructField("sources", T.ArrayType(T.StructType([T.StructField("name", _S)] + [T.StructField(c, _S) for c in _CATALOG_CELLS[3:]]))),
])


def read_catalog_csv(spark: SparkSession, path_prefix: str) -> DataFrame:
    """The source catalogue as the sink writes it: a row for each source. Its
    cells are never NULL; an empty one is an empty text."""
    return read_market_csv(spark, f"{path_prefix}.csv", CATALOG_CSV_SCHEMA).fillna("")


def read_catalog_json(spark: SparkSession, path_prefix: str) -> DataFrame:
    """The source catalogue as the sink writes it: a row for each jurisdiction."""
    return spark.read.schema(CATALOG_JSON_SCHEMA).option("mode", "FAILFAST").json(f"{path_prefix}.json")
