"""Driver queries that write with the library's sinks into the shared folder
and read back with its sources, with their DuckDB twins.

What is read back must equal what was written, so the twins state the written
rows; no twin reads a file.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..operators import catalog, dims, markets
from ..operators.analytics_state import AnalyticsState, listed_files
from ..sinks.writers import published, shared_folder, write_catalog, write_market_dataset, write_matched_csv
from ..sources.bulk import committee_candidate_map, load_master, load_schedule_a_raw, read_schedule, schedule_b_schema, schedule_e_schema
from ..sources.markets import read_analytics, read_catalog_csv, read_catalog_json, read_events, read_market_csv
from . import pipelines, standins
from .market_oracle_sql import SQL as MARKET_SQL
from .market_queries import _json_arrays, _tagged, _utc, latest_columns
from .oracle_sql import SQL as RECEIPT_SQL

_CELLS = ("market_id", "question", "resolution_notes", "outcomes", "candidate_names", "jurisdiction_sources")
_CELL_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in _CELLS])


def q_events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages landed as JSON Lines, read with the event schema and
    flattened."""
    path = shared_folder(spark, "event-pages") + "/pages"
    standins.market_events(spark, sf_dir).write.json(path)
    flat = markets.flatten_markets(read_events(spark, path))
    return _json_arrays(flat.drop(*[c for c in flat.columns if c.startswith("_")]))


def _line(rows: DataFrame, columns) -> Column:
    """A row's cells in the order of ``columns``, NULL and what it has none of
    empty; cells that no row has are put down together."""
    parts, text = [], ""
    for n, c in enumerate(columns):
        text += "|" if n else ""
        if c in rows.columns and rows.schema[c].dataType != T.NullType():
            parts += [F.lit(text), F.coalesce(F.col(c).cast("string"), F.lit(""))]
            text = ""
    return F.concat(*parts, F.lit(text))


def _land(rows: DataFrame, folder: str, name: str, header: str, manifest: str | None = None, columns=None) -> list[int]:
    """``rows`` (column ``cycle`` and the file's columns, or those of
    ``columns`` that they have) as pipe-delimited
    bulk files ``{name}_{cycle}_{n}.txt``, as many to a cycle as tasks have
    rows of it, below ``folder``, with their header file and, if named, their
    manifest; returns the cycles. Only file names pass through the driver."""
    spark, columns = rows.sparkSession, columns or [c for c in rows.columns if c != "cycle"]
    line = _line(rows, columns)
    landing = shared_folder(spark, "landing") + "/parts"
    rows.select(line.alias("value"), "cycle").write.partitionBy("cycle").text(landing)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    parts: dict[str, list] = {}
    for status in fs.globStatus(path(f"{landing}/cycle=*/part-*")):
        parts.setdefault(status.getPath().getParent().getName().removeprefix("cycle="), []).append(status.getPath())
    for cycle, files in parts.items():
        for n, file in enumerate(files):
            fs.rename(file, path(f"{folder}/{name}_{cycle}_{n}.txt"))
    if manifest:
        lines = spark.read.option("pathGlobFilter", f"{name}_*.txt").text(folder).groupBy(F.col("_metadata.file_name").alias("file")).count()
        lines.coalesce(1).write.option("header", "true").csv(f"{folder}/{manifest}")
    spark.range(1).select(F.lit(",".join(columns)).alias("value")).coalesce(1).write.text(f"{folder}/{header}")
    return sorted(map(int, parts))


def _landed_master(rows: DataFrame, root: str, table: str) -> DataFrame:
    """A master table landed in several files to a cycle, with their manifest,
    and read back; ids get the type they had."""
    cycles = _land(rows, f"{root}/{table}", table, f"{table}_header_file.csv", f"{table}_manifest.csv")
    raw = load_master(rows.sparkSession, root, table, cycles)
    return raw.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) if c.endswith("_ID") else F.nullif(c, F.lit("")).alias(c) if c != "cycle" else c for c in raw.columns])


def q_bulk_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate master files by cycle, several to a cycle, read
    with their header file and made into the candidate dimension."""
    master = standins.candidate_master(spark, sf_dir).drop("o_orderkey")
    return dims.build_candidate_dim(_landed_master(master, shared_folder(spark, "bulk"), "candidate_master"))


def q_masters_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committee master and linkage files by cycle, read back and
    joined to links with roles; the optional table is not there."""
    root = shared_folder(spark, "bulk")
    with_receipts = published(spark, standins.committee_cycles(spark, sf_dir), "committee_cycles")
    committees = _landed_master(standins.committee_master(spark, sf_dir, with_receipts), root, "committee_master")
    links = _landed_master(standins.candidate_links(spark, sf_dir, with_receipts), root, "candidate_committee_linkage")
    spark.range(1).select(F.lit("CAND_ID,CMTE_ID").alias("value")).coalesce(1).write.text(f"{root}/committees_to_candidates/committees_to_candidates_header_file.csv")
    optional = load_master(spark, root, "committees_to_candidates", [1998], required=False)
    links = links.unionByName(optional.select(F.col("CAND_ID").cast("long"), F.col("CMTE_ID").cast(links.schema["CMTE_ID"].dataType), "cycle"), allowMissingColumns=True)
    return dims.build_candidate_committees(links, dims.build_committee_dim(committees))


def q_committee_map_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects of id pairs landed as files, read as a link table."""
    folder = shared_folder(spark, "committee-map") + "/objects"
    pair = F.concat(F.lit('"C'), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit('": "P'), F.col("o_custkey").cast("string"), F.lit('"'))
    orders = standins.table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 4000).alias("part"), pair.alias("pair"))
    objects = orders.groupBy("part").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("pair"), ",\n "), F.lit("}")).alias("value"))
    objects.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return committee_candidate_map(spark, folder)


def q_catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/K7: the source catalogue written as CSV and JSON, both read back: a
    row for each source, with its place and rating in the JSON."""
    prefix = shared_folder(spark, "catalog") + "/sources"
    write_catalog(catalog.build_catalog(_tagged(spark, sf_dir), order_col="market_id"), prefix)
    sources = read_catalog_json(spark, prefix).select(F.col("jurisdiction").alias("j"), F.col("level").alias("json_level"), F.posexplode("sources").alias("source_at", "s"))
    cells = read_catalog_csv(spark, prefix)
    same = (cells.jurisdiction == F.col("j")) & (cells.source_name == F.col("s.name")) & (cells.url == F.col("s.url"))
    return cells.join(sources, same).select(*cells.columns, "json_level", "source_at", F.col("s.feasibility").alias("json_feasibility"))


def q_schedule_a_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule A files by cycle, several to a cycle, read in
    one scan with their header file; the cycle comes from the file name."""
    folder = shared_folder(spark, "schedule-a") + "/files"
    rows = standins.bulk_receipts(spark, sf_dir)
    year = F.col("Rpt_Yr").cast("int")
    cycles = _land(rows.withColumn("cycle", year + year % 2), folder, "itcont", "indiv_header.csv")
    return load_schedule_a_raw(spark, folder, cycles, header_path=f"{folder}/indiv_header.csv")


def _land_pages(pages: DataFrame, folder: str) -> None:
    """One file for each page, named in the order of the pages."""
    ordered = pages.repartitionByRange("page").sortWithinPartitions("page")
    ordered.select("value").write.option("maxRecordsPerFile", 1).mode("append").text(folder)


def q_analytics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot pages landed as JSON documents, read by byte ranges;
    the latest entry of each market."""
    folder = shared_folder(spark, "analytics-pages") + "/pages"
    _land_pages(standins.analytics_pages(spark, sf_dir), folder)
    return latest_columns(markets.latest_analytics(read_analytics(spark, folder)))


def q_analytics_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages landed in three fetches, merged into the state table after
    each, the second one twice."""
    root = shared_folder(spark, "analytics-state")
    pages = standins.analytics_pages(spark, sf_dir)
    state = AnalyticsState(spark, f"{root}/state", buckets=8)
    last = pages.agg(F.max("page")).first()[0] or 0
    for fetch, (low, high) in enumerate([(0, last // 3), (last // 3 + 1, 2 * last // 3), (2 * last // 3 + 1, last)]):
        _land_pages(pages.where(F.col("page").between(low, high)), f"{root}/pages/fetch-{fetch}")
        # file names order the entries: fetches and pages by number
        _name_pages(spark, f"{root}/pages/fetch-{fetch}", f"{root}/named", fetch)
        state.merge(f"{root}/named/*.json")
        state.merge(f"{root}/named/*.json")
    return latest_columns(state.entries())


def _name_pages(spark: SparkSession, folder: str, target: str, fetch: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    files = [file for file, _ in listed_files(spark, f"{folder}/part-*")]
    named = [f"{target}/{fetch}-{file.rsplit('/', 1)[1].removesuffix('.txt')}.json" for file in files]
    with ThreadPoolExecutor(16) as pool:
        done = list(pool.map(lambda old, new: fs.rename(path(old), path(new)), files, named))
    if not all(done):
        raise RuntimeError(f"{done.count(False)} pages of {folder} were not renamed")


def _in_columns(rows: DataFrame, columns) -> DataFrame:
    """``rows`` in the order of ``columns``, with what it has none of empty."""
    return rows.select(*[F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def q_receipts_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole receipts job over landed files, those
    of Schedule A without a header file; the summary as SQL over the views of
    the published tables sees it."""
    raw, warehouse = shared_folder(spark, "raw"), shared_folder(spark, "warehouse")
    with_receipts = published(spark, standins.committee_cycles(spark, sf_dir), "committee_cycles")
    for table, rows in (("candidate_master", standins.candidate_master(spark, sf_dir).drop("o_orderkey")),
                        ("committee_master", standins.committee_master(spark, sf_dir, with_receipts)), ("candidate_committee_linkage", standins.candidate_links(spark, sf_dir, with_receipts))):
        _land(rows, f"{raw}/{table}", table, f"{table}_header_file.csv", f"{table}_manifest.csv")
    receipts = standins.raw_receipts(spark, sf_dir).withColumn("cycle", F.col("two_year_transaction_period").cast("int"))
    cycles = _land(receipts, f"{raw}/schedule_a", "itcont", "no_header_here", columns=vocab.SCHEDULE_A_DEFAULT_COLUMNS)
    pipelines.run_receipts(spark, pipelines.ReceiptsConfig(raw_root=raw, warehouse_root=warehouse, cycles=cycles, schedule_a_dir=f"{raw}/schedule_a"))
    pipelines.register_lookup_views(spark, warehouse)
    return spark.sql("""
        SELECT CAST(s.candidate_id AS BIGINT) AS candidate_id, s.cycle, c.display_name, s.total_receipts, s.individual_receipts, s.committee_receipts,
               s.party_receipts, s.transaction_count
        FROM candidate_cycle_summary s LEFT JOIN candidate c ON s.candidate_id = c.cand_id AND s.cycle = c.cycle""")


def q_schedule_be_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: Schedule B and E files without header files, by their default columns."""
    root = shared_folder(spark, "schedules")
    li = standins.table(spark, sf_dir, "lineitem")
    sub_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    amount, day = F.col("l_extendedprice").cast("decimal(18,2)"), F.date_format("l_shipdate", "yyyy-MM-dd")
    found = []
    for letter, schema, party, date, money in (("b", schedule_b_schema(spark), "recipient_name", "disbursement_date", "disbursement_amount"),
                                                ("e", schedule_e_schema(spark), "payee_name", "expenditure_date", "expenditure_amount")):
        rows = li.select(F.col("l_suppkey").alias("committee_id"), F.concat(F.lit('the "'), F.col("l_partkey").cast("string")).alias(party), day.alias(date), amount.alias(money), sub_id.alias("sub_id"))
        cells = _in_columns(rows, schema.names)
        cells.select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cells.columns]).alias("value")).write.text(f"{root}/{letter}")
        back = read_schedule(spark, f"{root}/{letter}", schema)
        found.append(back.select(F.lit(letter).alias("schedule"), "committee_id", F.col(party).alias("party"), F.col(date).alias("date"), F.col(money).alias("amount"), "sub_id", F.lit(len(back.columns)).alias("n_columns")))
    return found[0].unionByName(found[1])


def _market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market rows whose cells hold quotes, commas, line breaks, backslashes,
    outer spaces and lists, from every turn of every conversation."""
    turns = standins.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text, role = F.coalesce("text", F.lit("-")), F.coalesce("role", F.lit("-"))
    return turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("market_id"),
        F.concat(F.lit('say "yes", or not: '), text).alias("question"),
        F.concat(F.lit(' a\\b "'), text, F.lit('" \n,end ')).alias("resolution_notes"),
        F.array(F.lit("Yes, now"), F.lit("it's"), role).alias("outcomes"),
        F.array(F.lit("Ann B"), role).alias("candidate_names"),
        F.array(F.lit("one"), F.lit("two")).alias("jurisdiction_sources"),
    )


_TEXT_CELLS_SQL = r"""
  concat_ws('-', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS market_id,
  'say "yes", or not: ' || coalesce(text, '-') AS question,
  ' a\b "' || coalesce(text, '-') || '" ' || chr(10) || ',end ' AS resolution_notes
"""

_CSV_CELLS_SQL = f"""
SELECT {_TEXT_CELLS_SQL},
  '[''Yes, now'', "it''s", ''' || coalesce(role, '-') || ''']' AS outcomes,
  'Ann B, ' || coalesce(role, '-') AS candidate_names,
  'one|two' AS jurisdiction_sources
FROM conversations
"""


def q_market_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market dataset written as CSV and read back cell by cell."""
    prefix = shared_folder(spark, "market-dataset") + "/markets"
    write_market_dataset(_market_rows(spark, sf_dir), prefix)
    return read_market_csv(spark, f"{prefix}.csv", _CELL_SCHEMA)


def q_market_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the market dataset written as JSON Lines, lists kept as lists."""
    prefix = shared_folder(spark, "market-dataset") + "/markets"
    rows = _market_rows(spark, sf_dir)
    write_market_dataset(rows, prefix)
    back = spark.read.schema(rows.schema).json(f"{prefix}.json")
    return back.select("market_id", "question", "resolution_notes", F.array_join("outcomes", "~").alias("outcomes"))


def q_matched_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked market rows written as CSV and read back."""
    path = shared_folder(spark, "matched") + "/matched.csv"
    write_matched_csv(_market_rows(spark, sf_dir), path)
    return read_market_csv(spark, path, _CELL_SCHEMA)


QUERIES = {
    "events_roundtrip": _utc(q_events_roundtrip),
    "analytics_roundtrip": _utc(q_analytics_roundtrip),
    "analytics_merge": _utc(q_analytics_merge),
    "bulk_roundtrip": q_bulk_roundtrip,
    "masters_roundtrip": q_masters_roundtrip,
    "receipts_job": q_receipts_job,
    "schedule_be_scan": q_schedule_be_scan,
    "committee_map_file": q_committee_map_file,
    "catalog_roundtrip": _utc(q_catalog_roundtrip),
    "schedule_a_scan": q_schedule_a_scan,
    "market_csv_roundtrip": q_market_csv_roundtrip,
    "market_json_roundtrip": q_market_json_roundtrip,
    "matched_csv_roundtrip": q_matched_csv_roundtrip,
}

SQL = {
    "events_roundtrip": MARKET_SQL["market_flatten"],
    "analytics_roundtrip": MARKET_SQL["analytics_latest"],
    "analytics_merge": MARKET_SQL["analytics_latest"],
    "bulk_roundtrip": RECEIPT_SQL["dim_dedup"],
    "masters_roundtrip": RECEIPT_SQL["committee_roles"],
    "receipts_job": RECEIPT_SQL["receipts_job"],
    "schedule_be_scan": """
SELECT schedule, CAST(l_suppkey AS VARCHAR) AS committee_id, 'the "' || CAST(l_partkey AS VARCHAR) AS party, strftime(l_shipdate, '%Y-%m-%d') AS date,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sub_id, n_columns
FROM lineitem, (VALUES ('b', 30), ('e', 26)) AS s(schedule, n_columns)
""",
    "committee_map_file": """
SELECT 'C' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS committee_id, 'P' || CAST(o_custkey AS VARCHAR) AS candidate_id FROM orders
""",
    "catalog_roundtrip": MARKET_SQL["catalog_sources"],
    "schedule_a_scan": f"""
SELECT *, CAST(CAST(report_year AS INTEGER) + CAST(report_year AS INTEGER) % 2 AS INTEGER) AS two_year_transaction_period
FROM ({RECEIPT_SQL["column_aliases"]})
""",
    "market_csv_roundtrip": _CSV_CELLS_SQL,
    "market_json_roundtrip": f"""
SELECT {_TEXT_CELLS_SQL}, 'Yes, now~it''s~' || coalesce(role, '-') AS outcomes FROM conversations
""",
    "matched_csv_roundtrip": _CSV_CELLS_SQL,
}
