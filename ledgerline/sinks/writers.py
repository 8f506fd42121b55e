"""Sinks (K1-K9): Parquet warehouse, JDBC, market/catalog CSV and JSON,
lookup results as JSON.

Writes go through Spark's file committer (overwrite replaces the target
only when the job commits), so a lost executor means re-run tasks, not a
half-written table.
"""

from __future__ import annotations

import logging
import uuid
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.common import is_missing_path
from ..functions.vocab import WAREHOUSE_TABLES
from ..session import ensure_checkpoint_dir
from .database import load_table

LOGGER = logging.getLogger("ledgerline.sinks")

# Quotes within a cell are doubled and its white space is kept, so that a
# reader with the same options gets every cell back.
CSV_CELLS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, dynamic: bool = False) -> None:
    """K1: overwrite a Parquet table, optionally partitioned by one column.

    ``dynamic=True`` replaces only the partitions present in ``df`` (the
    default replaces the whole table, as the original does, Q31)."""
    writer = df.write.mode("overwrite")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    LOGGER.info("writing parquet %s", path)
    writer.parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder; goes with the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/published/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def published(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a derived table to the shared checkpoint folder and read it back:
    the read-back table has real file statistics (so a small one can be
    broadcast) and no lineage to recompute. The folder goes with the session.

    ``compression`` is for large tables that are read once; a denser codec
    would make a dimension look smaller than the broadcast check reckons."""
    path = shared_folder(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


def write_jdbc(df: DataFrame, table: str, url: str, options: dict | None = None, load_id: str | None = None) -> bool:
    """K2: the database table holds the rows of ``df``, or, if the load fails,
    what it held before (see ``database.load_table``)."""
    return load_table(df, table, url, options, load_id)


def load_tables(
    spark: SparkSession,
    warehouse_root: str,
    url: str,
    options: dict | None = None,
    tables: Sequence[str] = WAREHOUSE_TABLES,
    load_id: str | None = None,
) -> list[str]:
    """K3: copy published Parquet tables into the database; a missing table
    is skipped with a warning. Returns the tables that are loaded. A job that
    is run again with its ``load_id`` goes on where it stopped."""
    loaded = []
    for table in tables:
        path = f"{warehouse_root.rstrip('/')}/{table}"
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            LOGGER.warning("skipping %s; parquet path %s not found", table, path)
            continue
        write_jdbc(df, table, url, options, load_id)
        loaded.append(table)
    return loaded


def python_list_text(arr: Column) -> Column:
    """Python ``str(list_of_str)``: ['a', 'b'] (double quotes for an element
    holding a single quote and no double quote)."""

    def item(x):
        single = F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(x, r"\\", r"\\\\"), "'", r"\\'"), F.lit("'"))
        double = F.concat(F.lit('"'), F.regexp_replace(x, r"\\", r"\\\\"), F.lit('"'))
        return F.when(x.contains("'") & ~x.contains('"'), double).otherwise(single)

    return F.concat(F.lit("["), F.array_join(F.transform(arr, item), ", "), F.lit("]"))


def require_rows(df: DataFrame, what: str) -> None:
    """F16: refuse to write an empty export."""
    if df.isEmpty():
        raise RuntimeError(f"No {what} available for export.")


def market_csv_frame(df: DataFrame) -> DataFrame:
    """K4 cells: source names joined by '|', candidate names by ', ', other
    lists as Python list text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "array":
            if f.name == "jurisdiction_sources":
                c = F.array_join(F.coalesce(c, F.array()), "|")
            elif f.name == "candidate_names":
                c = F.array_join(F.coalesce(c, F.array()), ", ")
            else:
                c = python_list_text(F.coalesce(c, F.array().cast("array<string>")))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_market_dataset(df: DataFrame, path_prefix: str) -> int:
    """K4/K5: ``{prefix}.csv`` (one folder of CSV parts, header) and
    ``{prefix}.json`` (JSON Lines, real lists, NULLs kept). Returns the rows
    written (A13), counted by the CSV write itself."""
    require_rows(df, "market records")
    rows = Observation("market_rows")
    counted = market_csv_frame(df).observe(rows, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(**CSV_CELLS).csv(f"{path_prefix}.csv")
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path_prefix}.json")
    return rows.get["rows"]


def write_catalog(catalog: DataFrame, path_prefix: str) -> None:
    """K6/K7: one CSV row per (jurisdiction, source); nested JSON per
    jurisdiction."""
    from ..operators.catalog import explode_catalog

    explode_catalog(catalog).write.mode("overwrite").options(**CSV_CELLS).csv(f"{path_prefix}.csv")
    catalog.select("jurisdiction", "level", "sources").write.mode("overwrite").json(f"{path_prefix}.json")


def write_matched_csv(df: DataFrame, path: str) -> None:
    """K8: the linked market rows."""
    market_csv_frame(df).write.mode("overwrite").options(**CSV_CELLS).csv(path)


def to_json_lines(df: DataFrame, sort_keys: Iterable[str] | None = None) -> DataFrame:
    """K9: each row as one JSON object (keys in sorted order)."""
    names = sorted(df.columns) if sort_keys is None else list(sort_keys)
    return df.select(F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"}).alias("json"))
