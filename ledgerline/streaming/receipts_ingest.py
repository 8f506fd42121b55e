"""Incremental receipts ingest with Structured Streaming.

New Schedule A files (``itcont_{cycle}*.txt`` anywhere under a folder) are
read as they land, standardised, joined to the published dimensions
(stream-static joins: the static dimension sides are broadcast when their
size is checked small, the stream is never shuffled for them) and put into
the ``schedule_a_flat`` table that the receipts job publishes, partitioned by
cycle, where facts, views and lookups read them. The checkpoint under the
shared ``spark.checkpoint.dir`` records which files are done.

A batch's files carry its number in their names. A batch that runs again, after
a failure between its steps, removes the files of that number before it puts
its own in place, so it changes nothing that is there. With ``keep_facts`` the
batch is then added to the mergeable fact aggregates (``operators.fact_state``)
and the three fact tables are published from these, without reading the
receipts of earlier batches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.fact_state import FactState
from ..operators.receipts import build_schedule_a_flat
from ..session import ensure_checkpoint_dir
from ..sinks.writers import write_parquet
from ..sources import bulk
from ..sources.bulk import path_exists


def receipts_stream(
    spark: SparkSession,
    schedule_a_dir: str,
    cycles: Sequence[int],
    candidate_committees: DataFrame,
    candidate_dim: DataFrame,
    committee_dim: DataFrame,
    header_path: str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Streaming flat receipts for the requested cycles."""
    cycles = [int(c) for c in cycles]
    schema = bulk.schedule_a_schema(spark, header_path)
    alternatives = "{" + ",".join(str(c) for c in cycles) + "}"
    raw = (
        spark.readStream.schema(schema)
        .option("sep", "|")
        .option("quote", "")
        .option("header", "false")
        .option("encoding", encoding)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"itcont_{alternatives}*.txt")
        .csv(schedule_a_dir)
    )
    pattern = "|".join(str(c) for c in cycles)
    cycle = F.regexp_extract(F.col("_metadata.file_name"), rf"^itcont_({pattern})", 1).try_cast("int")
    standardized = bulk.standardize_schedule_a(raw, cycle)
    return build_schedule_a_flat(standardized, candidate_committees, candidate_dim, committee_dim)


PERIOD = "two_year_transaction_period"


def put_batch(spark: SparkSession, staged: str, table: str, batch: int) -> int:
    """Moves a batch's staged files, by partition, into the table, in place
    of what an earlier try of the same batch left; returns their number."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{table}/{PERIOD}=*/ingest-{batch}-*.parquet")) or []:
        fs.delete(status.getPath(), False)
    files = fs.globStatus(path(f"{staged}/{PERIOD}=*/part-*.parquet")) or []
    for n, status in enumerate(files):
        folder = path(f"{table}/{status.getPath().getParent().getName()}")
        fs.mkdirs(folder)
        if not fs.rename(status.getPath(), path(folder, f"ingest-{batch}-{n}.parquet")):
            raise OSError(f"batch {batch}: {status.getPath()} was not moved")
    return len(files)


def publish_facts(state: FactState, warehouse_root: str) -> None:
    """The three fact tables from the state, as the receipts job writes them."""
    root = warehouse_root.rstrip("/")
    for name, fact in (("candidate_cycle_summary", state.fact("summary")), ("candidate_committee_details", state.fact("details")), ("top_contributors", state.top())):
        if fact is not None:
            write_parquet(fact, f"{root}/{name}", "cycle")


def start_receipts_ingest(
    spark: SparkSession,
    schedule_a_dir: str,
    cycles: Sequence[int],
    warehouse_root: str,
    header_path: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    keep_facts: bool = True,
) -> StreamingQuery:
    """Adds newly landed receipts to ``{warehouse_root}/schedule_a_flat``, and
    with ``keep_facts`` to the fact tables. Receipts that the table holds before
    the first batch are taken into the state once, as batch -1."""
    root = warehouse_root.rstrip("/")
    dims = {name: spark.read.parquet(f"{root}/{name}") for name in ("candidate_committees", "candidate_dim",
                                                                       "committee_dim")}
    flat = receipts_stream(spark, schedule_a_dir, cycles, dims["candidate_committees"], dims["candidate_dim"],
                           dims["committee_dim"], header_path)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/receipts_ingest"
    table = f"{root}/schedule_a_flat"
    state = FactState(spark, f"{root}/_fact_state") if keep_facts else None
    if state is not None and not state.batches() and path_exists(spark, table):
        state.apply(-1, spark.read.parquet(table))

    def ingest(rows: DataFrame, batch: int) -> None:
        staged = f"{root}/_ingest/batch-{batch}"
        rows.write.mode("overwrite").partitionBy(PERIOD).parquet(f"{staged}/rows")
        if state is not None:
            # before the files are moved: a try that ends here is run again whole
            state.apply(batch, spark.read.schema(rows.schema).parquet(f"{staged}/rows"))
        put_batch(spark, f"{staged}/rows", table, batch)
        if state is not None:
            publish_facts(state, root)

    writer = flat.writeStream.foreachBatch(ingest).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
