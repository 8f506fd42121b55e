"""Amount sums, exact CSV cells, header and folder discovery, line faults,
errors that are not 'no such table', and the catalogue's total order."""

import math
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fixture_files import write_receipts_fixture
from ledgerline.operators import catalog, common, facts
from ledgerline.plans import pipelines
from ledgerline.sinks import writers
from ledgerline.sources import bulk, markets

FLAT = ("candidate_id string, committee_id string, two_year_transaction_period int, report_year int, report_type string, "
        "contributor_name string, entity_type string, contribution_receipt_amount double")


def test_no_amount_is_dropped_or_rounded(spark):
    row = lambda c, amount, kind="IND": (c, "C", 2024, 2024, "Q1", "A", kind, amount)
    rows = [row("a", 0.004), row("a", 0.004), row("a", 0.1), row("a", 0.2, "COM"), row("b", math.nan), row("b", 1.0), row("c", math.inf), row("c", 1.0),
            row("d", None), row("e", 1e-15), row("e", 1.0, "PTY"), row("f", 1e30), row("f", -5.0)]
    got = {r.candidate_id: r for r in facts.candidate_cycle_summary(spark.createDataFrame(rows, FLAT)).collect()}
    assert got["a"].total_receipts == 0.308 and got["a"].individual_receipts == 0.108 and got["a"].committee_receipts == 0.2
    assert math.isnan(got["b"].total_receipts) and got["c"].total_receipts == math.inf and got["d"].total_receipts is None
    assert got["e"].total_receipts == 1.000000000000001 and got["f"].total_receipts == 1e30
    details = {r.candidate_id: r.receipts for r in facts.candidate_committee_details(spark.createDataFrame(rows, FLAT)).collect()}
    assert details["a"] == 0.308 and math.isnan(details["b"])
    top = {r.candidate_id: r.total_amount for r in facts.top_contributors(spark.createDataFrame(rows, FLAT)).collect() if r.entity_type == "IND"}
    assert top["a"] == 0.108 and top["c"] == math.inf


def test_csv_cells_come_back(spark, workdir):
    rows = [(1, 'say "yes", or not', "line\nbreak", ["a, b", 'c"d']), (2, " spaced ", "back\\slash\\", []), (3, 'ends with "', "|;,'", ["it's"])]
    df = spark.createDataFrame(rows, "market_id int, resolution_notes string, market_question string, outcomes array<string>")
    assert writers.write_market_dataset(df, f"{workdir}/m") == 3
    writers.write_matched_csv(df, f"{workdir}/matched")
    want = sorted(tuple(r) for r in writers.market_csv_frame(df).withColumn("market_id", F.col("market_id").cast("string")).collect())
    for path in (f"{workdir}/m.csv", f"{workdir}/matched"):
        back = markets.read_market_csv(spark, path)
        assert back.columns == df.columns and sorted(tuple(r) for r in back.collect()) == want


def test_header_is_found_next_to_the_data(spark, workdir):
    write_receipts_fixture(f"{workdir}/raw")
    header = f"{workdir}/raw/schedule_a/indiv_header.csv"
    results = []
    for k, given in enumerate((header, None)):
        cfg = pipelines.ReceiptsConfig(raw_root=f"{workdir}/raw", warehouse_root=f"{workdir}/wh{k}", cycles=[2024], schedule_a_header=given, count_faults=True)
        paths = pipelines.run_receipts(spark, cfg)
        results.append(sorted(map(str, spark.read.parquet(paths["candidate_cycle_summary"]).collect())))
    assert results[0] == results[1] and results[0]
    faults = spark.read.parquet(paths["schedule_a_faults"]).collect()
    assert faults and all(r.short_lines == r.long_lines == 0 for r in faults)


def test_folder_discovery(spark, workdir):
    with pytest.raises(FileNotFoundError):
        bulk.schedule_a_folder(spark, workdir, f"{workdir}/nowhere")
    assert bulk.schedule_a_folder(spark, workdir).endswith("/schedule_a")
    os.makedirs(f"{workdir}/scheduleA")
    assert bulk.schedule_a_folder(spark, workdir).endswith("/scheduleA") and bulk.schedule_a_header_file(spark, f"{workdir}/scheduleA") is None


def test_header_row_may_come_late(spark, workdir):
    with open(f"{workdir}/h.csv", "w") as f:
        f.write("\n" * 70 + ' A ,"B|C",D\nnot,the,header\n')
    assert bulk.schema_from_header(spark, f"{workdir}/h.csv").names == ["A", "B|C", "D"]


def test_lines_with_other_field_counts_are_counted(spark, workdir):
    os.makedirs(f"{workdir}/t")
    with open(f"{workdir}/t/itcont_2024.txt", "w") as f:
        f.write('1|2|3\n1|2\n1|"2|3|4|5\n||\n')
    r = bulk.field_count_faults(spark, f"{workdir}/t", "itcont_*.txt", 3).first()
    assert (r.lines, r.short_lines, r.long_lines) == (4, 1, 1)


def test_only_a_missing_path_is_a_missing_table(spark, workdir):
    assert writers.load_tables(spark, workdir, "jdbc:none", tables=["absent"]) == []
    os.makedirs(f"{workdir}/broken")
    with open(f"{workdir}/broken/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception) as failure:
        writers.load_tables(spark, workdir, "jdbc:none", tables=["broken"])
    assert not common.is_missing_path(failure.value)
    with pytest.raises(AnalysisException):
        bulk.schema_from_header(spark, f"{workdir}/no_header.csv")


def test_jdbc_parameters_are_checked():
    for bad in ({"jdbc_options": {"user": "x"}}, {"jdbc_url": "postgres://x"}):
        with pytest.raises(ValueError):
            pipelines.ReceiptsConfig(raw_root="a", warehouse_root="b", **bad)


def test_first_level_does_not_depend_on_row_order(spark):
    rows = [("10", "Texas", "state"), ("9", "Texas", "district"), ("9", "Texas", "state"), ("x", "Texas", "state")]
    for k in (1, 3):
        df = spark.createDataFrame(rows[k:] + rows[:k], "market_id string, jurisdiction string, jurisdiction_level string").repartition(k)
        assert [r.level for r in catalog.build_catalog(df).collect()] == ["district"]


def test_nothing_is_replaced_when_there_are_no_markets(spark, workdir):
    os.makedirs(f"{workdir}/cat.csv")
    with open(f"{workdir}/events.json", "w") as f:
        f.write("")
    with pytest.raises(RuntimeError):
        pipelines.run_markets(spark, f"{workdir}/events.json", None, f"{workdir}/out", f"{workdir}/cat", "2024-01-01T00:00:00Z")
    assert os.listdir(f"{workdir}/cat.csv") == [] and not os.path.exists(f"{workdir}/out.csv")
