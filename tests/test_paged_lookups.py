"""O4 by key and F8 by index: the rows of the plain forms, with fewer files."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import dims, history_pages, lookup
from ledgerline.operators.name_index import NameIndex
from ledgerline.plans import standins

FLAT = "candidate_id string, two_year_transaction_period int, contribution_receipt_date string, sub_id long, note string"


def scanned(df):
    """Rows that the file scans of a query gave, before any filter of Spark's."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf
        found = leaf.collectLeaves()
        for j in range(found.size()):
            metrics = found.apply(j).metrics()
            if metrics.contains("numFiles"):
                total += metrics.apply("numOutputRows").value()
    return total


def history(spark, workdir, n=6000):
    rng = random.Random(12)
    date = lambda: rng.choice([None, "01152024", "02202024"] + [f"{m:02d}{d:02d}2023" for m in range(1, 13) for d in range(1, 28)])
    rows = [(rng.choice(["H1", "H1", "H1", "S2", "P3"]), rng.choice([2022, 2024]), date(), rng.choice([None, *range(40)]), str(i % 3)) for i in range(n)]
    rows += [("H1", 2024, "05052023", 7, "same")] * 25
    flat = spark.createDataFrame(rows, FLAT)
    history_pages.write_history(flat, f"{workdir}/history", partitions=12)
    return flat, history_pages.read_history(spark, f"{workdir}/history")


@pytest.mark.parametrize("limit,cycles", [(7, None), (400, [2024]), (10_000, None)])
def test_pages_are_those_of_the_offset_form(spark, workdir, limit, cycles):
    flat, stored = history(spark, workdir, 600)
    key = lambda r: (r.contribution_receipt_date, r.sub_id)
    whole = lookup.schedule_a_history(flat, "H1", cycles, limit=100_000).collect()
    pages, token = [], None
    while True:
        rows, token = history_pages.page(stored, "H1", token, cycles, limit)
        pages += rows
        if token is None:
            break
        assert len(rows) == limit
    assert [key(r) for r in pages] == [key(r) for r in whole]
    assert sorted(map(str, pages)) == sorted(map(str, whole))


def test_late_pages_read_as_little_as_the_first(spark, workdir, monkeypatch):
    monkeypatch.setattr(history_pages, "ROW_GROUP_BYTES", 1024)
    flat, stored = history(spark, workdir, 20_000)
    n = flat.where("candidate_id = 'H1'").count()
    deep = history_pages.encode_token("02022023", 3, 0)
    first, late = (scanned(history_pages.history_from(stored, "H1", t, limit=20)) for t in (None, deep))
    assert late < n / 2 and late < first  # rows before the key are left out by the files' statistics
    assert scanned(history_pages.history_from(stored, "S2", None, limit=20)) < 20_000 / 2


def test_bad_tokens():
    with pytest.raises(ValueError):
        history_pages.decode_token("no token")


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    dim = dims.build_candidate_dim(standins.part_candidate_master(spark, SF_SMALL)).cache()
    index = NameIndex(spark, str(tmp_path_factory.mktemp("index")), buckets=32)
    index.build(dim)
    return dim, index


@pytest.mark.parametrize("name", ["small ring", "RING", "ri sm", "zzz", "a", "", "ring small ring", "o'brien", "plated  steel", "ing"])
def test_search_equals_the_scan(names, name):
    dim, index = names
    for limit in (None, 5, 5000):
        want = [tuple(r) for r in lookup.search_candidates(dim, name, limit).collect()]
        assert [tuple(r) for r in index.search(name, limit).collect()] == want


def test_search_reads_few_files(spark, names):
    dim, index = names
    pattern, grams = index.pattern("small ring")
    assert pattern == "%small%ring%" and set(grams) == {"sma", "mal", "all", "rin", "ing"}
    hits = index.hits("small ring")
    every = spark.read.parquet(f"{index.folder}/postings")
    folder = every.where(F.col("bucket") == grams[index.rarest(grams)[0]])
    assert scanned(hits) <= folder.count() < every.count() / 4
    assert scanned(index.search("small ring", 3)) < dim.count() / 2
