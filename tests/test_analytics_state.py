"""Latest analytics entries as a merged state, joined once."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import analytics_state, markets
from ledgerline.operators.analytics_state import AnalyticsState
from ledgerline.plans import pipelines, standins
from ledgerline.sources.markets import read_analytics

FIELDS = ["market_id", "market_volume", "event_slug"]


def page(folder, name, ids, tag):
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"data": [{"market_id": i, "market_volume": n, "event_slug": f"{tag}{n}"} for n, i in enumerate(ids)]}, f)


def rows(df):
    return sorted((tuple(r) for r in df.select(FIELDS).collect()), key=str)


def test_merges_equal_the_batch_whatever_the_order(spark, workdir):
    rng = random.Random(3)
    pages = os.path.join(workdir, "pages")
    os.mkdir(pages)
    state = AnalyticsState(spark, os.path.join(workdir, "state"), buckets=4)
    assert state.merge(f"{pages}/*.json") == 0 and state.entries().collect() == []
    for version, name in enumerate(["c.json", "a.json", "d.json", "b.json"], 1):
        page(pages, name, [rng.choice(["m1", "m2", "m3", "m4", None, f"only-{name}"]) for _ in range(12)], name[0])
        assert state.merge(f"{pages}/*.json") == version
        assert state.merge(f"{pages}/*.json") == version  # nothing new
        assert rows(state.entries()) == rows(markets.latest_analytics(read_analytics(spark, pages)))
    assert rows(AnalyticsState(spark, os.path.join(workdir, "state"), buckets=4).entries()) == rows(state.entries())
    assert state.expire(keep=1) == [1, 2, 3] and len(rows(state.entries())) > 4


def test_merge_reads_only_the_new_file(spark, workdir, monkeypatch):
    state = AnalyticsState(spark, os.path.join(workdir, "state"), buckets=2)
    page(workdir, "1.json", ["a", "b"], "x")
    state.merge(f"{workdir}/*.json")
    page(workdir, "2.json", ["b"], "y")
    read = []
    monkeypatch.setattr(analytics_state, "read_analytics", lambda s, paths: read.extend(paths) or read_analytics(s, paths))
    state.merge(f"{workdir}/*.json")
    assert [os.path.basename(p) for p in read] == ["2.json"]
    assert rows(state.entries()) == [("a", "0", "x0"), ("b", "0", "y0")]
    page(workdir, "1.json", ["a", "b", "c"], "changed")
    with pytest.raises(ValueError, match="changed"):
        state.merge(f"{workdir}/*.json")


def test_a_merge_that_lost_leaves_the_state(spark, workdir, monkeypatch):
    """Another merge commits the same version first."""
    page(workdir, "1.json", ["a"], "x")
    folder = os.path.join(workdir, "state")
    first, second = AnalyticsState(spark, folder, 2), AnalyticsState(spark, folder, 2)
    write = AnalyticsState._write

    def meanwhile(self, entries, data):
        write(self, entries, data)
        if self is second:
            first.merge(f"{workdir}/1.json")

    monkeypatch.setattr(AnalyticsState, "_write", meanwhile)
    with pytest.raises(RuntimeError, match="again"):
        second.merge(f"{workdir}/*.json")
    assert second.version() == 1 and rows(second.entries()) == [("a", "0", "x0")]
    assert second.merge(f"{workdir}/*.json") == 1


def test_state_joins_by_its_buckets(spark, workdir):
    state = AnalyticsState(spark, os.path.join(workdir, "state"), buckets=4)
    page(workdir, "1.json", [str(i) for i in range(50)], "x")
    state.merge(f"{workdir}/*.json")
    left = spark.range(200).select(F.col("id").cast("string").alias("market_id"))
    joined = left.join(state.entries().hint("merge"), "market_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the markets' side alone


def test_market_dataset_joins_analytics_once(spark):
    dataset, _ = pipelines.build_market_dataset(standins.market_events(spark, SF_SMALL), standins.analytics_entries(spark, SF_SMALL), "2024-01-01 00:00:00")
    plan = dataset._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("events.parquet") <= 1 and plan.count("market_open_interest") > 0
    assert sum("Join" in line and "_a_market_id" in line for line in plan.splitlines()) == 1


def test_files_are_listed_in_one_go(spark, workdir):
    """the files that a pattern matches, without folders and what lies in them."""
    from ledgerline.operators.analytics_state import listed_files

    root = f"{workdir}/pages"
    os.makedirs(f"{root}/c.json")
    for name, text in (("b.json", "22"), ("a.json", "1"), ("a b.json", "333"), ("x.txt", "4"), ("c.json/d.json", "5")):
        with open(f"{root}/{name}", "w") as out:
            out.write(text)
    assert listed_files(spark, f"{root}/*.json") == [(f"file:{root}/a b.json", 3), (f"file:{root}/a.json", 1), (f"file:{root}/b.json", 2)]
    assert listed_files(spark, f"file://{root}/x.*") == [(f"file:{root}/x.txt", 1)]
    assert listed_files(spark, f"{root}/none*") == [] == listed_files(spark, f"{workdir}/gone/*.json")
