"""Market dataset job and streaming ingest on small landed JSON files."""

import glob
import json
import os

import pytest

from pyspark.sql import functions as F

from ledgerline.plans import pipelines
from ledgerline.sources import markets as market_sources
from ledgerline.streaming import market_ingest

EVENTS = [
    {"id": 1, "title": "2024 United States Presidential Election", "description": "United States general election.",
     "category": "Politics", "startDate": "2024-01-01T00:00:00Z", "endDate": "2024-11-05T00:00:00Z",
     "liquidityClob": "10", "markets": [
        {"id": 11, "question": "Will Donald Trump win the 2024 US presidential election?",
         "description": "Resolves per AP. Donald Trump vs Kamala Harris.", "outcomes": "[\"Yes\", \"No\"]",
         "outcomePrices": "[\"1\", \"0\"]", "clobTokenIds": "[\"a\", \"b\"]", "closedTime": "2024-11-06 12:00:00+00",
         "volume": "1000.5", "liquidityAmm": "0"},
        {"id": 12, "question": "Will Kamala Harris win?", "outcomes": "['Yes', 'No']",
         "outcomePrices": "[\"0\", \"1\"]", "volume": 5}]},
    {"id": 2, "title": "Super Bowl", "category": "Sports", "endDate": "2024-02-11",
     "markets": [{"id": 21, "question": "Will the Chiefs win?", "outcomes": "[\"Yes\", \"No\"]",
                  "outcomePrices": "[\"0.9\", \"0.1\"]"}]},
    {"id": 3, "title": "Empty election event", "markets": None},
]
ANALYTICS = {"data": [
    {"market_id": "11", "event_tags": ["Elections", "Politics"], "market_volume": "999"},
    {"market_id": "12", "event_tags": "President, Senate"},
    {"market_id": "21", "event_tags": ["NFL"]},
    {"market_id": "11", "event_tags": ["Elections"], "market_volume": "1001"},
]}


def _land(workdir):
    ev_dir, an_dir = f"{workdir}/events", f"{workdir}/analytics"
    os.makedirs(ev_dir)
    os.makedirs(an_dir)
    with open(f"{ev_dir}/page-0.json", "w") as f:
        for e in EVENTS:
            f.write(json.dumps(e) + "\n")
    with open(f"{an_dir}/snapshot.json", "w") as f:
        json.dump(ANALYTICS, f)
    return ev_dir, an_dir


def test_market_dataset(spark, workdir):
    ev_dir, an_dir = _land(workdir)
    events = market_sources.read_events(spark, ev_dir)
    analytics = market_sources.read_analytics(spark, an_dir)
    dataset, catalog = pipelines.build_market_dataset(events, analytics, "2025-01-01 00:00:00")
    rows = {r.market_id: r for r in dataset.collect()}
    assert set(rows) == {"11", "12"}
    m11, m12 = rows["11"], rows["12"]
    assert m11.winning_outcome == "Yes" and m12.winning_outcome == "No"
    assert m11.liquidity_amm is None  # '0' falls back to the (missing) event value
    assert m11.analytics_market_volume == 1001.0  # the later entry wins
    # "presidential" is not the word "president"; market 12's tags say President
    assert m11.office is None and m12.office == "President"
    # default span finder: capitalised runs; excluded words ("Elections") dropped
    assert "Kamala Harris" in m11.candidate_names and "Elections" not in m11.candidate_names
    assert m12.closed_time == "2024-11-05T00:00:00+00:00"
    assert m11.jurisdiction == "United States" and m11.jurisdiction_feasibility == "High"
    assert len(m11.jurisdiction_sources) == 3
    assert dataset.columns[0] == "event_id" and len(dataset.columns) == 37
    cat = catalog.collect()
    assert [c.jurisdiction for c in cat] == ["United States"]

    pipelines.run_markets(spark, ev_dir, an_dir, f"{workdir}/out/markets", f"{workdir}/out/catalog",
                          "2025-01-01 00:00:00")
    back = spark.read.option("header", "true").csv(f"{workdir}/out/markets.csv")
    assert back.count() == 2
    src = back.filter("market_id = '11'").first()
    assert src.jurisdiction_sources.count("|") == 2
    assert src.outcomes == "['Yes', 'No']"
    js = spark.read.json(f"{workdir}/out/markets.json")
    assert js.count() == 2
    assert spark.read.option("header", "true").csv(f"{workdir}/out/catalog.csv").count() == 3


def test_market_gate_without_analytics(spark, workdir):
    ev_dir, _ = _land(workdir)
    events = market_sources.read_events(spark, ev_dir)
    dataset, _ = pipelines.build_market_dataset(events, None, "2025-01-01 00:00:00")
    assert sorted(r.market_id for r in dataset.collect()) == ["11", "12"]


def test_streaming_ingest(spark, workdir):
    ev_dir, an_dir = _land(workdir)
    analytics = market_sources.read_analytics(spark, an_dir)
    out = f"{workdir}/stream_out"
    q = market_ingest.start_market_ingest(spark, ev_dir, out, analytics, checkpoint=f"{workdir}/ckpt")
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert sorted(r.market_id for r in first.collect()) == ["11", "12"]
    # a new page lands; a second run picks up only the new file
    with open(f"{ev_dir}/page-1.json", "w") as f:
        f.write(json.dumps({"id": 4, "title": "Senate race", "markets": [
            {"id": 41, "question": "Who wins the seat?"}]}) + "\n")
    q = market_ingest.start_market_ingest(spark, ev_dir, out, analytics, checkpoint=f"{workdir}/ckpt")
    q.awaitTermination(120)
    ids = sorted(r.market_id for r in spark.read.parquet(out).collect())
    assert ids == ["11", "12"]  # 41 has no analytics entry, so the tag gate drops it
    assert len(glob.glob(f"{workdir}/ckpt/commits/*")) == 2


def test_indented_event_pages_are_read_or_refused(spark, workdir):
    pages = os.path.join(workdir, "pages")
    os.makedirs(pages)
    with open(os.path.join(pages, "page.json"), "w") as out:
        json.dump(EVENTS, out, indent=2)
    ids = [r.id for r in market_sources.read_events(spark, pages, multi_line=True).collect()]
    assert ids == ["1", "2", "3"]
    with pytest.raises(Exception, match="(?i)malformed"):
        market_sources.read_events(spark, pages).collect()

    lines = os.path.join(workdir, "lines")
    os.makedirs(lines)
    with open(os.path.join(lines, "page.json"), "w") as out:
        out.write(json.dumps(EVENTS) + "\n" + json.dumps(EVENTS[1]) + "\n")
    assert sorted(r.id for r in market_sources.read_events(spark, lines).collect()) == ["1", "2", "2", "3"]
