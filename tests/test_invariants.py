"""Properties the facts and the linkage must satisfy on whole tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import facts
from ledgerline.plans import market_queries, standins


def test_summary_parts_bounded_by_total(spark):
    s = facts.candidate_cycle_summary(standins.receipts(spark, SF_SMALL))
    bad = s.filter(
        F.col("individual_receipts") + F.col("committee_receipts") + F.col("party_receipts")
        > F.col("total_receipts") + F.lit(1e-6)
    )
    assert bad.count() == 0


def test_details_sum_back_to_summary(spark):
    r = standins.receipts(spark, SF_SMALL)
    s = facts.candidate_cycle_summary(r)
    d = facts.candidate_committee_details(r).groupBy("candidate_id", "cycle").agg(
        F.sum(F.col("receipts").cast("decimal(38,2)")).cast("double").alias("r"),
        F.sum("transactions").alias("n"),
    )
    j = s.join(d, ["candidate_id", "cycle"], "full")
    assert j.filter((F.col("r") != F.col("total_receipts")) | (F.col("n") != F.col("transaction_count"))
                    | F.col("r").isNull() | F.col("total_receipts").isNull()).count() == 0


def test_top_contributors_at_most_twenty(spark):
    top = facts.top_contributors(standins.receipts(spark, SF_SMALL, candidate="nation"))
    per = top.groupBy("candidate_id", "cycle").count()
    assert per.filter(F.col("count") > 20).count() == 0
    assert per.filter(F.col("count") == 20).count() > 0


def test_every_market_survives_linkage(spark):
    linked = market_queries.q_market_links(spark, SF_SMALL)
    markets = standins.link_markets_input(spark, SF_SMALL)
    assert linked.select("market_id").distinct().count() == markets.count()
