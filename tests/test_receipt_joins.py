"""J3-J5 beyond the broadcast limit: the same rows, the receipts shuffled once."""

import random

from ledgerline.operators import receipts
from ledgerline.plans import standins

from conftest import SF_SMALL


def sides(spark, seed=4):
    rng = random.Random(seed)
    raw = standins.raw_receipts(spark, SF_SMALL).limit(0)
    names = raw.columns
    row = lambda **kw: tuple(kw.get(c) for c in names)
    rows = [row(committee_id=rng.choice([1, 1, 1, 1, 2, 3, 9, None]), candidate_id=rng.choice([None, None, 10, 11, 99]), two_year_transaction_period=rng.choice([2022, 2024, None]),
                entity_type="IND", contributor_name=f"N{i}", contribution_receipt_amount=rng.choice(["5", "x", None]), candidate_name=rng.choice([None, "own"]),
                recipient_committee_type=rng.choice([None, "T"])) for i in range(400)]
    links = [(10, 1, 2022), (11, 1, 2022), (12, 1, 2024), (None, 2, 2022), (13, 2, 2024), (10, None, 2022), (11, 4, None)]
    cand = [(i, c, *[f"{k}{i}{c}" for k in range(9)]) for i in (10, 11, 13, 99) for c in (2022, 2024)] + [(None, 2022, *["null"] * 9), (99, 2024, *["twice"] * 9)]
    cmte = [(i, c, f"ct{i}", f"ot{c}", None) for i in (1, 3) for c in (2022, 2024)] + [(None, 2022, "n", "n", "n"), (3, 2024, "again", None, "d")]
    columns = ", ".join(f"{d} string" for _, d in receipts.CANDIDATE_BACKFILL)
    return (spark.createDataFrame(rows, raw.schema).repartition(3), spark.createDataFrame(links, "cand_id long, cmte_id long, cycle int"),
            spark.createDataFrame(cand, f"cand_id long, cycle int, {columns}"), spark.createDataFrame(cmte, "cmte_id long, cycle int, committee_type string, org_type string, designation string"))


def test_one_join_equals_three(spark):
    args = sides(spark)
    three = receipts._flat_columns(receipts._joined_in_turn(args[0], *_prefixed(args)), args[0].columns)
    once = receipts.build_schedule_a_flat(*args, broadcast_limit=0)
    assert once.columns == three.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, three.collect())) and once.count() > 450


def _prefixed(args):
    from pyspark.sql import functions as F

    _, links, cand, cmte = args
    return (links.select(F.col("cand_id").alias("cc_cand_id"), F.col("cmte_id").alias("cc_cmte_id"), F.col("cycle").alias("cc_cycle")),
            cand.select(F.col("cand_id").alias("cd_cand_id"), F.col("cycle").alias("cd_cycle"), *[F.col(d).alias(f"cd_{d}") for _, d in receipts.CANDIDATE_BACKFILL]),
            cmte.select(F.col("cmte_id").alias("cm_cmte_id"), F.col("cycle").alias("cm_cycle"), *[F.col(d).alias(f"cm_{d}") for _, d in receipts.COMMITTEE_BACKFILL]))


def test_linked_receipts_are_not_shuffled_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flat = receipts.build_schedule_a_flat(*sides(spark), broadcast_limit=0)
        plan = flat._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # what is left to join are receipts without a link that name a candidate
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1 and plan.count("Scan parquet") == 2


def test_the_summary_writes_only_what_it_uses(spark, monkeypatch):
    """beyond the broadcast limit the joined receipts are written; what the
    summary has no use for is not among them, nor a total of each candidate."""
    from ledgerline.operators import common
    from ledgerline.plans import driver_queries

    want = sorted(map(str, driver_queries.q_receipts_flat(spark, SF_SMALL).collect()))
    written = {}

    def published(spark, df, name, **options):
        written[name] = df
        return writers_published(spark, df, name, **options)

    writers_published = receipts.published
    monkeypatch.setattr(receipts, "published", published)
    monkeypatch.setattr(standins, "published", published)
    monkeypatch.setattr(common, "DEFAULT_BROADCAST_LIMIT", 0)
    got = sorted(map(str, driver_queries.q_receipts_flat(spark, SF_SMALL).collect()))
    assert got == want
    unused = {"contributor_name", "contribution_receipt_date", "report_year", "report_type", "entity_type"}
    assert not unused & set(written["receipts-by-committee"].schema["sa"].dataType.names)
    assert written["committee_cycles"].columns == ["committee_id", "two_year_transaction_period"] and "committee_candidate_totals" not in written
