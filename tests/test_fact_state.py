"""Facts merged batch by batch equal the facts of all receipts."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import common, facts
from ledgerline.operators.fact_state import FactState

FLAT = "candidate_id string, committee_id string, two_year_transaction_period int, report_year string, report_type string, contributor_name string, entity_type string, contribution_receipt_amount double"


def batch(rng, n, names=12):
    amount = lambda: rng.choice([None, 0.1, 25.0, 25.5, -40.25, 1e12, 3.14159, 1 / 3, 100.0, -100.0, 2e-13])
    return [(rng.choice(["H1", "H1", "H1", "S2", "P3", None]), rng.choice(["C1", "C2", None]), rng.choice([2022, 2024]), "2024", rng.choice(["Q1", None]),
             rng.choice([None] + [f"N{i}" for i in range(names)]), rng.choice(["IND", "CAN", "COM", "PTY", "ORG", None]), amount()) for _ in range(n)]


def rows(df):
    """Rows as text; sums beside the exact parts may differ in the last place."""
    return sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in r]) for r in df.collect())


def same(state, flat, limit):
    for kind, fact in (("summary", facts.candidate_cycle_summary(flat)), ("details", facts.candidate_committee_details(flat)), ("contributors", facts.contributor_totals(flat))):
        assert rows(state.fact(kind).select(fact.columns)) == rows(fact), kind
    top = facts.top_contributors(flat, limit)
    assert rows(state.top().select(top.columns)) == rows(top)


def test_batches_equal_the_whole(spark, workdir):
    rng, limit = random.Random(9), 2
    state, seen, again = FactState(spark, f"{workdir}/state", limit), [], []
    assert state.fact("summary") is None and state.top() is None
    for n, (number, size) in enumerate([(5, 150), (1, 4), (9, 60), (2, 0), (7, 3)]):
        now = batch(rng, size, names=40)
        seen += now
        assert state.apply(number, spark.createDataFrame(now, FLAT))
        if state.ranked_again is not None:
            again.append(state.ranked_again.count())
        same(state, spark.createDataFrame(seen, FLAT), limit)
        if n == 2:
            assert state.compact() == 0 and state.compact() == 0
            same(state, spark.createDataFrame(seen, FLAT), limit)
    assert not state.apply(9, spark.createDataFrame(batch(rng, 50), FLAT))  # given again
    same(state, spark.createDataFrame(seen, FLAT), limit)
    assert min(again) < 6  # not every candidate and cycle is ranked again
    same(FactState(spark, f"{workdir}/state", limit), spark.createDataFrame(seen, FLAT), limit)


def test_small_amounts_leave_the_top_alone(spark, workdir):
    """The bound proves the top without ranking; a large amount breaks it."""
    row = lambda name, amount: ("H1", "C1", 2024, "2024", "Q1", name, "IND", float(amount))
    state = FactState(spark, f"{workdir}/state", limit=1)
    first = [row(f"N{i}", 100 - 10 * i) for i in range(9)]
    state.apply(0, spark.createDataFrame(first, FLAT))
    state.apply(1, spark.createDataFrame([row("N7", 5), row("new", 20)], FLAT))
    assert state.ranked_again.count() == 0 and [r.contributor_name for r in state.top().collect()] == ["N0"]
    state.apply(2, spark.createDataFrame([row("N8", 85)], FLAT))  # 20 + 85
    assert state.ranked_again.count() == 1 and [(r.contributor_name, r.total_amount) for r in state.top().collect()] == [("N8", 105.0)]


@pytest.mark.parametrize("amounts,total", [([0.1] * 10, 1.0), ([None, None], None), ([], None), ([1e15, 0.01, -1e15], 0.01), ([-0.01, -0.02, 1e-12], -0.029999999999),
                                           ([1e300, 1.0], 1e300), ([float("inf"), 1.0], float("inf")), ([999999999.99, -0.5, None], 999999999.49), ([-999999999.99] * 3, -2999999999.97)])
def test_exact_sums(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(3)
    assert df.agg(common.exact_sum(F.col("a"))).first()[0] == total
