"""Lookup queries over the published tables (X6: F8-F10, J6, O1-O5).

Each function returns a DataFrame; the original served the same four
queries from a relational database. Filters on the candidate id and the
cycle partition column reach the Parquet scan (partition pruning), and a
``limit`` after an ``orderBy`` plans as a bounded top-k.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_query

SEARCH_COLUMNS = (
    "cand_id", "cycle", "display_name", "normalized_name", "party", "office", "office_full",
    "state", "district", "candidate_election_year",
)
SUMMARY_CANDIDATE_COLUMNS = ("cand_id", "cycle", "display_name", "party", "office", "office_full", "state", "district")
SUMMARY_FACT_COLUMNS = (
    "total_receipts", "individual_receipts", "committee_receipts", "party_receipts", "transaction_count",
)


def search_order():
    # the store sorted NULL cycles first on DESC; the id makes the order total
    return [F.col("cycle").desc_nulls_first(), F.col("display_name").asc_nulls_last(), F.col("cand_id").asc_nulls_last()]


def search_candidates(candidate_dim: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """O1/O2/F8/C4: candidates whose search text ILIKE the name pattern."""
    pattern = normalize_query(F.lit(name))
    hits = candidate_dim.filter(F.ilike(F.col("search_text"), pattern)).select(*SEARCH_COLUMNS)
    ordered = hits.orderBy(*search_order())
    return ordered.limit(limit) if limit is not None else ordered


def candidate_summary(candidate_dim: DataFrame, summary: DataFrame, cand_id) -> DataFrame:
    """A candidate's cycles with their receipt summary (left join).
    An empty result means "not found" to the caller."""
    cands = candidate_dim.filter(F.col("cand_id") == F.lit(cand_id)).select(*SUMMARY_CANDIDATE_COLUMNS)
    facts = summary.filter(F.col("candidate_id") == F.lit(cand_id)).select(
        F.col("candidate_id").alias("_sid"), F.col("cycle").alias("_scycle"), *SUMMARY_FACT_COLUMNS
    )
    joined = cands.join(facts, (F.col("cand_id") == F.col("_sid")) & (F.col("cycle") == F.col("_scycle")), "left")
    return joined.select(*SUMMARY_CANDIDATE_COLUMNS, *SUMMARY_FACT_COLUMNS).orderBy(F.col("cycle").desc_nulls_first())


def schedule_a_history(
    flat: DataFrame,
    cand_id,
    cycles: Iterable[int] | None = None,
    limit: int = 200,
    page: int = 1,
    tie_breaker: str | list | None = "sub_id",
) -> DataFrame:
    """One page of a candidate's receipts, newest date text first.

    The date is compared as text, NULL first on DESC (Q8); ``tie_breaker``
    makes pages stable."""
    if limit < 1 or page < 1:
        raise ValueError("limit and page must be >= 1")
    rows = flat.filter(F.col("candidate_id") == F.lit(cand_id))
    cycle_list = list(cycles) if cycles else None
    if cycle_list:
        rows = rows.filter(F.col("two_year_transaction_period").isin(cycle_list))
    order = [F.col("contribution_receipt_date").desc_nulls_first()]
    ties = [tie_breaker] if isinstance(tie_breaker, str) else list(tie_breaker or [])
    order += [F.col(c).asc_nulls_last() for c in ties if c in flat.columns]
    return rows.orderBy(*order).offset((page - 1) * limit).limit(limit)


def top_contributors_lookup(top: DataFrame, cand_id, limit: int = 20) -> DataFrame:
    """A candidate's top contributors, latest cycle first."""
    rows = top.filter(F.col("candidate_id") == F.lit(cand_id)).select(
        "candidate_id", "cycle", "contributor_name", "entity_type", "total_amount"
    )
    return rows.orderBy(
        F.col("cycle").desc_nulls_first(),
        F.col("total_amount").desc_nulls_first(),
        F.col("contributor_name").asc_nulls_last(),
        F.col("entity_type").asc_nulls_last(),
    ).limit(limit)
