"""Dimension tables from the master files.

Dimensions are small next to receipts (thousands to a few million rows),
but they are still built as distributed jobs; duplicates are resolved with
a deterministic choice (Q5) through partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import add_name_parts, normalize_text
from .common import broadcast_if_small, dedup_by_key


def office_full(office: Column) -> Column:
    """P5: P/S/H -> President/Senate/House, anything else NULL."""
    pairs = []
    for code, text in vocab.OFFICE_DESCRIPTIONS:
        pairs += [F.lit(code), F.lit(text)]
    return F.create_map(*pairs)[office]


def committee_role(designation: Column) -> Column:
    """Designation code -> committee role; NULL and others -> 'other'."""
    expr = None
    for codes, role in vocab.COMMITTEE_ROLES:
        cond = designation.isin(*codes)
        expr = F.when(cond, F.lit(role)) if expr is None else expr.when(cond, F.lit(role))
    return expr.otherwise(F.lit(vocab.OTHER_ROLE))


def renamed(df: DataFrame, columns, keys) -> DataFrame:
    """One row per key with the (source, target) columns of a table."""
    return dedup_by_key(df.select(*[F.col(source).alias(target) for source, target in columns]), keys)


def with_name_columns(candidate_master: DataFrame, name_col: str = "CAND_NAME") -> DataFrame:
    """S4 enrichment: the master's columns, the name parts (C3) and the
    normalized name (C1) that they come from."""
    named = add_name_parts(candidate_master.withColumn("normalized_name", normalize_text(F.col(name_col))))
    return named.select(*candidate_master.columns, *vocab.NAME_PART_COLUMNS, "normalized_name")


def build_candidate_dim(candidate_master: DataFrame) -> DataFrame:
    """One row per (cand_id, cycle) with search text and office.

    A master that already has the name columns keeps its own. Otherwise they
    are derived after duplicates are resolved, once per kept row: they are
    functions of the display name, so the choice is the same."""
    columns = list(vocab.CANDIDATE_COLUMNS)
    derived = (*vocab.NAME_PART_COLUMNS, "normalized_name")
    ready = "normalized_name" in candidate_master.columns
    if ready:
        # in their places of the row, which is what duplicates are ordered by
        columns[3:3] = [(c, c) for c in vocab.NAME_PART_COLUMNS]
        columns.insert(-1, ("normalized_name", "normalized_name"))
    dim = renamed(candidate_master, columns, ["cand_id", "cycle"])
    if not ready:
        dim = add_name_parts(dim.withColumn("normalized_name", normalize_text(F.col("display_name"))))
    plain = [target for _, target in vocab.CANDIDATE_COLUMNS]
    order = plain[:3] + list(derived[:-1]) + plain[3:-1] + ["normalized_name", plain[-1]]
    search = F.concat_ws(" ", "normalized_name", "display_name")
    return dim.select(*order, search.alias("search_text"), office_full(F.col("office")).alias("office_full"))


def build_committee_dim(committee_master: DataFrame) -> DataFrame:
    """One row per (cmte_id, cycle)."""
    return renamed(committee_master, vocab.COMMITTEE_COLUMNS, ["cmte_id", "cycle"])


def committee_roles(linkage: DataFrame) -> DataFrame:
    """One row per link and cycle, with the committee's role in it."""
    links = renamed(linkage, vocab.LINKAGE_COLUMNS, ["cand_id", "cmte_id", "cycle"])
    return links.select("*", committee_role(F.col("designation_code")).alias("role"))


def build_candidate_committees(linkage: DataFrame, committee_dim: DataFrame) -> DataFrame:
    """Each link with its committee's attributes; where the
    committee has no type or designation, the link's own codes stand in.

    A join with the candidates' keys would add no column and no row (they are
    unique), so there is none."""
    own = {"committee_type": "committee_type_code", "designation": "designation_code"}
    keys = ["cmte_id", "cycle"]
    links = committee_roles(linkage).join(broadcast_if_small(committee_dim), keys, "left")
    attributes = [F.coalesce(c, own[c]).alias(c) if c in own else F.col(c) for c in committee_dim.columns if c not in keys]
    return links.select(*keys, "cand_id", "role", *attributes, (F.col("role") == "principal").alias("principal_flag"))
