"""Shared DataFrame building blocks: size-checked broadcast, deterministic
dedup, union by name, exact sums."""

from __future__ import annotations

import logging
from functools import reduce
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOGGER = logging.getLogger("ledgerline")

# Dimensions above this planner estimate are joined with a shuffle instead;
# AQE can still turn that join into a broadcast once runtime sizes are known.
DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024

# Parquet/ORC scans are estimated at their (compressed) file size; decoded
# rows are several times larger, so estimates are scaled by this factor
# before they are compared with a broadcast limit.
DECODE_EXPANSION = 10


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run),
    from the plan statistics the planner itself uses for join selection."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return None


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """Whether a side's scaled size estimate is within the limit."""
    size = estimated_bytes(df)
    return size is not None and size * DECODE_EXPANSION <= (DEFAULT_BROADCAST_LIMIT if limit_bytes is None else limit_bytes)


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only for a side whose scaled size estimate is within
    the limit.

    The estimate is multiplied by ``DECODE_EXPANSION`` (columnar files expand
    when decoded), so the hint is given only with a conservative bound. A
    larger side, or one whose size is unknown, is left to the planner
    (sort-merge join; AQE re-plans with runtime statistics and splits skewed
    partitions)."""
    if fits_broadcast(df, limit_bytes):
        return F.broadcast(df)
    LOGGER.info("not broadcasting side of ~%s bytes (limit %s)", estimated_bytes(df), limit_bytes)
    return df


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen deterministically (smallest remaining columns).

    Partial aggregation combines duplicates before the shuffle, so a hot key
    costs one row per map task, not one task holding all its rows."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Left fold of unionByName; all rows kept, unequal columns fail."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


# amounts are summed exactly as far as a decimal with twelve places holds them
AMOUNT = "decimal(38,12)"
# whole cents below this are summed as two integers: 20 low bits, and the rest
CENTS_LIMIT = 1e9
LOW_BITS = 20
# what an exact sum is kept as; each part is a plain sum, so parts can be merged
SUM_PARTS = ("high", "low", "whole", "rest")


def sum_terms(amount: Column) -> dict[str, Column]:
    """What a double amount adds to each part of an exact sum: whole cents go
    to ``high`` and ``low`` (integers, exact for 2**43 amounts), other amounts
    that a decimal with twelve places holds unchanged to ``whole``, and smaller
    fractions, NaN and infinities to ``rest``."""
    d = amount.cast("double")
    cents = F.when(F.abs(d) < CENTS_LIMIT, F.round(d * 100)).cast("long")
    is_cents = F.coalesce(cents.cast("double") / 100 == d, F.lit(False))
    held = F.when(~is_cents, d.try_cast(AMOUNT))
    exact = F.coalesce(held.cast("double") == d, F.lit(False))
    return {
        "high": F.when(is_cents, F.shiftright(cents, LOW_BITS)),
        "low": F.when(is_cents, cents.bitwiseAND(F.lit((1 << LOW_BITS) - 1))),
        "whole": F.when(exact, held),
        "rest": F.when(~is_cents & ~exact, d),
    }


def merged_sum(parts: dict[str, Column]) -> Column:
    """The double that the summed parts stand for; NULL if all are NULL."""
    cents = parts["high"].cast("decimal(38,0)") * F.lit(1 << LOW_BITS).cast("decimal(7,0)") + parts["low"].cast("decimal(20,0)")
    in_cents = (cents / F.lit(100).cast("decimal(3,0)")).cast(AMOUNT)
    # one digit less on each side leaves the sum its twelve places
    narrow = "decimal(37,12)"
    both = (in_cents.try_cast(narrow) + parts["whole"].try_cast(narrow)).cast("double")
    exact = (F.when(in_cents.isNull(), parts["whole"].cast("double")).when(parts["whole"].isNull(), in_cents.cast("double"))
             .otherwise(F.coalesce(both, in_cents.cast("double") + parts["whole"].cast("double"))))
    return F.when(parts["rest"].isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + parts["rest"])


def exact_sum(amount: Column) -> Column:
    """Sum of double amounts as a double. Amounts that a decimal with twelve
    places holds unchanged are summed exactly, so the result does not depend
    on partitioning; what it can't hold (smaller fractions, NaN, infinities)
    is summed as doubles and shows in the result. All NULL gives NULL."""
    return merged_sum({part: F.sum(term) for part, term in sum_terms(amount).items()})


def is_missing_path(error: Exception) -> bool:
    """True only for 'no such path'; any other failure to read is an error."""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
