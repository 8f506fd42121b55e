"""Paging through a candidate's receipts by key.

``lookup.schedule_a_history`` skips ``offset`` rows, so a late page sorts all
that come before it. Here a page begins where the last one ended: its token
holds the sort key of the last row, and the next page asks for the rows from
that key on. ``write_history`` stores the receipts clustered by the same
order, (candidate, date, tie-breaker), in small row groups, whose statistics
let Parquet leave out everything but the candidate's rows near the key; page
1,000 reads as little as page 1.

The order is that of the offset form: date text descending, NULL first, then
the tie-breaker ascending, NULL last. Rows that are alike in all of it are
counted: the token says how many of them were given, so none is lost or given
twice. Rows that land between two pages show on later ones if they belong
there.
"""

from __future__ import annotations

import base64
import json
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATE, DATE, PERIOD = "candidate_id", "contribution_receipt_date", "two_year_transaction_period"
ROW_GROUP_BYTES = 1 << 20
PAGE_ROWS = 2000


def _order(tie: str) -> list[Column]:
    return [F.col(DATE).desc_nulls_first(), F.col(tie).asc_nulls_last()]


def write_history(flat: DataFrame, path: str, tie: str = "sub_id", partitions: int | None = None) -> None:
    """The receipts in page order, for ``history_from``. A candidate with many
    receipts has many files: ranges are cut within it."""
    order = [F.col(CANDIDATE), *_order(tie)]
    ranged = flat.repartitionByRange(partitions, *order) if partitions else flat.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).write.mode("overwrite")
    writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)


def _from_key(date: str | None, tie, tie_col: str) -> Column:
    """Rows at or after a key. Each comparison names its columns alone, so that
    it reaches the files' statistics."""
    d, t = F.col(DATE), F.col(tie_col)
    ties = t.isNull() if tie is None else (t >= F.lit(tie)) | t.isNull()
    if date is None:
        return d.isNotNull() | (d.isNull() & ties)
    return (d < F.lit(date)) | ((d == F.lit(date)) & ties)


def encode_token(date: str | None, tie, given: int) -> str:
    return base64.urlsafe_b64encode(json.dumps([date, tie, given]).encode()).decode()


def decode_token(token: str) -> tuple[str | None, object, int]:
    try:
        date, tie, given = json.loads(base64.urlsafe_b64decode(token.encode()))
    except ValueError as error:
        raise ValueError("not a page token") from error
    return date, tie, int(given)


def history_from(
    history: DataFrame,
    cand_id,
    token: str | None = None,
    cycles: Iterable[int] | None = None,
    limit: int = 200,
    tie: str = "sub_id",
) -> DataFrame:
    """The page that a token begins, or the first one, in order."""
    if limit < 1:
        raise ValueError("limit must be >= 1")
    rows = history.where(F.col(CANDIDATE) == F.lit(cand_id))
    wanted = list(cycles) if cycles else None
    if wanted:
        rows = rows.where(F.col(PERIOD).isin(wanted))
    given = 0
    if token is not None:
        date, last, given = decode_token(token)
        rows = rows.where(_from_key(date, last, tie))
    return rows.orderBy(*_order(tie)).offset(given).limit(limit)


def page(
    history: DataFrame,
    cand_id,
    token: str | None = None,
    cycles: Iterable[int] | None = None,
    limit: int = 200,
    tie: str = "sub_id",
) -> tuple[list, str | None]:
    """(rows, token of the next page): at most ``limit`` rows; no token after
    the last page."""
    rows = history_from(history, cand_id, token, cycles, limit, tie).collect()
    if len(rows) < limit:
        return rows, None
    key = lambda r: (r[DATE], r[tie])
    alike = 0
    for r in reversed(rows):
        if key(r) != key(rows[-1]):
            break
        alike += 1
    if alike == len(rows) and token is not None:
        date, last, given = decode_token(token)
        if (date, last) == key(rows[-1]):
            alike += given
    return rows, encode_token(*key(rows[-1]), alike)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
