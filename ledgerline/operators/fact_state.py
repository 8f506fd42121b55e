"""Facts kept up to date with receipts as they land.

Every fact is a group-by of exact sums, and an exact sum is four plain sums
(``common.SUM_PARTS``), so the facts of a batch and those of everything before
merge by adding up. ``FactState`` keeps, for each fact, the partial aggregates
of every batch in a folder of its own; a batch counts once its commit file is
there, and a batch that is given again is left alone. ``compact`` merges the
batches into one base.

The top contributors are kept without ranking everything anew. For each
candidate and cycle a head of ``HEAD`` rows per kept row holds the largest
totals, and a bound says what no contributor outside the head exceeds. A batch
adds to the head's rows exactly; a contributor outside it can't have more than
the bound plus the batch's amount. Where the last row of the top stays above
that, the top is exact as it is; only the other candidates that the batch
touched are ranked again from the merged totals.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..sinks.writers import published
from . import facts

KINDS = ("summary", "details", "contributors")
HEAD = 4  # rows of the head for each row of the top
KEY = ("candidate_id", "cycle")
LOWEST = float("-inf")


class FactState:
    def __init__(self, spark: SparkSession, folder: str, limit: int = vocab.TOP_CONTRIBUTORS_LIMIT):
        self.spark, self.folder, self.limit = spark, folder.rstrip("/"), limit
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.ranked_again: DataFrame | None = None  # keys of the last batch that were

    # --- commits ---

    def _numbers(self, kind: str) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.folder}/{kind}/*.json")) or []
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in found)

    def _commit(self, kind: str, number: int, content: dict) -> None:
        stream = self._fs.create(self._path(f"{self.folder}/{kind}/{number}.json"), False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()

    def _content(self, kind: str, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{kind}/{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def batches(self) -> list[int]:
        """The batches that count, in the order of their numbers."""
        return self._numbers("batches")

    def _covered(self) -> tuple[int | None, list[int]]:
        """The last base and the batches in it."""
        bases = self._numbers("bases")
        return (bases[-1], self._content("bases", bases[-1])["batches"]) if bases else (None, [])

    # --- partial aggregates ---

    def _partials(self, kind: str, batches: list[int]) -> DataFrame | None:
        base, covered = self._covered()
        paths = [f"{self.folder}/base-{base}/{kind}"] if base is not None else []
        paths += [f"{self.folder}/batch-{n}/{kind}" for n in batches if n not in covered]
        return self.spark.read.parquet(*paths) if paths else None

    def merged(self, kind: str, batches: list[int] | None = None) -> DataFrame | None:
        partials = self._partials(kind, self.batches() if batches is None else batches)
        return facts.merged_partials(kind, partials) if partials is not None else None

    def fact(self, kind: str) -> DataFrame | None:
        """A fact over all batches; None before the first."""
        merged = self.merged(kind)
        return facts.finished(kind, merged) if merged is not None else None

    def top(self) -> DataFrame | None:
        """The top contributors over all batches."""
        batches = self.batches()
        if not batches:
            return None
        return facts.top_of(self.spark.read.parquet(f"{self.folder}/batch-{self._last_head(batches)}/head").drop("bound"), self.limit).select(
            *KEY, "contributor_name", "entity_type", "total_amount")

    def _last_head(self, batches: list[int]) -> int:
        """Heads follow the order of the commits, not of the batch numbers."""
        return max(batches, key=lambda n: self._content("batches", n)["order"])

    def apply(self, batch: int, flat: DataFrame) -> bool:
        """Adds a batch of flat receipts; False if it counts already."""
        done = self.batches()
        if batch in done:
            return False
        for kind in KINDS:
            facts.partial_fact(kind, flat).write.mode("overwrite").parquet(f"{self.folder}/batch-{batch}/{kind}")
        head = self._head(batch, done)
        head.write.mode("overwrite").parquet(f"{self.folder}/batch-{batch}/head")
        self._commit("batches", batch, {"order": 1 + max((self._content("batches", n)["order"] for n in done), default=0)})
        return True

    # --- top contributors ---

    def _head(self, batch: int, done: list[int]) -> DataFrame:
        """(key, contributor, parts, total, bound): the heads after a batch."""
        delta = self.spark.read.parquet(f"{self.folder}/batch-{batch}/contributors")
        if not done:
            return self._ranked(delta)
        parts = [c for c in delta.columns if c.startswith("total_amount_")]
        names = [*KEY, "contributor_name", "entity_type"]
        old = self.spark.read.parquet(f"{self.folder}/batch-{self._last_head(done)}/head")
        bounds = old.groupBy(*KEY).agg(F.max("bound").alias("bound"))
        both = old.select(*names, *parts, F.lit(1).alias("inside"), F.lit(0).alias("touched")).unionByName(delta.select(*names, *parts, F.lit(0).alias("inside"), F.lit(1).alias("touched")))
        added = both.groupBy(*names).agg(*[F.sum(c).alias(c) for c in parts], F.max("inside").alias("inside"), F.max("touched").alias("touched"))
        total = facts.finished("contributors", added.select(*names, *parts, "inside", "touched"))
        # the parts again beside the total that they stand for
        rows = _same(added, total.select(*names, "total_amount"), names)
        rows = _same(rows, bounds, list(KEY), "left")
        outside = F.coalesce((F.col("inside") == 0) & F.col("bound").isNotNull(), F.lit(False))
        # what a row outside may come to; one without any amount so far starts at zero
        reach = F.when(outside, F.col("total_amount") + F.greatest("bound", F.lit(0.0)))
        rows = published(self.spark, rows.withColumn("outside", outside).withColumn("reach", reach), "fact-heads")
        near = self._cut(rows.where("NOT outside"))
        size = HEAD * self.limit
        ends = near.groupBy(*KEY).agg(
            F.max(F.when(F.col("rank") == self.limit, F.col("total_amount"))).alias("last"),
            F.max(F.when(F.col("rank") > size, F.coalesce("total_amount", F.lit(LOWEST)))).alias("beyond"))
        keys = rows.groupBy(*KEY).agg(F.greatest(F.max("bound"), F.max("reach")).alias("reach"), F.max("touched").alias("touched"))
        keys = _same(keys, ends, list(KEY), "left")
        # NaN is above all numbers, in a rank as in this comparison
        sure = (F.col("touched") == 0) | F.col("reach").isNull() | F.coalesce(F.col("last") > F.col("reach"), F.lit(False))
        keys = published(self.spark, keys.select(*KEY, sure.alias("sure"), F.greatest("reach", "beyond").alias("new_bound")), "fact-keys")
        columns = [*names, *parts, "total_amount"]
        kept = _same(near.where(F.col("rank") <= size).select(*columns), keys.where("sure").select(*KEY, F.col("new_bound").alias("bound")), list(KEY))
        self.ranked_again = keys.where("NOT sure").select(*KEY)
        unsure = self.ranked_again.select(*[F.col(c).alias(f"u_{c}") for c in KEY])
        again = self._ranked(self.merged("contributors", [*done, batch]).join(unsure, _equal(KEY, "u_"), "left_semi"))
        return kept.select(*columns, "bound").unionByName(again.select(*columns, "bound"))

    def _cut(self, rows: DataFrame) -> DataFrame:
        """The rows of the head and one beyond, ranked; map tasks send no more."""
        w = Window.partitionBy(*KEY).orderBy(*facts.contributor_order())
        return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= HEAD * self.limit + 1)

    def _ranked(self, totals: DataFrame) -> DataFrame:
        """Heads and bounds from whole totals."""
        names = [*KEY, "contributor_name", "entity_type"]
        rows = _same(totals, facts.finished("contributors", totals).select(*names, "total_amount"), names)
        near, size = self._cut(rows), HEAD * self.limit
        # the row beyond the head is its bound: totals fall with the rank
        bound = F.max(F.when(F.col("rank") > size, F.coalesce("total_amount", F.lit(LOWEST)))).over(Window.partitionBy(*KEY))
        return near.withColumn("bound", bound).where(F.col("rank") <= size).drop("rank")

    # --- upkeep ---

    def compact(self) -> int | None:
        """Merges all batches into a new base; returns its number. The batches'
        folders stay for readers that opened them."""
        batches = self.batches()
        base, covered = self._covered()
        if not batches or set(batches) == set(covered):
            return base
        number = 0 if base is None else base + 1
        for kind in KINDS:
            self.merged(kind, batches).write.mode("overwrite").parquet(f"{self.folder}/base-{number}/{kind}")
        self._commit("bases", number, {"batches": batches})
        return number


def _equal(keys, prefix: str):
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(prefix + k))
        cond = c if cond is None else cond & c
    return cond


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULLs included; the keys of the left stay."""
    renamed = right.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(renamed, _equal(keys, "r_"), how).drop(*[f"r_{k}" for k in keys])
