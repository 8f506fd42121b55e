"""A stored index for name search (F8, O1).

``lookup.search_candidates`` tests every row of the candidate dimension. The
index keeps, for each three-letter gram of a search text, the rows that have
it (key, search text and the columns of the search order), in folders by a hash
of the gram, within a folder sorted by gram and descending cycle. A search
reads the folders of its pattern's grams only: the lists are counted in a
table of gram frequencies (in the same folders), the rarest one is read and
its rows are verified with ``ilike``. The full rows of the hits come from a
copy of the dimension in folders by a hash of the key.

Patterns without a run of three letters can't use the index; they fall back to
the scan, so the answer is always that of ``search_candidates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_query
from .gram_join import literal_runs, placed_grams
from .lookup import SEARCH_COLUMNS, search_candidates, search_order

BUCKETS = 256
POSTING_COLUMNS = ("cand_id", "cycle", "display_name", "search_text")
MANY = 1000  # keys that a query names one by one


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class NameIndex:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def build(self, candidate_dim: DataFrame) -> None:
        """Writes the index of a dimension; run it when the dimension is
        published anew."""
        grams = F.array_distinct(placed_grams(F.lower("search_text"), 3))
        exploded = candidate_dim.select(*POSTING_COLUMNS, F.explode(grams).alias("gram")).withColumn("bucket", _bucket(F.col("gram"), self.buckets))
        # ranges cut a long list: no task gets all rows of a frequent gram
        listed = exploded.repartitionByRange("bucket", "gram", F.col("cycle").desc(), "cand_id")
        listed.sortWithinPartitions("bucket", "gram", F.col("cycle").desc(), "cand_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/postings")
        counts = self.spark.read.parquet(f"{self.folder}/postings").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/frequencies")
        rows = candidate_dim.withColumn("key_bucket", _bucket(F.col("cand_id"), self.buckets))
        rows.repartitionByRange("key_bucket", "cand_id").sortWithinPartitions("key_bucket", "cand_id").write.mode("overwrite").partitionBy("key_bucket").parquet(f"{self.folder}/rows")

    def pattern(self, name: str) -> tuple[str, dict[str, int]]:
        """The search pattern of a name, and the grams it needs with their
        folders."""
        pattern = normalize_query(F.lit(name))
        grams = F.flatten(F.transform(F.filter(literal_runs(F.lower(pattern)), lambda r: F.length(r) >= 3), lambda r: placed_grams(r, 3)))
        found = self.spark.range(1).select(pattern.alias("pattern"), F.array_distinct(grams).alias("grams"))
        row = found.select("pattern", F.transform("grams", lambda g: F.struct(g.alias("gram"), _bucket(g, self.buckets).alias("bucket"))).alias("grams")).first()
        return row.pattern, {g.gram: g.bucket for g in row.grams or ()}

    def rarest(self, grams: dict[str, int]) -> tuple[str, int] | None:
        """The gram with the shortest list; None if one has no list at all."""
        counted = self.spark.read.parquet(f"{self.folder}/frequencies").where(F.col("bucket").isin(sorted(set(grams.values()))) & F.col("gram").isin(list(grams)))
        found = {r.gram: r.n for r in counted.select("gram", "n").collect()}  # one row a gram of the pattern
        if len(found) < len(grams):
            return None
        return min(found.items(), key=lambda x: (x[1], x[0]))

    def hits(self, name: str) -> DataFrame | None:
        """Index rows that match; None if the pattern can't use the index."""
        pattern, grams = self.pattern(name)
        if not grams:
            return None
        postings = self.spark.read.parquet(f"{self.folder}/postings")
        least = self.rarest(grams)
        if least is None:
            return postings.where("false")
        listed = postings.where((F.col("bucket") == grams[least[0]]) & (F.col("gram") == least[0]))
        return listed.where(F.ilike(F.col("search_text"), F.lit(pattern)))

    def search(self, name: str, limit: int | None = None) -> DataFrame:
        """What ``search_candidates`` returns over the indexed dimension."""
        rows = self.spark.read.parquet(f"{self.folder}/rows")
        hits = self.hits(name)
        if hits is None:
            return search_candidates(rows, name, limit)
        keys = hits.orderBy(*search_order()).select("cand_id", "cycle")
        if limit is None or limit > MANY:
            keys = keys if limit is None else keys.limit(limit)
            same = (rows.cand_id == F.col("k_id")) & rows.cycle.eqNullSafe(F.col("k_cycle"))
            found = rows.join(keys.select(F.col("cand_id").alias("k_id"), F.col("cycle").alias("k_cycle")).distinct(), same, "left_semi")
        else:
            some = keys.limit(limit).select("cand_id", "cycle", _bucket(F.col("cand_id"), self.buckets).alias("b")).collect()  # at most ``limit`` keys
            wanted = [F.col("cand_id").eqNullSafe(F.lit(r.cand_id)) & F.col("cycle").eqNullSafe(F.lit(r.cycle)) for r in some]
            any_key = wanted[0] if wanted else F.lit(False)
            for w in wanted[1:]:
                any_key = any_key | w
            found = rows.where(F.col("key_bucket").isin(sorted({r.b for r in some})) & F.col("cand_id").isin([r.cand_id for r in some]) & any_key)
        return found.select(*SEARCH_COLUMNS).orderBy(*search_order())
