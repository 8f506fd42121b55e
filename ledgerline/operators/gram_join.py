"""``search_text ILIKE pattern`` as an exact, skew-safe equi-join.

A theta join has no key, so one is derived. Every literal run of a pattern
must occur in a matching text, in the order of the runs; so must each n-gram
of a run (n = 3, or the run's length when that is shorter), and a gram that
stands before another in the pattern must have an occurrence before one of the
other's in the text. The join is a prefix filter on these grams:

* the distinct texts are exploded once to their grams, keeping only grams
  that some pattern has, each with its first and last place: the posting
  lists, written to the shared folder and read from there by every later step;
* a pattern probes with its rarest gram. If that gram's posting list is longer
  than ``hot``, the pattern probes with its ``prefix`` rarest grams together,
  in their order: only texts that hold all of them at fitting places are in
  the list of that composite key;
* a key whose list is still longer than ``hot`` is split by a hash of the text
  into as many parts as it takes; its patterns go to every part, its texts to
  one. No task gets a whole long list.

Each pattern has one key and each text one posting for it, so no pair comes
twice; ``ilike`` in the join condition keeps the real matches. Texts that
occur in many rows are matched once and joined back to their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import published
from .common import broadcast_if_small

HOT_POSTINGS = 1 << 16  # texts of one key that a task may get
PREFIX = 2  # rarest grams that a pattern with a hot gram probes with


def placed_grams(text: Column, n: int) -> Column:
    """The n-grams of a text in order, overlapping; [] when it is shorter.

    One regex with a zero-width look-ahead yields every overlapping n-gram
    (a built-in, compiled expression; no per-element lambda)."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1)


def literal_runs(pattern: Column) -> Column:
    """Runs of literal characters of a LIKE pattern (split at % and _);
    runs containing the escape character are left out."""
    runs = F.flatten(F.transform(F.split(pattern, "%"), lambda s: F.split(s, "_")))
    return F.filter(runs, lambda r: (F.length(r) > 0) & ~r.contains("\\"))


def pattern_grams(patterns: DataFrame) -> DataFrame:
    """(pattern, gram, place): the distinct grams of a pattern, each with the
    (run, position) at which it stands first."""
    runs = patterns.select("pattern", F.posexplode(literal_runs(F.lower("pattern"))).alias("run", "literal"))
    n = F.length("literal")
    of_run = F.when(n >= 3, placed_grams(F.col("literal"), 3)).otherwise(F.array("literal"))
    placed = runs.select("pattern", "run", F.posexplode(of_run).alias("at", "gram"))
    return placed.groupBy("pattern", "gram").agg(F.min(F.struct("run", "at")).alias("place"))


def posting_lists(texts: DataFrame, needed: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """(gram, search_text, first, last): where the needed grams stand in each
    text, first and last."""
    low = F.lower("search_text")
    every = F.array_distinct(F.concat(*[placed_grams(low, n) for n in (3, 2, 1)]))
    exploded = texts.select("search_text", F.explode(every).alias("gram"))
    kept = exploded.join(broadcast_if_small(needed, broadcast_limit), "gram", "left_semi")
    last = F.length(low) - F.instr(F.reverse(low), F.reverse("gram")) - F.length("gram") + 2
    return kept.select("gram", "search_text", F.instr(low, F.col("gram")).alias("first"), last.alias("last"))


def probe_keys(grams: DataFrame, postings: DataFrame, hot: int, prefix: int, broadcast_limit: int | None = None) -> DataFrame:
    """(pattern, key): the grams that each pattern probes with, in the
    order of the pattern; patterns with a gram that no text has are gone."""
    frequency = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rated = grams.join(broadcast_if_small(frequency, broadcast_limit), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # a pattern has no more grams than characters
    ranked = rated.groupBy("pattern").agg(F.sort_array(F.collect_list(F.struct("n", "gram", "place"))).alias("grams"))
    rarest = F.col("grams")[0]
    members = F.when(rarest["n"] > hot, F.slice("grams", 1, prefix)).otherwise(F.slice("grams", 1, 1))
    in_order = F.array_sort(F.transform(members, lambda g: F.struct(g["place"].alias("place"), g["gram"].alias("gram"))))
    return ranked.where(rarest["n"] > 0).select("pattern", F.transform(in_order, lambda g: g["gram"]).alias("key"))


def keyed_postings(keys: DataFrame, postings: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """(key, search_text): the texts that hold all grams of a key at places
    that fit their order."""
    wanted = keys.select("key").distinct()
    single = wanted.where(F.size("key") == 1).select("key", F.col("key")[0].alias("gram"))
    lists = postings.join(broadcast_if_small(single, broadcast_limit), "gram").select("key", "search_text")
    composite = wanted.where(F.size("key") > 1)
    # the grams of composite keys, gathered per text: at most as many as it has characters
    members = composite.select(F.explode("key").alias("gram")).distinct()
    held = postings.join(broadcast_if_small(members, broadcast_limit), "gram", "left_semi").groupBy("search_text").agg(
        F.map_from_entries(F.collect_list(F.struct("gram", F.struct("first", "last")))).alias("held"))
    # a key meets the texts that have its last gram; the others are looked up
    last_gram = composite.select("key", F.element_at("key", -1).alias("gram"))
    texts = held.select("search_text", "held", F.explode(F.map_keys("held")).alias("gram"))
    place = lambda gram: F.col("held")[gram]
    seams = F.transform(F.sequence(F.lit(1), F.size("key") - 1), lambda i: place(F.col("key")[i - 1])["first"] < place(F.col("key")[i])["last"])
    fits = F.forall("key", lambda g: place(g).isNotNull()) & F.forall(seams, lambda ok: ok)
    both = texts.join(broadcast_if_small(last_gram, broadcast_limit), "gram").where(fits).select("key", "search_text")
    return lists.unionAll(both)


def ilike_pairs(patterns: DataFrame, texts: DataFrame, broadcast_limit: int | None = None, hot: int = HOT_POSTINGS, prefix: int = PREFIX) -> DataFrame:
    """(pattern, search_text) of all matches between distinct patterns and
    distinct texts. Patterns without any literal character would match every
    text and are not accepted here."""
    spark = patterns.sparkSession
    grams = pattern_grams(patterns)
    postings = published(spark, posting_lists(texts, grams.select("gram").distinct(), broadcast_limit), "postings")
    keys = published(spark, probe_keys(grams, postings, hot, prefix, broadcast_limit), "probe-keys")
    lists = keyed_postings(keys, postings, broadcast_limit)
    # parts of a long list: its texts are dealt by their hash, its patterns to all parts
    parts = lists.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("parts")).where("parts > 1")
    parts = published(spark, parts, "hot-keys")  # at most one for each `hot` postings
    n_parts = F.coalesce("parts", F.lit(1))

    def split(df: DataFrame, part: Column) -> DataFrame:
        return df.join(broadcast_if_small(parts, broadcast_limit), "key", "left").withColumn("part", part).drop("parts")

    dealt = split(lists, F.pmod(F.xxhash64("search_text"), n_parts).cast("int"))
    probes = split(keys, F.explode(F.sequence(F.lit(0), n_parts - 1)))
    matched = dealt.join(broadcast_if_small(probes, broadcast_limit), ["key", "part"])
    return matched.where(F.ilike(F.col("search_text"), F.col("pattern"))).select("pattern", "search_text")


def ilike_join(patterns: DataFrame, candidates: DataFrame, broadcast_limit: int | None = None, hot: int = HOT_POSTINGS, prefix: int = PREFIX) -> DataFrame:
    """All (pattern, candidate) pairs with ``search_text ILIKE pattern``.

    ``patterns`` has a ``pattern`` column (distinct values); ``candidates`` a
    ``search_text`` column."""
    texts = candidates.where(F.col("search_text").isNotNull()).select("search_text").distinct()
    pairs = ilike_pairs(patterns, texts, broadcast_limit, hot, prefix)
    return candidates.join(pairs, "search_text").select("pattern", *candidates.columns)
