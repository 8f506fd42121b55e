"""Quality rules at host level with an empirical beta prior (operator 1).

Every document is measured and judged by its own base rules. Failures of each
host-level rule are counted by host, a beta prior is fitted to the hosts' raw
rates by the method of moments, weighted by the hosts' documents, and each
host's rate is shrunk towards it: (failures + a) / (documents + a + b). A host
is rejected by a rule whose shrunk rate, less ``z`` posterior standard
deviations, is over the rule's limit; documents of rejected hosts go with it.
DataFrame functions only: repeats within a text are found in the row itself,
and only counts are shuffled.

Defined results: null and empty texts have no words (and so fail the base
rule). A null host is a host of its own. Repeated rows count and are returned
each. With no documents there is no prior and no host. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import let, window_hashes
from .store import written

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# What a host is judged by: a rule's condition over the measures, and the
# failure rate over which the host is rejected.
HOST_RULES: dict[str, tuple[str, float]] = {
    "few_words": (f"n_words < {MIN_WORDS}", 0.5),
    "repeated_words": (f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words", 0.5),
    "repeated_lines": ("n_dup_lines >= 3 and 10 * n_dup_lines > n_words", 0.5),
    "symbols": ("5 * n_symbols > n_words", 0.5),
    "word_length": ("n_words > 0 and (word_chars < 3 * n_words or word_chars > 12 * n_words)", 0.5),
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def repeated_words(words: Column, width: int = 8) -> Column:
    """Words inside windows of ``width`` words that the text has twice or more.

    Windows are compared by a 64-bit hash. Only texts with a repeat sort their
    windows; equal ones are then neighbours, and the words that the repeated
    windows cover are counted in order of position."""

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def repeated(a: Column) -> Column:
            same = lambda x, i: F.coalesce(x["h"] == F.get(a, i)["h"], F.lit(False))
            return F.transform(F.filter(a, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"])

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        add = lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(width), at - acc["last"])).alias("n"))
        return F.aggregate(F.array_sort(let(ordered, repeated)), start, add, lambda acc: acc["n"])

    return let(window_hashes(words, width), lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(covered(h)))


def measured(docs: DataFrame, id_col: str, text_col: str, host: Column) -> DataFrame:
    """(doc_id, host, and the measures as long) per document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    symbols = F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))
    return rows.select("doc_id", "host", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                       symbols.cast("long").alias("n_symbols"), repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
                       repeated_words(F.col("words")).cast("long").alias("n_repeat_words"))


def shrunk_rates(counts: DataFrame, rules: Mapping[str, tuple[str, float]], z: float) -> DataFrame:
    """(host, and for each rule its shrunk rate, and whether it rejects the
    host) from (host, n, and each rule's failures)."""
    total = F.sum("n")
    moments = []
    for rule in rules:
        rate = F.col(rule) / F.col("n")
        mean = F.sum(rule) / total
        moments += [mean.alias(f"{rule}_mean"), (F.sum(F.col("n") * rate * rate) / total - mean * mean).alias(f"{rule}_var")]
    row = counts.agg(F.count("*").alias("hosts"), total.alias("total"), *moments).first()
    out = counts
    for rule, (_, limit) in rules.items():
        mean = row[f"{rule}_mean"] or 0.0
        # between-host variance: what the raw rates show less what chance adds
        spread = (row[f"{rule}_var"] or 0.0) - mean * (1 - mean) * (row["hosts"] or 0) / max(row["total"] or 1, 1)
        inner = mean * (1 - mean)
        strength = min(max(inner / spread - 1, 1.0), 1e6) if spread > 0 and inner > 0 else 1e6 if inner > 0 else 1.0
        a, b = F.lit(max(mean * strength, 1e-3)), F.lit(max((1 - mean) * strength, 1e-3))
        n = F.col("n") + a + b
        rate = (F.col(rule) + a) / n
        out = out.withColumn(f"{rule}_rate", rate).withColumn(f"{rule}_rejects", rate - z * F.sqrt(rate * (1 - rate) / (n + 1)) > limit)
    return out


def host_verdicts(measures: DataFrame, rules: Mapping[str, tuple[str, float]] = HOST_RULES, z: float = 2.0) -> DataFrame:
    """(host, n, ..., host_rejected) for every host of the measures."""
    counts = measures.groupBy("host").agg(F.count("*").alias("n"), *[F.count(F.when(F.expr(test), 1)).alias(rule) for rule, (test, _) in rules.items()])
    rated = shrunk_rates(counts, rules, z)
    rejects = F.lit(False)
    for rule in rules:
        rejects = rejects | F.col(f"{rule}_rejects")
    return rated.withColumn("host_rejected", rejects)


def host_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, rules: Mapping[str, tuple[str, float]] = HOST_RULES, z: float = 2.0) -> DataFrame:
    """(doc_id, measures, base_failed, host_rejected, kept) per document.

    The verdict goes back by a join with the rejected hosts alone; a host with
    a third of all documents is one row there, and its side of the join is
    split by the session's adaptive skew handling."""
    host = F.col("source") if host is None else host
    measures = written(measured(docs, id_col, text_col, host), "host-measures")
    rejected = host_verdicts(measures, rules, z).where("host_rejected").select(F.col("host").alias("bad_host"), F.lit(True).alias("rejected"))
    judged = measures.join(rejected, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    bad_host = F.coalesce("rejected", F.lit(False))
    return judged.select("doc_id", *BASE, failed.alias("base_failed"), bad_host.alias("host_rejected"), (~failed & ~bad_host).alias("kept"))
