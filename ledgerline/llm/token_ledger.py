"""Token counts as delta-maintained rollups (operator 7).

A change feed (insert, delete, or revise: the same document with a new text,
source, language or tokenizer version) is turned into signed rows: a delete
takes away what the ledger holds of the document, an insert or a revision puts
the new count in its place. A batch is written once as its signed rows per document and once
as their totals by source, language and tokenizer version, and becomes part of
the ledger only when its commit marker exists. Committing a batch id again is
a no-op; a batch that broke off before its marker is overwritten by its retry.
Totals are the sum over the committed batches' small tables, so a batch costs
its own size, a lookup of its ids, and never a recount. ``compact`` folds
committed batches into one under the same protocol.

Defined results: a null text has no tokens but is a document. Null source and
language are groups of their own. Changes without a document id, and deletes
and revisions of documents that the ledger does not hold, change nothing (a
revision of an unknown document inserts it). Of several changes to a document
in one batch the last by ``seq`` holds (of equal ones, the greatest op, then
text). Groups whose documents are all gone are not returned. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


GROUP = ["source", "lang", "tokenizer"]
SIGNED = "doc_id long, source string, lang string, tokenizer string, d_docs long, d_tokens long"


def count_words(text: Column) -> Column:
    """Runs of signs other than white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def count_alnum(text: Column) -> Column:
    """Runs of ASCII letters and digits and of signs beyond ASCII, and single
    other signs."""
    return F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"))


def count_bpe(ranks_path: str, pattern: str) -> Callable[[Column], Column]:
    """Tokens of a byte-pair vocabulary of ranks, counted in Arrow batches;
    the encoder is made once per worker from the file at ``ranks_path``."""
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encoder = _encoder(ranks_path, pattern)
        return texts.map(lambda t: 0 if t is None else len(encoder.encode_ordinary(t)))

    return count


_encoders: dict = {}


def _encoder(path: str, pattern: str):
    if (path, pattern) not in _encoders:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path, pattern] = tiktoken.Encoding("ledger", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


COUNTERS: dict[str, Callable[[Column], Column]] = {"words-1": count_words, "signs-2": count_alnum}


class Ledger:
    """A ledger in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, folder: str, counters: Mapping[str, Callable[[Column], Column]] = COUNTERS):
        self.spark, self.folder, self.counters = spark, folder.rstrip("/"), dict(counters)
        self._known: dict[int, str] = {}

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _log(self) -> dict[int, str]:
        """The commits by number, each with its batch. A commit file is never
        changed, so each is read once."""
        fs, at = self._fs(), self._path("commits")
        for status in fs.listStatus(at) if fs.exists(at) else []:
            number = int(status.getPath().getName())
            if number not in self._known:
                stream = fs.open(status.getPath())
                try:
                    self._known[number] = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
        return self._known

    def committed(self) -> list[str]:
        """Ids of the committed batches that no compaction has taken up."""
        fs, names = self._fs(), set(self._log().values())
        folded = {s.getPath().getName() for s in fs.listStatus(self._path("folded"))} if fs.exists(self._path("folded")) else set()
        return sorted(names - {n.rpartition("@")[0] for n in folded if n.rpartition("@")[2] in names})

    def is_committed(self, batch: str) -> bool:
        return batch in self._log().values()

    def sequence(self) -> int:
        """Number of the last commit: what signed rows are worked out from."""
        return max(self._log(), default=0)

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{b}" for b in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def documents(self) -> DataFrame:
        """What the ledger holds: one row per document and group."""
        signed = self._read("documents", SIGNED)
        return signed.groupBy("doc_id", *GROUP).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where("n_docs != 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of the committed batches."""
        rows = self._read("totals", "source string, lang string, tokenizer string, d_docs long, d_tokens long")
        return rows.groupBy(*GROUP).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where("n_docs != 0")

    def signed(self, changes: DataFrame) -> DataFrame:
        """The signed rows of a change feed (op, seq, doc_id, text, source,
        lang, tokenizer); op is insert, delete or revise."""
        known = F.coalesce(F.col("tokenizer").isin(list(self.counters)), F.lit(False))
        if changes.where(~known & (F.lower("op") != "delete")).limit(1).count():
            raise ValueError("changes name a tokenizer that has no counter")
        tokens = F.lit(0).cast("long")
        for name, counter in self.counters.items():
            tokens = F.when(F.col("tokenizer") == name, counter(F.coalesce("text", F.lit("")))).otherwise(tokens)
        feed = changes.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("op").alias("op"), F.col("seq").cast("long").alias("seq"),
                                                          "source", "lang", "tokenizer", tokens.cast("long").alias("n"), F.xxhash64("text").alias("t"))
        last = feed.groupBy("doc_id").agg(F.max(F.struct("seq", "op", "t", "source", "lang", "tokenizer", "n")).alias("c")).select("doc_id", "c.*")
        added = last.where("op in ('insert', 'revise')").select("doc_id", *GROUP, F.lit(1).cast("long").alias("d_docs"), F.col("n").alias("d_tokens"))
        if not self.committed():
            return added
        held = self.documents().join(last.select("doc_id"), "doc_id", "left_semi")
        taken = held.select("doc_id", *GROUP, (-F.col("n_docs")).alias("d_docs"), (-F.col("n_tokens")).alias("d_tokens"))
        return added.unionByName(taken)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Make ``changes`` part of the ledger; False if the batch already is."""
        if "@" in batch or "/" in batch or not batch:
            raise ValueError("a batch id is a file name without @")
        while not self.is_committed(batch):
            base = self.sequence()
            if self._write(batch, self.signed(changes), base):
                return True
        return False

    def _write(self, batch: str, signed: DataFrame, base: int) -> bool:
        """Commits rows that were worked out after commit ``base``; False, and
        no change, if another commit came between: the rows may take back what
        the ledger no longer holds, and have to be worked out anew."""
        at = f"{self.folder}/documents/{batch}"
        signed.write.mode("overwrite").parquet(at)
        rows = self.spark.read.schema(SIGNED).parquet(at)
        rows.groupBy(*GROUP).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens")).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/totals/{batch}")
        fs, log = self._fs(), self._path("commits", f"{base + 1:010d}")
        if self.sequence() != base:
            return False
        try:
            stream = fs.create(log, False)
        except Exception:
            if fs.exists(log):
                return False
            raise
        try:
            stream.write(bytearray(batch.encode()))
        finally:
            stream.close()
        return True

    def compact(self, batch: str) -> None:
        """Fold all committed batches into one. Readers see either the old
        batches or the new one: a batch counts as folded only when the marker
        of what took it up exists."""
        base, old = self.sequence(), self.committed()
        if self.is_committed(batch) or not old:
            return
        rows = self.documents().select("doc_id", *GROUP, F.col("n_docs").alias("d_docs"), F.col("n_tokens").alias("d_tokens"))
        for name in old:
            self._fs().create(self._path("folded", f"{name}@{batch}"), True).close()
        if not self._write(batch, rows, base):
            raise RuntimeError("a batch was committed meanwhile; compact again")
