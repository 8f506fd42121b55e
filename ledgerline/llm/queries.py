"""The operators as registered queries over the whole given tables, with
production parameters, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontaminate, filter_audit, host_rules, language_mix, ngram_trie, pieces, quality_model, run_index, simhash, substring, token_ledger, warc_zip
from .store import new_folder, written

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, by: int):
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(F.col(id_col).cast("string")) % by


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_quality(table(spark, sf_dir, "documents"))


def op2_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole counts: n-grams seen once are kept."""
    docs = table(spark, sf_dir, "documents")
    model = ngram_trie.train(docs, remainder("doc_id", 5) != 1, min_count=1)
    held_out = F.coalesce(remainder("id", 5) == 1, F.lit(False))
    return ngram_trie.score(docs, model).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op3_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, model = language_mix.learn(docs, remainder("doc_id", 5) != 0)
    held_out = F.coalesce(remainder("id", 5) == 0, F.lit(False))
    return language_mix.predict(docs, langs, model).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "mixture")


def op4_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.segmentation_digest(docs, pieces.fitted(docs, PIECE_MODEL))


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, paths = warc_zip.write_packages(table(spark, sf_dir, "pages"), least_bytes=0)
    paths = written(paths, "package-paths")
    records = warc_zip.read_packages(paths.repartition(max(1, paths.count())), folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: all inserted, every tenth deleted,
    every seventh revised to another tokenizer version; the second batch comes
    twice."""
    return _ledger_totals(spark, sf_dir, "words-1", token_ledger.COUNTERS)


def op7_token_ledger_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches, inserted with a byte-pair vocabulary's counts."""
    from public_tokenizers import PATTERN

    return _ledger_totals(spark, sf_dir, "byte-bpe-50k", {**token_ledger.COUNTERS, "byte-bpe-50k": token_ledger.count_bpe(BPE_RANKS, PATTERN)})


def _ledger_totals(spark: SparkSession, sf_dir: str, first: str, counters) -> DataFrame:
    ledger = token_ledger.Ledger(spark, new_folder(spark, "token-ledger"), counters)
    docs = table(spark, sf_dir, "documents")
    change = lambda op, seq, rows, tokenizer: rows.select(F.lit(op).alias("op"), F.lit(seq).alias("seq"), "doc_id", "text", "source", "lang", F.lit(tokenizer).alias("tokenizer"))
    deleted = change("delete", 2, docs.where("doc_id % 10 = 3"), first)
    ledger.commit("batch-1", change("insert", 1, docs, first))
    ledger.commit("batch-2", deleted)
    ledger.commit("batch-3", change("revise", 3, docs.where("doc_id % 7 = 0"), "signs-2"))
    ledger.commit("batch-2", deleted)
    return ledger.totals()


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality_model.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("id", 3) == 1, F.lit(False))
    return quality_model.score(docs, weights).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digest(table(spark, sf_dir, "documents"))


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.repeat_digest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_host_quality, op2_ngram_trie, op3_language_mix, op4_nbest_pieces, op5_contamination,
                             op6_warc_zip, op7_token_ledger, op7_token_ledger_bpe, op8_quality_model, op9_substring_dedup, op10_simhash_components, op11_filter_audit,
                             op12_run_index, op13_conversation_repair)
}

SQL: dict[str, str] = {}

SQL["op1_host_quality"] = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), measures AS (
  SELECT doc_id, source, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])
      - len(list_distinct([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])) AS n_dup_lines
  FROM words
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS s FROM words)
), repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, sum(least(8, s - coalesce(before, s - 8))) AS n_repeat_words
  FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM repeated) GROUP BY doc_id
), full_ AS (
  SELECT m.doc_id, m.source, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM measures m LEFT JOIN covered USING (doc_id)
), counts AS (
  SELECT source, count(*) AS n, unnest([
    {'rule': 'few_words', 'f': count(*) FILTER (n_words < 20)},
    {'rule': 'repeated_words', 'f': count(*) FILTER (100 * n_repeat_words > 30 * n_words)},
    {'rule': 'repeated_lines', 'f': count(*) FILTER (n_dup_lines >= 3 AND 10 * n_dup_lines > n_words)},
    {'rule': 'symbols', 'f': count(*) FILTER (5 * n_symbols > n_words)},
    {'rule': 'word_length', 'f': count(*) FILTER (n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words))}], recursive := true)
  FROM full_ GROUP BY source
), prior AS (
  SELECT rule, count(*) AS hosts, sum(n) AS total, sum(f) / sum(n) AS mean, sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS var FROM counts GROUP BY rule
), strength AS (
  SELECT rule, mean, CASE WHEN mean * (1 - mean) <= 0 THEN 1.0 WHEN var - mean * (1 - mean) * hosts / total <= 0 THEN 1e6
    ELSE least(greatest(mean * (1 - mean) / (var - mean * (1 - mean) * hosts / total) - 1, 1.0), 1e6) END AS k FROM prior
), rates AS (
  SELECT source, (f + greatest(mean * k, 1e-3)) / (n + greatest(mean * k, 1e-3) + greatest((1 - mean) * k, 1e-3)) AS rate,
    n + greatest(mean * k, 1e-3) + greatest((1 - mean) * k, 1e-3) AS m FROM counts JOIN strength USING (rule)
), bad AS (
  SELECT source, bool_or(rate - 2.0 * sqrt(rate * (1 - rate) / (m + 1)) > 0.5) AS host_rejected FROM rates GROUP BY source
), judged AS (
  SELECT f.*, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, b.host_rejected FROM full_ f JOIN bad b ON f.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept FROM judged
"""

SQL["op5_contamination"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM items WHERE len(w) > 0)
), widths AS (SELECT DISTINCT k FROM grams),
windows AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS s FROM docs, widths)
), hits AS (
  SELECT doc_id, s, w.k, item_id FROM windows w JOIN grams g ON w.gram = g.gram AND w.k = g.k
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SQL["op9_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS s FROM docs)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)
"""

SQL["op7_token_ledger"] = r"""
WITH held AS (
  SELECT source, lang, CASE WHEN doc_id % 7 = 0 THEN 'signs-2' ELSE 'words-1' END AS tokenizer, coalesce(text, '') AS text
  FROM documents WHERE doc_id IS NOT NULL AND (doc_id % 10 <> 3 OR doc_id % 7 = 0)
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(CASE WHEN tokenizer = 'words-1' THEN len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
  ELSE len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) END) AS BIGINT) AS n_tokens
FROM held GROUP BY source, lang, tokenizer
"""

SQL["op6_warc_zip"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), first AS (
  SELECT sha, min(page_id) AS first FROM p GROUP BY sha
), bits AS (
  SELECT sha, first, array_to_string([lpad(bin(strpos('0123456789abcdef', substr(sha, i, 1)) - 1), 4, '0') FOR i IN range(1, 41)], '') AS b FROM first
), digests AS (
  SELECT sha, first, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(b, 5 * g + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * g + 2, 1) AS INT)
    + 4 * CAST(substr(b, 5 * g + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * g + 4, 1) AS INT) + CAST(substr(b, 5 * g + 5, 1) AS INT), 1) FOR g IN range(0, 32)], '') AS digest FROM bits
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN digests USING (sha)
"""

SQL["op11_filter_audit"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM words GROUP BY text
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
    first_id IS NOT NULL AND (doc_id IS NULL OR doc_id > first_id)] AS f
  FROM words JOIN firsts USING (text) LEFT JOIN marked USING (doc_id)
), cells AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, f
), letters AS (SELECT unnest(range(1, 6)) AS x),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT o, k, o[k] AS x FROM orders, (SELECT unnest(range(1, 6)) AS k)
), states AS (
  SELECT part, array_to_string([substr('ABCDE', p, 1) FOR p IN o], '') AS filter_order, k AS step, x, n, good, toxic, f[x] AS fails,
    len([p FOR p IN o[1:k - 1] IF f[p]]) > 0 AS earlier, len([p FOR p IN o IF f[p]]) AS fail_count
  FROM cells, steps
), report AS (
  SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT earlier AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (fails AND fail_count = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT earlier), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0) AS toxic_lost
  FROM states GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM report
"""

SQL["op12_run_index"] = r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS gram FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS s FROM docs)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), parted AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS part
  FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM later)
), spans AS (
  SELECT doc_id, min(s) AS lo, max(s) + 100 AS hi FROM parted GROUP BY doc_id, part
), between_ AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(max(h), 2 * max(hi) + 1) AS h, sum(hi - lo) AS n_removed, count(*) AS n_spans
  FROM between_ JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""
