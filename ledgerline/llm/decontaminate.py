"""Benchmark decontamination over a hash set of test n-grams (operator 5).

Words are runs of ASCII letters and digits and of all characters beyond
ASCII, with A-Z lower-cased. The test items' windows (``window`` words; a
shorter item is one window) are normalised, hashed and joined with the hashes
of all windows of the training texts; a hit counts only if the words are
equal too. The window set is broadcast while its measured size is under
``max_broadcast_bytes``; beyond that the same join shuffles by hash, which is
evenly spread. DataFrame functions only.

Defined results: null and empty texts and items have no words, so no windows.
Rows are identified by id and text, so repeated rows, and rows without an id,
get the right result each. Item ids are compared and listed as strings; a
null item id is left out of lists but its windows count. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a lower-cased text
IN_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # of any text
CANDIDATES = "id long, text_hash long, at int, width int, item string, gram string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z only. ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Array of the normalised words; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(words: Column, width: int) -> Column:
    """64-bit hash of every run of ``width`` words, in order of position."""

    def over(h: Column) -> Column:
        n = F.size(h) - width + 1
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))).otherwise(
            F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), over)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, width, h, gram): the distinct windows of every item."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(window))
    cut = words.withColumn("width", width).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - width + 1)))
    gram = F.slice("words", F.col("at"), F.col("width"))
    return cut.select("item", "width", F.array_join(gram, " ").alias("gram")).distinct()


def candidates(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
         window: int = 10, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(id, text_hash, at, width, item, gram): every window of a text whose
    hash is that of an item's window; ``at`` is the 0-based word."""
    grams = item_windows(items, item_col, item_text_col, window)
    widths, size = [], 0
    for width, n_bytes in grams.groupBy("width").agg(F.sum(F.length("gram") * 4 + 64)).collect():  # at most one row per width
        widths.append(width)
        size += n_bytes
    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("id"), F.xxhash64(key, F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    found = []
    for width in sorted(widths):
        few = grams.where(F.col("width") == width).withColumn("g", F.split("gram", " "))
        few = few.select("item", "gram", F.xxhash64(*[F.xxhash64(F.element_at("g", k + 1)) for k in range(width)]).alias("h"))
        if size <= max_broadcast_bytes:
            few = F.broadcast(few)  # measured above
        scanned = rows.where(F.size("words") >= width).select("id", "text_hash", F.posexplode(window_hashes(F.col("words"), width)).alias("at", "h"))
        found.append(scanned.join(few, "h").select("id", "text_hash", "at", F.lit(width).alias("width"), "item", "gram"))
    if not found:
        return docs.sparkSession.createDataFrame([], CANDIDATES)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, max_broadcast_bytes: int) -> DataFrame:
    """(_row, _words, _hits): every document with its normalised words and
    its verified hits (at, width, item), null where it has no candidate."""
    key = F.col(id_col).cast("long")
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("_row"), key.alias("_id"), F.xxhash64(key, F.col(text_col)).alias("_hash"))
    found = candidates(docs, items, id_col, text_col, item_col, item_text_col, window, max_broadcast_bytes)
    found = found.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("at", "width", "item", "gram"))).alias("found"))
    joined = rows.join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash")), "left")
    joined = joined.withColumn("_words", words_of(F.col("_row")[text_col]))
    same = lambda c: F.array_join(F.slice(F.col("_words"), c["at"] + 1, c["width"]), " ") == c["gram"]
    return joined.select("_row", "_words", F.filter("found", same).alias("_hits"))


def spans_of(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda c: F.struct(c["at"].alias("at"), c["width"].alias("width"))))


def hit_words(spans: Column) -> Column:
    """Number of words that spans (at, width), in order, cover together."""
    start = F.struct(F.lit(-1).alias("to"), F.lit(0).cast("bigint").alias("n"))

    def add(acc: Column, span: Column) -> Column:
        to = F.greatest(acc["to"], span["at"] + span["width"])
        return F.struct(to.alias("to"), (acc["n"] + (to - F.greatest(acc["to"], span["at"]))).alias("n"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = 10, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    joined = with_hits(docs, items, id_col, text_col, item_col, item_text_col, window, max_broadcast_bytes)
    n_hit = F.coalesce(hit_words(spans_of(F.col("_hits"))), F.lit(0)).cast("long")
    listed = F.coalesce(F.array_sort(F.array_distinct(F.array_compact(F.transform("_hits", lambda c: c["item"])))), F.array().cast("array<string>"))
    out = joined.select(F.col("_row")[id_col].cast("long").alias("doc_id"), F.size("_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), listed.alias("listed"))
    return out.select("doc_id", "n_words", "n_hit", F.size("listed").cast("long").alias("n_items"),
                      F.sha2(F.array_join("listed", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def merged(spans: Column) -> Column:
    """Ordered spans (at, width) as disjoint ones (from, to)."""
    empty = F.array().cast("array<struct<from:int,to:int>>")

    def add(acc: Column, span: Column) -> Column:
        to = span["at"] + span["width"]
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], to).alias("to"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["to"] >= span["at"]), grown).otherwise(
            F.concat(acc, F.array(F.struct(span["at"].alias("from"), to.alias("to")))))

    return F.aggregate(spans, empty, add)


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and without what follows each
    of them up to the next word; the rest stays as it is."""
    pieces = F.regexp_extract_all(text, F.lit(f"[^{IN_GAP}]+[{IN_GAP}]*"), F.lit(0))
    outside = lambda cut: F.filter(pieces, lambda piece, i: ~F.exists(cut, lambda c: (i >= c["from"]) & (i < c["to"])))
    return F.concat(F.regexp_extract(text, f"^[{IN_GAP}]*", 0), F.array_join(let(merged(spans), outside), ""))


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 window: int = 10, max_hit_share: float = 1.0, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The documents with hit words cut out of their texts; a document of
    whose words more than ``max_hit_share`` are hit goes as a whole."""
    joined = with_hits(docs, items, id_col, text_col, item_col, item_text_col, window, max_broadcast_bytes)
    text, spans, hit = F.col("_row")[text_col], spans_of(F.col("_hits")), F.coalesce(F.size("_hits"), F.lit(0)) > 0
    kept = joined.where(~hit | (hit_words(spans) / F.size("_words") <= max_hit_share))
    new = F.when(hit, cut_spans(text, spans)).otherwise(text)
    return kept.select(*[(new if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns])
