"""Shared small inputs of the llm tests."""

import random

import pyarrow.parquet as pq

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(sf="sf0.001"):
    rows = pq.read_table(f"/root/testdata/{sf}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows]


def odd_documents():
    """Nulls, empty and white-space-only texts, ties, repeated rows, one long text."""
    rng = random.Random(5)
    passage = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(60))
    long_text = " ".join(rng.choice(["one", "two", "three", "vier", "fünf", "Six|", "x", passage]) for _ in range(20000))
    rows = [
        (1, passage, "en", "s1"), (2, "Intro words here. " + passage + "\nand an end", "en", "s1"), (3, passage, None, None),
        (3, passage, None, None), (4, None, "en", "s1"), (5, "", "de", "s2"), (6, " \t\n\x0b\x0c\r ", "de", "s2"),
        (None, "no id at all " + passage, "fr", "s3"), (None, None, None, None), (7, long_text, "en", "s1"),
        (8, "word", "en", "s2"), (9, "WORD", "en", "s2"), (10, "two words", "es", None),
        (11, "\n".join(["same line again", "", "same line again", "other"] * 5), "es", "s4"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def clashing(df):
    """Extra columns whose names the operators use inside or return."""
    from pyspark.sql import functions as F

    for name in ("id", "fp", "rid", "spans", "words", "score", "kept", "shard", "component", "_id", "_text", "_spans", "key", "host", "n_words", "value", "text_hash", "hits", "m.k", "a`b"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    return df
