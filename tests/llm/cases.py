"""Tables that every operator must take: nulls, empty and very long texts, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import functions as F

LONG = " ".join(f"word{k % 977} the" for k in range(60_000))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 70),
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (4, " \n\t ", "de", "b", 4),
    (5, "1234 5678 !!! 99", "fr", "b", 16),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " end", "en", "b", len(LONG) + 4),
    (None, "Ein Text ohne Nummer, der hier steht und bleibt.", "de", "c", 47),
    (None, None, None, None, None),
    (8, "Ein Text ohne Nummer, der hier steht und bleibt.", "de", "c", 47),
    (9, "\U0001f600 é \x00 <|endoftext|> a b", "fr", "c", 24),
    (10, "x", "en", "c", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "_found", "_leaked", "_doc_id", "_text_key", "_spans", "score", "ids", "length", "piece", "group", "size", "bands",
    "component", "kept", "shard", "slot", "base", "text_key", "n_tokens", "_words", "item_id", "set_id", "id", "lang_pred",
)


def documents(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.withColumns({c: F.lit("other") for c in CLASHING})


def empty(spark):
    return documents(spark).limit(0)


def table_of(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
