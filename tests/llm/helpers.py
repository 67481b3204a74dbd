"""Documents for the tests of the training-data operators."""

from __future__ import annotations

ODD_TEXTS = [
    None, "", " ", "\n\t\r\x0b\x0c ", "a", "A b", "it's we'LL  12\n\n x ", "՘ ࢏ ab", "naïve wörd é ß",
    "日本語のテキスト、句読点。", "\U0001f600\U0001f680 ok", "x" * 20_000, "la " * 5_000, "\x00 \x1c\x1d y", "<|endoftext|> z",
    "it's we'LL  12\n\n x ", "it's we'LL  12\n\n x ",
]


def odd_documents(spark, texts=None, partitions: int = 3):
    """One document per text, with extra columns whose names operators might use themselves."""
    rows = [(i, t, "en", None, i % 2, "w") for i, t in enumerate(ODD_TEXTS if texts is None else texts)]
    schema = "doc_id long, text string, lang string, key string, block int, word string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def documents(spark, sf="sf0.001", table="documents"):
    return spark.read.parquet(f"/root/testdata/{sf}/{table}.parquet")
