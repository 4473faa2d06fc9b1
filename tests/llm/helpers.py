"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix potions near old castle walls tonight".split()


def sentence(seed: int, n: int) -> str:
    x = seed * 7919 + 13
    out = []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 37))
    return " ".join(out) + "."


def text(seed: int, n: int = 60) -> str:
    return " ".join(sentence(seed * 100 + k, 10) for k in range(n // 10))


def hard_docs(spark):
    """Nulls in every column, empty, odd and very long texts, ties and repeated rows."""
    rows = [
        (1, text(1), "en", "a", 1),
        (1, text(1), "en", "a", 1),
        (2, text(1), "en", None, None),
        (3, "", None, "a", 0),
        (4, None, None, None, None),
        (None, text(5), "en", "b", 3),
        (None, None, None, "b", None),
        (7, " \n\t ", "en", "b", 3),
        (8, "one", "en", "c", 3),
        (9, "Ünïcödé ▁ 漢字 🙂  double  spaces\r\n\x01 end ", "xx", "c", 9),
        (10, text(10, 30_000), "en", "c", 9),
        (11, text(11) + " extra", "en", "c", 9),
        (12, text(11), "en", "c", 9),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def with_clashes(docs):
    """The table with extra columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    names = ("tie", "fp", "_row", "_text", "_places", "size", "copies", "key", "block", "hash", "shard", "depth", "score")
    return docs.select("*", *(F.lit(f"x-{n}").alias(n) for n in names))


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
