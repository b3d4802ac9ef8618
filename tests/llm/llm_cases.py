"""Documents that every operator has to cope with."""

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves, as columns that they should leave alone.
CLASHING = ("row", "fp", "ids", "number", "shard_", "bucket", "before", "_id", "key", "grade", "a.b")
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [
    (None, "an id is missing here"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, LONG),
    (5, "the same words twice over, in two rows of one id"),
    (5, "the same words twice over, in two rows of one id"),
    (6, "the same words twice over, in two rows of one id"),
    (7, "Ünïcödé 漢字 😀 don't we'll     x"),
    (None, None),
    (8, "a" * 30_000),
]


def documents(spark, rows=TEXTS):
    table = spark.createDataFrame(
        [(i, t, "en", None, None if t is None else len(t)) for i, t in rows], DOCUMENTS
    )
    return table.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def no_documents(spark):
    return documents(spark).limit(0)


def prose(seed, words=200, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


# Bytes that are no UTF-8, between rows that are.
INVALID = b"\xff\xfe\x80 broken \xc3"
BESIDE = [(10, "plain text here"), (12, "don't we'll \u6f22\u5b57 x")]


def with_invalid(spark):
    """A row of bytes that are no text, between two rows that are; in one partition."""
    bad = spark.createDataFrame([(11, INVALID)], "doc_id long, raw binary").selectExpr(
        "doc_id", "cast(raw as string) as text"
    )
    good = spark.createDataFrame(BESIDE, "doc_id long, text string")
    whole = good.limit(1).unionAll(bad).unionAll(good.filter("doc_id = 12"))
    return whole.selectExpr(
        "doc_id", "text", "'en' as lang", "'s' as source", "cast(9 as long) as n_chars"
    ).coalesce(1)
