import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def frame(spark, rows):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows], SCHEMA)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


WORDS = "the of and to in that is was for it with as his on be at by had not are but from or have an they which one you were all her she there would their".split()


def prose(seed, n):
    r = random.Random(seed)
    made = ["".join(r.choice("aeiou") + r.choice("bcdfglmnprst") for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(r.choice(WORDS) if r.random() < 0.4 else w for w in made)


ODD = [
    (None, "a text without an identifier"),
    (1, None),
    (2, ""),
    (3, "\n\n \t\n"),
    (4, "short"),
    (5, "the same line of text here\nanother line of text"),
    (6, "the same line of text here\nThe Same line of text HERE  \nsomething else entirely"),
    (6, "the same line of text here\nThe Same line of text HERE  \nsomething else entirely"),
    (7, "naïve café — 日本語 😀 \x00 \x85 end"),
    (8, "word " * 30_000),
    (9, prose(9, 400)),
    (10, prose(9, 400)),
    (11, prose(11, 5_000)),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, with extra columns whose names clash with results."""
    extra = {c: F.lit("x") for c in ("ids", "piece", "length", "sequence_id", "offset", "rank__", "kept", "n", "sketch", "id", "pivot", "words", "drop", "h1", "score", "predicted", "held_out", "spans", "start", "end", "row", "doc", "pos", "w", "t", "l", "gone__", "hit__", "class_id", "n_lines__", "n_dropped__", "row__", "key", "r", "shard", "block", "lines", "refs", "kept__", "m1", "ref", "chosen")}
    return frame(spark, ODD).withColumns(extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
