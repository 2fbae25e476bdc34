"""Small tables with the awkward rows that every corpus operator has to bear."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# columns whose names the operators use inside
EXTRA = ("chunk", "pos", "fp", "row", "value", "rank", "words", "stratum", "id", "key", "x", "kept", "score", "length")


def documents(spark, rows, extra=False):
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(n).alias(n) for n in EXTRA))
    return df


def sentence(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward():
    """Nulls everywhere, empty, blank and very long texts, ties and repeated rows."""
    long = sentence(1, 30_000)
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, sentence(2), "en", "b"),
        (5, sentence(2), "fr", "b"), (5, sentence(2), "fr", "b"), (6, sentence(2).replace(" ", "\n"), "fr", "b"),
        (7, sentence(2) + "  ", "de", "c"), (None, sentence(2), "de", "c"), (None, None, None, None),
        (8, long, "en", "a"), (9, long + " x", "en", "a"), (10, "  ", "en", "a"), (11, "a\x00b", "es", None),
        (12, "one", "en", "a"), (13, "ONE", "en", "a"), (14, "é", "fr", "a"), (15, "\U0001f600 !", "fr", "a"),
        (16, (sentence(3, 30) + "\n") * 5, "en", "a"), (-17, "a b c " * 40, "en", "a"),
    ]
