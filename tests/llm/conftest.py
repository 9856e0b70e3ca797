import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts (or (doc_id, text, lang, source) tuples)."""

    def build(rows):
        out = []
        for i, r in enumerate(rows):
            i, text, lang, source = r if isinstance(r, tuple) else (i, r, "en", f"s{i % 3}")
            out.append((i, text, lang, source, len(text or "")))
        return spark.createDataFrame(out, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def odd_documents(make, spark):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, and more columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    long = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "tokén"]) + str(rnd.randrange(500)) for _ in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \t\n ", "de", "b"), (4, long, "en", "a"), (5, "same text here and there", "en", "a"), (6, "same text here and there", "en", "a"), (7, "one", "fr", None), (7, "one", "fr", None), (None, "no id but words", "en", "b"), (8, "ünïcödé 😀 wörds — ok", "de", "c")]
    df = make(rows)
    names = ["size", "score", "rank", "entity", "token", "target", "taken", "place", "cell", "length", "bucket", "label", "root", "key", "ix", "word_count", "_id", "kinds", "batch"]
    return df.withColumns({n: F.lit(None).cast("string") for n in names})
