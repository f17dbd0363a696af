"""Small document tables with the awkward cases every operator has to bear."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, letters="aeioulnrst"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_documents(spark, extra=()):
    """Null and empty texts, blanks only, one very long text, repeated rows, null ids and sources."""
    rng = random.Random(5)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 4),
        (4, prose(rng, 60_000), "en", "b", None),
        (5, "Ünïcode — 日本語 🎉 text.", "de", "b", 20),
        (6, "one two three", "en", "a", 13),
        (6, "one two three", "en", "a", 13),
        (None, "no id at all, but words enough to be a text", "en", None, 3),
        (7, "12345 67890 !!!", "xx", "a", 15),
        *extra,
    ]
    return spark.createDataFrame([(*r, None)[:5] if len(r) < 5 else r for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs, *names):
    """The same rows with additional columns of these names."""
    for name in names:
        docs = docs.withColumn(name, F.lit("there before"))
    return docs
