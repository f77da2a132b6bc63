"""Small documents with everything that tends to go wrong."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results.
        T.StructField("kept", T.IntegerType()),
        T.StructField("score", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ漢😀z") for _ in range(rng.randint(1, 7))) for _ in range(n))


def texts():
    rng = random.Random(5)
    passages = [words(rng, 45) for _ in range(4)]
    found = [None, "", " ", "\n\t", "a", "one two", "x" * 300, "x" * 300, "tab\tand\x0bmore " * 12, "  lead and trail  "]
    for i in range(40):
        parts = [words(rng, rng.randint(0, 60))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, 25)
            parts += [p[cut:] if rng.random() < 0.4 else p, words(rng, rng.randint(0, 12))]
        found.append(("\n" if i % 3 else " ").join(parts))
    found += found[12:20]
    long = words(rng, 3000)
    found += [long, long.replace("a", "b", 3), "same words " * 200]
    return found


def documents(spark):
    rows = [(i * 3 if i != 7 else 18, t, "en", "s", None if t is None else len(t), i, "s", "f") for i, t in enumerate(texts())]
    rng = random.Random(9)
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(spark):
    """The same with distinct ids."""
    rows = [(i * 3, t, "en", "s", None if t is None else len(t), i, "s", "f") for i, t in enumerate(texts())]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
