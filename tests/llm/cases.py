"""Small documents with every odd case: nulls, empty, blank, short, very long, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("row_id", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("component_id", T.StringType()), T.StructField("raw", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("words", T.ArrayType(T.StringType())),
])


def sentence(rng: random.Random, n: int, stem: str = "") -> str:
    return " ".join(stem + "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 6))) for _ in range(n))


def texts(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    shared, base = sentence(rng, 30), sentence(rng, 120)
    words = base.split()
    rows = [(0, base), (1, base), (2, " ".join(words[:60] + ["zz"] + words[60:])), (3, None), (4, ""), (5, " \t\n"),
            (6, "one"), (7, "ONE"), (8, "a b c"), (9, sentence(rng, 50) + " " + shared + " " + sentence(rng, 20)),
            (10, shared), (11, sentence(rng, 20) + "\n" + shared.replace(" ", "\n")), (12, "na " * 80),
            (13, "na " * 40 + "x"), (14, sentence(rng, 3000)), (14, "other text under the same id"),
            (15, "twice twice"), (15, "twice twice"), (None, base), (None, "nameless words here"),
            (16, "12 ... !!"), (17, " nbsp em space"), (18, "x" * 5000), (19, shared + " " + shared)]
    rows += [(20 + k, sentence(rng, rng.randint(1, 60))) for k in range(30)]
    return rows


def frame(spark, rows=None, lang=None):
    rows = texts() if rows is None else rows
    data = [(i, t, (lang or {}).get(i), "s", None if t is None else len(t), "r", "s", "c", "raw", "sh", "n", ["w"])
            for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
