"""Rows that every operator of the subpackage must take: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    out = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(words)]
    return "".join(w + ("\n" if i % 17 == 16 else " ") for i, w in enumerate(out)).strip()


def odd_rows():
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one two", "en", "b", 7),
        (5, base, "en", "a", len(base)), (6, base, "en", "b", len(base)), (6, base, "en", "b", len(base)),
        (7, " ".join(near), "fr", None, 1), (8, prose(2, 4000), "de", "c", 1), (9, "é中🙂 " * 60, None, "c", 240),
        (None, prose(3, 80), "en", "a", 1), (10, "Aa bB one TWO", "en", "a", 13), (11, "aA BB oNe two", "en", "c", 13),
        (12, prose(4, 120) + " " + base[:700], "en", "b", 1), (13, "x" * 5000, "en", "b", 5000),
    ]


def odd(spark):
    """The odd rows in three partitions, with extra columns whose names operators might use themselves."""
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    for name in ("rep", "gram", "size", "h", "block", "chunk", "copies", "spans", "held_out", "score", "root", "trusted"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((v is None, v) for v in t))
