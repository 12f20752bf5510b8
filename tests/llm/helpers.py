"""Small documents with every awkward case: nulls, empty and white texts, ties, repeated rows, long texts, clashing columns."""

import random

import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward_rows():
    base = words(120, 1)
    near = base.copy()
    near[60] = "changed"
    far = base[:60] + words(60, 2)
    long = words(5_000, 3)
    rows = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base).replace(" ", "\n")), (4, " ".join(near)), (5, " ".join(far)),
        (6, None), (7, ""), (8, " \n\t "), (9, "one"), (10, "One"), (11, "two words"), (12, " ".join(long)), (13, " ".join(long[:4000]) + " x"),
        (14, "ünï çødé 日本   text here"), (15, "a b c d e"), (16, "a b c d e f"), (17, "Quick! " * 30), (18, "line one is here\nline one is here\n\nother"),
        (None, "no id"), (19, " ".join(base[20:60])), (20, "x" * 10_000),
    ]
    return rows + [rows[0], rows[8]]  # repeated rows


def frame(spark, rows, extra=None):
    full = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in extra or ():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "quality", "toxic"]))


CLASHES = ["kept", "keep_id", "digest", "content", "salt", "rank", "size", "score", "words", "lines", "row", "h", "tokens", "rep", "key", "part", "places", "centre"]
