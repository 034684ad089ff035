"""Small inputs with every awkward case: nulls, empty and very long texts, ties, repeated rows, extra columns."""

from __future__ import annotations

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside.
CLASHES = ("size", "target", "copies", "row", "k", "n", "d", "h", "of", "node", "comp", "key", "ord", "hs", "shard", "place", "n_words", "anomaly", "kept", "score", "component_id", "text2")


def passage(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    syllables = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu ra re ri ro ru sa se si so su ta te ti to tu".split()
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n)]
    for i in range(6, n, 9):
        words[i] += "."
    return " ".join(words)


def awkward(spark):
    base, shared = passage(1, 300), passage(2, 80)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base.replace("ba", "bo", 2), "en", "b", 1), (4, None, None, None, None), (5, "", "en", "", 0), (6, " \n\t ", "en", "a", 1),
        (7, "one two", "en", "c", 1), (8, "one two", "en", None, 1), (9, passage(3, 100) + "\n" + shared + "\n" + passage(4, 60), "en", "c", 1), (10, passage(5, 70) + "\n" + shared, "en", "b", 1),
        (11, passage(6, 20000), "en", "d", 1), (None, passage(7, 90), "en", "a", 1), (None, None, "en", "a", 1), (12, "É\u2028ñ 😀 " * 40, "fr", "é", 1), (12, passage(8, 55), "fr", "é", 1), (1, base, "en", "a", 1),
        (13, "spam " * 100, "en", "a", 1), (14, "a\x00b\x0bc\x1cd", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (13, 0, 1), (None, 1, 1), (7, None, None), (13, 0, 1)], "doc_id long, quality int, toxic int")
