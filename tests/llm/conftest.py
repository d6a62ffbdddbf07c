import random

import pytest
from pyspark.sql import types as T

DOC_FIELDS = [
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    *(T.StructField(n, T.StringType()) for n in ("score", "h", "row", "vslot", "block", "__text", "__id", "k0", "digest", "kept", "n")),
]
DOCS = T.StructType(DOC_FIELDS)


def words(n: int, seed: int, alphabet: str = "abcdefghij") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 7))) for _ in range(n)]


def edge_texts() -> list[tuple]:
    """(doc_id, text, source): nulls, blanks, short, long, copies, near copies, repeats and odd characters."""
    base = words(120, 1)
    near = list(base)
    near[60] = "changed"
    passage = words(40, 2)
    out = [
        (1, " ".join(base), "s"),
        (2, None, "s"),
        (3, "", None),
        (4, " \t\n\x0b\x0c\r ", "s"),
        (5, "one two", "s"),
        (5, "one two", "s"),
        (6, " ".join(base), None),
        (7, " ".join(near), ""),
        (8, " ".join(words(30, 3) + passage + words(30, 4)), "s"),
        (9, " ".join(passage + words(30, 5)) + "\nline\nline\nLINE", "t"),
        (10, "same " * 200, "t"),
        (11, " ".join(passage + passage), "t"),
        (None, " ".join(words(25, 6)), None),
        (None, None, "t"),
        (12, "é ü 日本 \x1c\x85 ʼx ½² ## $$ <a|b>\n\n# x", "t"),
        (13, "x" * 20_000, "u"),
        (14, " ".join(words(20_000, 7)), "u"),
        (15, " ".join(base[:20]), "u"),
        (15, " ".join(base[:25]), "u"),
    ]
    return out


def docs_frame(spark, rows):
    full = [(i, t, "en", s, None if t is None else len(t), *("x",) * (len(DOC_FIELDS) - 5)) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


@pytest.fixture(scope="session")
def edge(spark):
    return docs_frame(spark, edge_texts()).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return docs_frame(spark, [])
