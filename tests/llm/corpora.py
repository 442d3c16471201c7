"""Small corpora with the cases every operator must take: nulls, empty and long texts, copies, odd bytes."""

from __future__ import annotations

import random

DIRECTORY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    known = ["".join(draw.choice("abdegilmnorstu") for _ in range(draw.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(draw.choice(known) for _ in range(words))


def awkward() -> list[tuple[int | None, str | None]]:
    """(doc_id, text) rows: a null id, null, empty and blank texts, copies, near copies, a long text."""
    base = prose(1, 120)
    edited = base.split()
    edited[60:62] = ["changed", "words"]
    long = " ".join(prose(s, 400) for s in range(2, 40))
    return [
        (0, base), (1, None), (2, ""), (3, " \n\t "), (4, base), (5, " ".join(edited)), (6, "one"), (7, "one"),
        (8, "naïve Ünïcödé 東京 \U0001f600 text"), (9, long), (10, long[5000:9000] + " tail"), (11, "x" * 3000),
        (12, base), (12, base), (None, prose(77, 50)), (13, "two words"), (14, "ONE"),
    ]


def documents(spark, rows=None):
    """The rows as a table with all columns of documents."""
    rows = awkward() if rows is None else rows
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def sample_documents(spark):
    return spark.read.parquet(f"{DIRECTORY}/documents.parquet")


def clashing(docs):
    """The same table with further columns whose names operators might use inside."""
    from pyspark.sql import functions as F

    names = ("key", "chunk", "part", "spans", "score", "component", "bucket", "tag", "place", "size", "n", "u", "v", "spot")
    return docs.select("*", *(F.lit("x").alias(n) for n in names))


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
