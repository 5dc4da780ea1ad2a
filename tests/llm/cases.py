"""Documents that every operator has to bear, and helpers to compare with plain Python."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, shard STRING, _row STRING, "
    "n_tokens STRING, component_id STRING, sequence_id STRING, _key STRING, _score STRING, item_id STRING, _text STRING, _label STRING"
)
CLASHING = SCHEMA.count(",") - 4

ODD = [
    (1, ""),
    (2, None),
    (3, "one"),
    (4, "one"),
    (4, "one"),
    (None, "no key at all"),
    (5, "  \n\t \n"),
    (6, "\U0001f44d smile ﬁ café naïve 日本語 x\x00y\x1cz\x85w"),
    (7, "word " * 30_000),
    (8, "aaaa" * 5_000),
    (9, "<|endoftext|>a <|startoftext|> b<|ENDOFTEXT|>"),
]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents of (doc_id, text) or (doc_id, text, source), with columns whose names clash with results."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else None, None if r[1] is None else len(r[1]), *["x"] * CLASHING) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def texts(seed: int, n: int, words: int = 40) -> list[str]:
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(400)]
    return [" ".join(rng.choices(known, k=rng.randint(1, words))) for _ in range(n)]


def changed(text: str, rng: random.Random, times: int) -> str:
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(99))
    return " ".join(words)
