"""From raw documents to packed training sequences, as stages over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rulestream.llm import stages
from rulestream.llm.common import kept

STAGES = [
    ("toxicity", stages.without_toxic),
    ("simhash_near_dedup", stages.without_near_copies),
    ("decontamination", stages.without_benchmark),
    ("secrets", stages.without_secrets),
    ("packing", stages.packed),
]

#: Tokenisation, transducers, tiling and a fitted model have no SQL form: compared with plain Python in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written as Parquet before the next."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = kept(stage(spark, rows, sf_dir), name)
    return rows
