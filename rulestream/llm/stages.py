"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and gives the rows that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.llm.common import free_name, kept
from rulestream.llm.packing import pack_documents
from rulestream.llm.queries import SEQUENCE, TOXIC, VOCABULARY, document_secrets, table, toxicity_model
from rulestream.llm.secrets import redacted
from rulestream.llm.simhash import near_duplicates
from rulestream.llm.tiling import contaminated
from rulestream.llm.toxicity import with_score


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity grammar does not reject."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return with_score(docs, model, into=score).where(F.col(score) < TOXIC).drop(score)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that do not hold a benchmark item."""
    found = kept(contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id"), "contaminated").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking secrets of few owners are replaced, widely copied examples stay."""
    clean = redacted(docs, document_secrets(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id.

    Of rows with that doc_id and different texts the one with the smallest hash of its text stays, and
    rows with the same doc_id and text are one document. A row without a doc_id comes after all others.
    """
    own = free_name(docs, "_own")
    marked = docs.withColumn(own, F.struct(F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text")))
    found = kept(near_duplicates(marked, words=4, distance=4, key=own), "near-copies")
    first = found.where(F.col(own) == F.col("component_id")).groupBy(own).count()
    stay = marked.join(first, own, "left_semi")
    stay = stay if first.where("count > 1").isEmpty() else stay.dropDuplicates([own])
    return stay.drop(own)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing of the documents that are left; one row per piece."""
    return pack_documents(docs, VOCABULARY, SEQUENCE)
