"""Readers. Connection options always come from the caller, unchanged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Options = Mapping[str, str]


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Options | None = None,
    schema: StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded frame from any streaming source."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    options: Options | None = None,
) -> DataFrame:
    """A Kafka topic as a stream. ``options`` are applied last and win.

    The starting position counts for a first start only; after that the checkpoint of
    the query decides.
    """
    base = {
        "subscribe": topic,
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting_offsets,
    }
    return read_stream(spark, "kafka", {**base, **(options or {})})


def read_table(
    spark: SparkSession,
    fmt: str,
    options: Options | None = None,
    columns: Sequence[str] = ("*",),
    path: str | None = None,
) -> DataFrame:
    """A reference table through a named connector, reduced to the columns."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.load(path) if path else reader.load()).select(*columns)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Options | None = None,
    split: tuple[str, int | str, int | str, int] | None = None,
) -> DataFrame:
    """A JDBC table, or a query in parentheses with an alias.

    ``split`` is ``(column, lower, upper, partitions)``. Without it the whole table
    comes through one connection, which suits small tables only.
    """
    given = {"url": url, "dbtable": table, **(options or {})}
    if split is not None:
        column, lower, upper, partitions = split
        given |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**given).load()


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, options: Options | None = None
) -> DataFrame:
    """CSV files with a header. The schema is given, so nothing is read to infer it."""
    return spark.read.options(**{"header": "true", **(options or {})}).schema(schema).csv(path)
