"""A keyed table behind a connector that upserts by its own primary key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rulestream.operators.joins import key_range, lookup_semi
from rulestream.operators.merge import one_row_per_key
from rulestream.sources.readers import read_table
from rulestream.sources.sinks import append


@dataclass(frozen=True)
class ConnectorTable:
    """Reads and appends through a named connector.

    The store keeps the values of columns an append does not carry. It has one version
    of a row only, so a replayed batch reads what its first attempt wrote. Give a JDBC
    table its split options, or it is read through one connection.
    """

    fmt: str
    keys: tuple[str, ...]
    options: Mapping[str, str] = field(default_factory=dict)

    def current(self, spark: SparkSession) -> DataFrame:
        """The whole table."""
        return read_table(spark, self.fmt, self.options)

    def lookup(self, incoming: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
        """Rows of the keys in ``incoming``, read within the range of those keys."""
        table = self.current(incoming.sparkSession).filter(key_range(incoming, self.keys[0]))
        return lookup_semi(table, incoming, self.keys, columns)

    def merge(self, updates: DataFrame, batch_id: int, run: int = 0) -> None:
        """Append the updates; the store replaces the rows of their keys."""
        append(one_row_per_key(updates, self.keys), self.fmt, self.options)
