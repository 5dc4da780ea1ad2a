"""Writers. Connection options always come from the caller, unchanged."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from rulestream.operators.joins import quoted
from rulestream.operators.transform import has_map
from rulestream.sources.readers import read_table

RUN = "run"
BATCH = "batch_id"
#: Into how many shares the rows of one folder of a batch are dealt at most.
SHARES = 64


def place_of(path: str, run: int, batch_id: int) -> str:
    """The folder of one batch of one run."""
    return f"{path}/{RUN}={run}/{BATCH}={batch_id}"


def replace_folder(df: DataFrame, path: str, *partitions: str) -> None:
    """Write a folder anew. All of it, whatever the session says about dynamic overwriting."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def claim_run(spark: SparkSession, path: str, run: int, checkpoint: str) -> None:
    """Reserve a run number of a place for one checkpoint.

    Raises if another checkpoint has it: batch numbers start at 0 again with a fresh
    checkpoint, and would replace what the earlier run has written.
    """
    holder = f"{path}/_runs/{RUN}={run}"
    try:
        found = spark.read.schema("checkpoint string").parquet(holder).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        replace_folder(spark.createDataFrame([(checkpoint,)], "checkpoint string").coalesce(1), holder)
    elif found["checkpoint"] != checkpoint:
        raise ValueError(f"Run {run} of {path} belongs to checkpoint {found['checkpoint']}")


def append(df: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Append through a connector. One that knows the key upserts by it."""
    df.write.format(fmt).options(**options).mode("append").save()


def append_jdbc(
    df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None
) -> None:
    """Append to a JDBC table."""
    append(df, "jdbc", {"url": url, "dbtable": table, **(options or {})})


def write_topic(
    df: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Write the ``key`` and ``value`` columns that are there to a Kafka topic."""
    columns = [c for c in ("key", "value") if c in df.columns]
    base = {"kafka.bootstrap.servers": servers, "topic": topic}
    df.select(*columns).write.format("kafka").options(**{**base, **(options or {})}).save()


def dead_letters(undecodable: DataFrame) -> DataFrame:
    """Undecodable rows as messages: the partition is the key, the payload stays raw."""
    return undecodable.select(F.col("partition").cast("string").alias("key"), "offset", "value")


def _share(df: DataFrame) -> Column:
    """The share that a row belongs to, from its values. Maps have no hash."""
    values = [F.col(quoted(f.name)) for f in df.schema.fields if not has_map(f.dataType)]
    return F.pmod(F.xxhash64(*values), F.lit(SHARES))


@dataclass(frozen=True)
class ConnectorSink:
    """Sends each batch through a connector. A replayed batch is sent again."""

    fmt: str
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, batch_id: int, run: int = 0) -> None:
        append(df, self.fmt, self.options)

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        """All that the store holds."""
        return read_table(spark, self.fmt, self.options)


@dataclass(frozen=True)
class FolderSink:
    """Keeps each batch of each run in a folder of its own. A replayed batch replaces it.

    Rows are balanced before they are written: what is rejected or undecodable is
    spread thinly over all tasks of a batch and would leave a small file in each. A place
    for a row per batch needs no balance. ``partitions`` names columns whose values
    have a folder each below that of the batch; rows are balanced by them and by a share of each. Most batches have
    one value, as the month of a summary, and a task sorts all rows that it writes by the folders.
    """

    path: str
    balance: bool = True
    partitions: tuple[str, ...] = ()

    def write(self, df: DataFrame, batch_id: int, run: int = 0) -> None:
        rows = self._balanced(df) if self.balance else df
        replace_folder(rows, place_of(self.path, run, batch_id), *self.partitions)

    def _balanced(self, df: DataFrame) -> DataFrame:
        if not self.partitions:
            return df.hint("rebalance")
        return df.withColumn("_share", _share(df)).hint("rebalance", *self.partitions, "_share").drop("_share")

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        """All batches, with their ``run`` and ``batch_id``. Nothing written yet gives no rows."""
        given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        full = StructType([*given.fields]).add(RUN, IntegerType()).add(BATCH, IntegerType())
        try:
            return spark.read.schema(full).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], full)
