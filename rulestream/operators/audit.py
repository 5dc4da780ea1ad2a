"""Offsets and run metrics.

Offsets always mean the *next* offset to read, and partitions are text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEDGER_KEY = ("topic_name", "topic_partition")
COUNTERS = ("total", "validation", "transformation", "exception", "dlq", "target_write")


def latest_offsets(df: DataFrame) -> DataFrame:
    """Highest offset per partition. An aggregate needs no sort and combines early."""
    return df.groupBy("partition").agg(F.max("offset").alias("offset"))


def offset_ranges(df: DataFrame, topic: str, *by: str) -> DataFrame:
    """Per partition of a topic: the first offset, the next one to read, and the rows read. ``by`` names columns that tell batches apart."""
    ranges = df.groupBy("partition", *by).agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("offset"), F.count(F.lit(1)).alias("rows")
    )
    return ledger_rows(ranges, topic, "first_offset", "rows", *by)


def _consumed(ranges: DataFrame) -> DataFrame:
    """The ranges with ``_next``, the offset up to which their partition has been read by those that start before.

    Ranges that start alike follow each other by their end, the longer one first. A partition of a topic has one row per batch
    here, not one per message.
    """
    order = (F.col("first_offset"), F.desc("topic_offset"))
    before = W.partitionBy(*LEDGER_KEY).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return ranges.withColumn("_next", F.max("topic_offset").over(before))


def offset_gaps(ranges: DataFrame) -> DataFrame:
    """Offsets between the first and the last one read that no batch has read: ``first_missing`` to ``last_missing``.

    ``ranges`` has one row per batch and partition, of any number of runs. A topic whose offsets are not dense, as
    that of a compacted or transactional one, has gaps of its own.
    """
    return _consumed(ranges).filter("first_offset > _next").select(
        *LEDGER_KEY, F.col("_next").alias("first_missing"), (F.col("first_offset") - 1).alias("last_missing")
    )


def offset_overlaps(ranges: DataFrame) -> DataFrame:
    """Offsets that a batch has read although one that starts before it had: ``first_again`` to ``last_again``."""
    return _consumed(ranges).filter("first_offset < _next").select(
        *LEDGER_KEY,
        F.col("first_offset").alias("first_again"),
        (F.least("topic_offset", "_next") - 1).alias("last_again"),
    )


def ledger_rows(latest: DataFrame, topic: str, *more: str) -> DataFrame:
    """Latest offsets in the form of the ledger, with more columns if named."""
    return latest.select(
        F.lit(topic).alias("topic_name"),
        F.col("partition").cast("string").alias("topic_partition"),
        (F.col("offset") + 1).cast("bigint").alias("topic_offset"),
        *more,
    )


def ledger_of_topic(ledger: DataFrame, topic: str) -> DataFrame:
    """Next offset per partition of one topic."""
    return (
        ledger.filter(F.col("topic_name") == topic)
        .groupBy("topic_partition")
        .agg(F.max("topic_offset").alias("topic_offset"))
    )


def ledger_changes(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows that move a partition of the ledger forward, or add one."""
    stored = merge_ledger(ledger).withColumnRenamed("topic_offset", "_stored")
    return (
        rows.join(stored, list(LEDGER_KEY), "left")
        .filter(F.col("_stored").isNull() | (F.col("topic_offset") > F.col("_stored")))
        .select(*rows.columns)
    )


def merge_ledger(ledger: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The ledger after the rows: the highest next offset of each partition.

    Being a maximum, it gives the same ledger when a batch is merged twice.
    """
    both = ledger if rows is None else ledger.unionByName(rows.select(*ledger.columns))
    return both.groupBy(*LEDGER_KEY).agg(F.max("topic_offset").alias("topic_offset"))


def starting_offsets(ledger: DataFrame) -> DataFrame:
    """``topic_name`` and ``{topic: {partition: next offset}}`` as JSON text.

    The collected list has one entry per partition of a topic.
    """
    entry = F.struct("topic_partition", "topic_offset")
    per_topic = (
        merge_ledger(ledger)
        .groupBy("topic_name")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("offsets"))
    )
    text = F.to_json(F.create_map(F.col("topic_name"), F.col("offsets")))
    return per_topic.select("topic_name", text.alias("starting_offsets"))


def read_starting_offsets(ledger: DataFrame, topic: str) -> str:
    """The starting position of one topic. Raises if the ledger does not know it."""
    row = starting_offsets(ledger.filter(F.col("topic_name") == topic)).first()
    if row is None:
        raise LookupError(f"No offsets found for {topic}")
    return row["starting_offsets"]


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def metrics_rollup(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Metrics of several batches as one: widest window, summed counters."""
    return metrics.groupBy(*by).agg(
        F.min("metrics_window_start_time").alias("metrics_window_start_time"),
        F.max("metrics_window_end_time").alias("metrics_window_end_time"),
        *(F.sum(c).cast("bigint").alias(c) for c in COUNTERS),
    )


def metrics_payload() -> Column:
    """The metrics of a row as nested JSON text."""

    def iso(column: str) -> Column:
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(column)

    # Names of the payload and of its stages.
    return F.to_json(
        F.struct(
            F.col("total").alias("topic_count"),
            iso("metrics_window_start_time"),
            iso("metrics_window_end_time"),
            F.struct(
                F.col("validation").alias("01_validation"),
                F.col("transformation").alias("02_transformation"),
                F.col("exception").alias("03_exception"),
                F.col("dlq").alias("04_dlq"),
                F.col("target_write").alias("05_target_write"),
            ).alias("metrics_stages"),
        )
    )


def stats_rows(
    metrics: DataFrame,
    topic: str,
    labels: Mapping[str, Column | str] | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Rows for the stats table. Batches that read nothing leave no row.

    ``labels`` are the columns by which the caller tells runs apart, with their values.
    """
    return metrics.filter(F.col("total") > 0).select(
        *(
            (value if isinstance(value, Column) else F.lit(value)).alias(name)
            for name, value in (labels or {}).items()
        ),
        F.lit(topic).alias("topic_name"),
        metrics_payload().alias("json_data"),
        (F.current_timestamp() if at is None else at).alias("logged_timestamp"),
    )
