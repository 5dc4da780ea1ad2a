"""A streaming run: one source, one checkpoint, and all outputs of a micro-batch.

A batch is dealt out evenly, decoded and written. Each stage of it is then written once, with the outcome of every record as
its partition. What follows reads the outcome it needs: undecodable rows go to the dead letters, rejected ones to the rejects
and their summary, valid ones to the transformation and accepted ones to the target. Counters are observed by the same writes. All results go to places named by
the run and the batch, so that a batch replayed after a failure replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, NullType, StringType, StructField, StructType, TimestampType

from rulestream.functions.codec import as_json, decodable, decode
from rulestream.operators.audit import (
    COUNTERS,
    merge_ledger,
    offset_ranges,
    read_starting_offsets,
    stats_rows,
)
from rulestream.operators.joins import quoted
from rulestream.operators.transform import Keeper, TableReader, read_catalog_table
from rulestream.operators.validate import (
    META_VALID,
    drop_meta,
    enforce_limit,
    reject_summary,
    tagged_counts,
)
from rulestream.plans.pipeline import normalise, transform
from rulestream.plans.spec import PipelineSpec, RuleSet, ValidationStage, check_date_patterns
from rulestream.sources.readers import read_topic
from rulestream.sources.shared import remove
from rulestream.sources.sinks import FolderSink, claim_run, dead_letters, place_of, replace_folder

#: The ledger has one row per batch and partition that it read.
LEDGER_SCHEMA = (
    StructType()
    .add("topic_name", StringType())
    .add("topic_partition", StringType())
    .add("topic_offset", LongType())
    .add("first_offset", LongType())
    .add("rows", LongType())
)
METRICS_SCHEMA = (
    StructType()
    .add("topic_name", StringType())
    .add("metrics_window_start_time", TimestampType())
    .add("metrics_window_end_time", TimestampType())
)
for _counter in COUNTERS:
    METRICS_SCHEMA = METRICS_SCHEMA.add(_counter, LongType())

#: The partition column of a written stage, and its values.
OUTCOME = "outcome"
PASSED, REJECTED, UNDECODABLE = "passed", "rejected", "undecodable"


class BatchSink(Protocol):
    """Anything that can take the rows of one batch."""

    def write(self, df: DataFrame, batch_id: int, run: int = 0) -> None: ...

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame: ...


class Target(Protocol):
    """A keyed table: a ``BucketTable`` on files or a ``ConnectorTable``."""

    def current(self, spark: SparkSession) -> DataFrame: ...

    def lookup(self, incoming: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame: ...

    def merge(self, updates: DataFrame, batch_id: int, run: int = 0) -> None: ...


@dataclass(frozen=True)
class Written:
    """A stage of a batch on disk: ``record`` holds its columns, ``letter`` an undecodable row."""

    path: str
    schema: StructType

    def of(self, spark: SparkSession, outcome: str, column: str = "record") -> DataFrame:
        """The rows of one outcome. Only its partition is read."""
        rows = spark.read.schema(self.schema).parquet(self.path)
        return rows.where(F.col(OUTCOME) == outcome).select(f"{column}.*")


@dataclass(frozen=True)
class StreamJob:
    """A stream of ``partition, offset, value`` rows into a keyed table.

    ``required`` is the sub-struct a decodable message must have. A table step named
    ``target_name`` reads the target, reduced to the keys of the batch: ``target_key``
    gives each key column as an expression over the normalised view. ``summaries`` gets
    one row per record and failed rule. A batch that rejects more than ``reject_limit``
    (a share of its records) stops the query before it reaches the target.

    ``batches`` is a folder for the stages of the batch that runs. ``ledger`` gets the range of offsets that
    a batch has read of each partition of the topic. ``stats`` gets one row per batch that read something, told apart by
    ``labels``. ``run`` tells this checkpoint's batches from those of another: give a fresh checkpoint a new, higher
    number.
    """

    spec: PipelineSpec
    topic: str
    schema: StructType | str
    required: str
    target: Target
    target_name: str
    target_key: Mapping[str, str]
    batches: str
    dead_letters: BatchSink
    rejects: BatchSink
    ledger: BatchSink
    metrics: FolderSink
    codec: str = "json"
    read_table: TableReader = read_catalog_table
    summaries: BatchSink | None = None
    stats: BatchSink | None = None
    labels: Mapping[str, str] = field(default_factory=dict)
    reject_limit: float | None = None
    run: int = 0

    def start(self, source: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        """Start the query, for example with ``availableNow=True`` as the trigger."""
        rules = (*self.spec.pre_rules.rules, *self.spec.post_rules.rules)
        check_date_patterns(source.sparkSession, rules)
        claim_run(source.sparkSession, self.batches, self.run, checkpoint)
        writer = source.writeStream.foreachBatch(self.run_batch)
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def topic_source(
        self, spark: SparkSession, servers: str, options: Mapping[str, str] | None = None
    ) -> DataFrame:
        """The job's Kafka topic, from where the ledger says; from its beginning if the ledger does not know it."""
        try:
            position = read_starting_offsets(self.offsets(spark), self.topic)
        except LookupError:
            position = "earliest"
        columns = read_topic(spark, servers, self.topic, position, options)
        return columns.select("partition", "offset", "value")

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Process one micro-batch."""
        spark = batch.sparkSession
        started = datetime.now(timezone.utc)
        # few large pieces, as of a file or a partition of a topic, are dealt out before the work on them
        dealt = batch.hint("rebalance", "partition", "offset")
        # decoded once for both sides of the first write, which run at the same time, and for the ledger
        replace_folder(fresh := decode(dealt, self.schema, self.codec), self._place("decoded", batch_id))
        decoded = spark.read.schema(fresh.schema).parquet(self._place("decoded", batch_id))
        counts = self._run(decoded, batch_id)
        row = (self.topic, started, datetime.now(timezone.utc), *(counts[c] for c in COUNTERS))
        metrics = spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1)
        self.metrics.write(metrics, batch_id, self.run)
        if self.stats is not None and counts["total"]:
            self.stats.write(stats_rows(metrics, self.topic, self.labels), batch_id, self.run)
        for stage in ("decoded", "read", "transformed", "views"):
            remove(spark, self._place(stage, batch_id))

    def _place(self, stage: str, batch_id: int) -> str:
        return place_of(f"{self.batches}/{stage}", self.run, batch_id)

    def _keeper(self, batch_id: int) -> Keeper:
        """Writes out views that several steps read."""

        def keep(df: DataFrame, view: str) -> DataFrame:
            place = f"{self._place('views', batch_id)}/{view}"
            replace_folder(df, place)
            return df.sparkSession.read.schema(df.schema).parquet(place)

        return keep

    def write_read(self, decoded: DataFrame, batch_id: int) -> tuple[Written, dict[str, int]]:
        """Write what was read, by its outcome before the transformation, and count it."""
        seen, checked = Observation(), Observation()
        whole = decodable(decoded, self.required)
        watched = decoded.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(~whole).alias("undecodable"))
        letters = dead_letters(watched.filter(~whole))
        normalised = normalise(decoded.filter(whole), self.spec, self.read_table, self._keeper(batch_id))
        rules = self.spec.pre_rules
        records = _by_outcome(normalised.observe(checked, *tagged_counts(rules)), rules)
        apart = letters.select(F.struct("*").alias("letter"), F.lit(UNDECODABLE).alias(OUTCOME))
        rows = records.unionByName(apart, allowMissingColumns=True)
        replace_folder(rows, self._place("read", batch_id), OUTCOME)
        counts = {"total": seen.get["total"], "dlq": seen.get["undecodable"], "validation": checked.get["rejected"]}
        return Written(self._place("read", batch_id), rows.schema), counts | {"checked": checked.get["total"]}

    def write_transformed(self, read: Written, spark: SparkSession, batch_id: int) -> tuple[Written, dict[str, int]]:
        """Write the transformed records by the outcome of the rules after it, and count them."""
        checked = Observation()
        rules = self.spec.post_rules
        transformed = transform(drop_meta(read.of(spark, PASSED)), self.spec, self._table_reader, self._keeper(batch_id))
        rows = _by_outcome(transformed.observe(checked, *tagged_counts(rules)), rules)
        replace_folder(rows, self._place("transformed", batch_id), OUTCOME)
        counts = {"transformation": checked.get["total"], "exception": checked.get["rejected"]}
        return Written(self._place("transformed", batch_id), rows.schema), counts

    def _run(self, decoded: DataFrame, batch_id: int) -> dict[str, int]:
        """All outputs of a batch, from its two writes."""
        spark = decoded.sparkSession
        read, counts = self.write_read(decoded, batch_id)
        if counts["dlq"]:
            self.dead_letters.write(read.of(spark, UNDECODABLE, "letter"), batch_id, self.run)
        transformed, after = self.write_transformed(read, spark, batch_id)
        counts |= after | {"target_write": after["transformation"] - after["exception"]}

        rejected = counts["validation"] + counts["exception"]
        if rejected:
            stages = (
                (read.of(spark, REJECTED), self.spec.pre_rules, ValidationStage.PRE),
                (transformed.of(spark, REJECTED), self.spec.post_rules, ValidationStage.POST),
            )
            self.rejects.write(_reject_messages(stages), batch_id, self.run)
            if self.summaries is not None:
                parts = [reject_summary(rows, rules, self.spec.name, stage) for rows, rules, stage in stages if rules.rules]
                self.summaries.write(reduce(DataFrame.unionByName, parts), batch_id, self.run)
        if self.reject_limit is not None:
            enforce_limit(rejected, counts["checked"], self.reject_limit)
        if counts["target_write"]:
            self.target.merge(drop_meta(transformed.of(spark, PASSED)), batch_id, self.run)
        self.ledger.write(offset_ranges(decoded, self.topic), batch_id, self.run)
        return counts

    def _table_reader(self, spark: SparkSession, name: str) -> DataFrame:
        if name != self.target_name:
            return self.read_table(spark, name)
        view = spark.table(self.spec.normalised_view)
        keys = view.select(*(F.expr(e).alias(k) for k, e in self.target_key.items()))
        return self.target.lookup(keys)

    def offsets(self, spark: SparkSession) -> DataFrame:
        """Next offset per partition after all batches that are done."""
        columns = ("topic_name", "topic_partition", "topic_offset")
        return merge_ledger(self.ledger.read(spark, LEDGER_SCHEMA).select(*columns))

    def batch_metrics(self, spark: SparkSession) -> DataFrame:
        """Counters and processing window of every batch."""
        return self.metrics.read(spark, METRICS_SCHEMA)


def _by_outcome(tagged: DataFrame, rules: RuleSet) -> DataFrame:
    """A tagged frame as ``record`` and its outcome. A column without a type is kept as text."""
    outcome = F.when(F.col(META_VALID), PASSED).otherwise(REJECTED) if rules.rules else F.lit(PASSED)

    def column(given: StructField):
        value = F.col(quoted(given.name))
        return (value.cast("string") if isinstance(given.dataType, NullType) else value).alias(given.name)

    return tagged.select(F.struct(*map(column, tagged.schema.fields)).alias("record"), outcome.alias(OUTCOME))


def _reject_messages(stages: Sequence[tuple[DataFrame, RuleSet, ValidationStage]]) -> DataFrame:
    """Rejected records of all stages as JSON, with the stage as the key."""
    parts = [as_json(drop_meta(rows)).select(F.lit(stage.value).alias("key"), "value") for rows, _, stage in stages]
    return reduce(DataFrame.unionByName, parts)
