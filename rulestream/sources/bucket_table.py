"""A keyed table on Parquet, partitioned by a bucket of the key, that is upserted bucket by bucket."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from rulestream.operators.joins import distinct_keys, lookup_semi, quoted
from rulestream.operators.merge import Versioned, merge_rows, one_row_per_key
from rulestream.sources.shared import complete, folders_of, remove
from rulestream.sources.sinks import BATCH, RUN, place_of, replace_folder

#: The partition column.
BUCKET = "key_bucket"


@dataclass(frozen=True)
class BucketTable:
    """Its key is a primary key: a null or repeated key in a batch raises.

    ``buckets`` is fixed with the first load. One task rewrites one bucket, so choose it such that a bucket is some hundred
    megabytes; ``resized`` makes a table with another number. Columns of a ``versioned`` group change only
    if the version of the update is higher, so the table does not depend on the order of batches. The others take
    the value of the last batch.

    One job writes at a time. A batch is merged into a folder named by its run and number, which then replaces the buckets
    it touches. Where that was interrupted, the next merge replaces them first. A reader at that
    moment may miss a bucket; for readers beside the writer put a store with snapshots behind ``ConnectorTable``.
    """

    path: str
    keys: tuple[str, ...]
    schema: StructType
    buckets: int = 16
    versioned: tuple[Versioned, ...] = ()

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def staged_path(self) -> str:
        return f"{self.path}/staged"

    @property
    def full_schema(self) -> StructType:
        return StructType([*self.schema.fields]).add(BUCKET, IntegerType())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*map(quoted, self.keys)), F.lit(self.buckets)).cast("int")

    def _placed(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The columns of the table that are asked for, in their types, with the bucket."""
        typed = df.select(*(F.col(quoted(c)).cast(self.schema[c].dataType).alias(c) for c in columns))
        return typed.withColumn(BUCKET, self.bucket())

    def create(self, rows: DataFrame) -> None:
        """First load; it may be empty."""
        placed = self._placed(one_row_per_key(rows, self.keys), self.schema.fieldNames())
        replace_folder(placed.repartition(BUCKET), self.rows_path, BUCKET)

    def resized(self, spark: SparkSession, path: str, buckets: int) -> BucketTable:
        """A copy with another number of buckets."""
        copy = BucketTable(path, self.keys, self.schema, buckets, self.versioned)
        copy.create(self.current(spark))
        return copy

    def _stored(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(self.full_schema).parquet(path)

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as of now."""
        return self._stored(spark, self.rows_path).select(*map(quoted, self.schema.fieldNames()))

    def _touched(self, keyed: DataFrame) -> DataFrame:
        """The rows of the buckets that occur in a frame.

        What is broadcast has one row per bucket at most. It prunes the partitions of the scan while the query runs; Spark plans that
        only for a side with a filter, hence the one that always holds.
        """
        buckets = keyed.select(BUCKET).where(F.col(BUCKET) < self.buckets).distinct()
        return self._stored(keyed.sparkSession, self.rows_path).join(F.broadcast(buckets), BUCKET, "left_semi")

    def lookup(self, incoming: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
        """Current rows of the keys in ``incoming``, read from their buckets only."""
        keyed = distinct_keys(self._placed(incoming, self.keys), (BUCKET, *self.keys))
        found = lookup_semi(self._touched(keyed), keyed, (BUCKET, *self.keys))
        return found.select(*map(quoted, self.schema.fieldNames())).select(*columns)

    def merge(self, updates: DataFrame, batch_id: int, run: int = 0) -> None:
        """Write updates that may lack columns; those keep their value.

        Updates say what a row becomes. Merged again after a failure they give the same table; an update that
        adds to the old value needs a version for that.
        """
        spark = updates.sparkSession
        place = place_of(self.staged_path, run, batch_id)
        for other in folders_of(spark, self.staged_path, 2):
            if not other.endswith(f"/{RUN}={run}/{BATCH}={batch_id}"):
                if complete(spark, other):
                    self._publish(spark, other)
                remove(spark, other)
        if not complete(spark, place):
            replace_folder(self._merged(updates), place, BUCKET)
        self._publish(spark, place)
        remove(spark, place)

    def _merged(self, updates: DataFrame) -> DataFrame:
        """The new content of all touched buckets. One shuffle, by bucket."""
        given = {c.lower() for c in updates.columns}
        placed = self._placed(updates, [c for c in self.schema.fieldNames() if c.lower() in given])
        return merge_rows(self._touched(placed), placed, (BUCKET, *self.keys), self.versioned, together=(BUCKET,))

    def _publish(self, spark: SparkSession, place: str) -> None:
        """Replace the buckets that a folder holds."""
        writer = self._stored(spark, place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.rows_path)
