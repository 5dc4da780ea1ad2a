"""Where intermediate tables may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder the cluster names.

    Where no such folder is set, it lies in the warehouse, which a cluster shares as well.
    """
    shared = spark.conf.get(SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """The frame as a Parquet table in a new folder.

    For a frame that several branches of a plan read: it is computed once, survives the
    loss of executors, and Spark knows its size when it chooses a join.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write of the folder has ended well."""
    system, place = _file_system(spark, f"{folder}/_SUCCESS")
    return system.exists(place)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a job has written and does not need any more."""
    system, place = _file_system(spark, folder)
    system.delete(place, True)


def folders_of(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The folders so many levels below a folder; none where it does not exist."""
    system, place = _file_system(spark, f"{folder}{'/*' * depth}")
    return [str(found.getPath()) for found in system.globStatus(place) or [] if found.isDirectory()]
