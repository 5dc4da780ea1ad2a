"""Helpers that several operators share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulestream.sources.shared import run_folder, written


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once into a new folder below the cluster's shared one."""
    return written(df, run_folder(df.sparkSession, name))


def free_name(df: DataFrame, name: str) -> str:
    """The name, longer by underscores if the frame has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def literal_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small table of given rows, as one expression of the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")
    return spark.range(1).select(F.inline(parsed))


def ranked(df: DataFrame, klass: str, tie: Column, rank: str, per_cell: int = 50_000) -> DataFrame:
    """Number the rows of each class from 0, without gaps, in the order of the hash ``tie``.

    A class is split by its hash into cells of about ``per_cell`` rows, so that a class with
    a third of all rows is sorted by many tasks. What is broadcast has one row per class and
    one per cell: keep the number of classes bounded. Columns whose names start with ``_cell``
    are used inside.
    """
    df = df.withColumn("_cell_tie", tie)
    cells = df.groupBy(klass).agg(F.ceil(F.count("*") / per_cell).alias("_cells"))
    df = df.join(F.broadcast(cells), klass).withColumn("_cell", F.pmod("_cell_tie", "_cells")).drop("_cells")
    before = Window.partitionBy(klass).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(klass, "_cell")
        .agg(F.count("*").alias("_cell_rows"))
        .select(klass, "_cell", F.coalesce(F.sum("_cell_rows").over(before), F.lit(0)).alias("_cell_start"))
    )
    place = F.row_number().over(Window.partitionBy(klass, "_cell").orderBy("_cell_tie")) - 1
    return (
        df.withColumn("_cell_place", place)
        .join(F.broadcast(starts), [klass, "_cell"])
        .withColumn(rank, F.col("_cell_start") + F.col("_cell_place"))
        .drop("_cell", "_cell_tie", "_cell_place", "_cell_start")
    )


def in_parts(batches: Iterable[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a part has about ``size`` bytes of a text column, and one text at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths) - lengths) // size
        for begin, end in pairwise([*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(batch)]):
            yield batch.slice(begin, end - begin)


def coded_words(
    texts: pa.Array, split_up: Callable[[pa.Array], pa.Array] = pc.utf8_split_whitespace
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """White-space separated words of texts: the distinct ones, the number of each word's, words per text."""
    split = split_up(pc.fill_null(pc.cast(texts, pa.large_string()), ""))
    coded = split.flatten().dictionary_encode()
    codes, counts = coded.indices.to_numpy(), np.diff(split.offsets.to_numpy())
    if (empty := coded.dictionary.index("").as_py()) >= 0:  # before and after white space at the ends of a text
        rows = np.repeat(np.arange(len(counts)), counts)[codes == empty]
        codes, counts = codes[codes != empty], counts - np.bincount(rows, minlength=len(counts))
    return coded.dictionary.to_pylist(), codes, counts
