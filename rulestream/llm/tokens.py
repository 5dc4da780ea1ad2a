"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.merging import encoder


def count_tokens(docs: DataFrame, vocabulary: str, *, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """The frame without its text, with the number of tokens of each whole text.

    ``vocabulary`` is the path of a byte-level BPE file with word ends, at the same place on
    every machine. The counts are those of the library for the file, without added tokens. A
    null or empty text has none. Rows are independent: ties and repeats count row by row, and
    a column named as ``into`` is replaced. Nothing is shuffled.
    """
    rest = [c for c in docs.columns if c not in (text, into)]
    schema = docs.select(*rest, F.lit(0).cast("long").alias(into)).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            counts = encode.count(pc.cast(batch.column(text), pa.large_string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(counts)], names=[*rest, into])

    return docs.select(*rest, text).mapInArrow(count, schema)
