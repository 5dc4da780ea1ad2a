"""Payload encoding and decoding.

``json`` works with Spark alone. ``avro`` needs the spark-avro package on the class
path; its columns are built the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

PERMISSIVE = {"mode": "PERMISSIVE"}
#: Names of the parsed text: its records, and the text where one has a value that does not fit its type.
RECORDS = "_records"
FAULTY = "_faulty"
WHOLE = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def decode_payload(value: Column, schema: StructType | str, codec: str = "json") -> Column:
    """The payload as a struct, or null if any of it cannot be decoded.

    That holds for values that do not fit their type or overflow it, and for text around the
    record. Fields that the schema does not know are ignored; those that are missing are null.
    """
    if codec == "json":
        return F.get(F.transform(F.array(_parsed(value, schema)), _whole), 0)
    if codec == "avro":
        if isinstance(schema, StructType):
            raise ValueError("The avro codec takes an Avro schema in JSON text")
        return from_avro(value, schema, PERMISSIVE)
    raise ValueError(f"Unknown codec: {codec}")


def _parsed(value: Column, schema: StructType | str) -> Column:
    """The records that the text holds, the text of one that has a fault, and whether nothing follows the record.

    The parser stops at the end of a record. As the element of an array, what follows the record is a fault or one more element,
    unless it closes the array. Only a text with a bracket is looked through for that, as the value of an object, where
    a bracket is a fault.
    """
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    marked = StructType([StructField(RECORDS, ArrayType(kind)), StructField(FAULTY, StringType())])
    text = value.cast("string")
    wrapped = F.concat(F.lit(f'{{"{RECORDS}":['), text, F.lit("]}"))
    keys = F.json_object_keys(F.concat(F.lit(f'{{"{RECORDS}":'), text, F.lit("}")))
    return F.struct(
        F.from_json(wrapped, marked, {**PERMISSIVE, "columnNameOfCorruptRecord": FAULTY}).alias("found"),
        F.when(text.contains("]"), F.size(keys) == 1).otherwise(True).alias("alone"),
    )


def _whole(parsed: Column) -> Column:
    """The record if it is the only one and nothing is wrong with it."""
    records = parsed["found"][RECORDS]
    whole = parsed["found"][FAULTY].isNull() & (F.size(records) == 1) & parsed["alone"]
    return F.when(whole, F.get(records, 0))


def decode(df: DataFrame, schema: StructType | str, codec: str = "json") -> DataFrame:
    """``partition, offset, value`` and the decoded ``data``.

    Every payload is decoded once. A filter on a plain projection would be moved below
    it, with the decoding copied into the filter; it is not moved below an explode.
    """
    value, rest = F.col("value"), ("partition", "offset", "value")
    if codec == "json":
        rows = df.select(*rest, F.explode(F.array(_parsed(value, schema))).alias("_parsed"))
        return rows.select(*rest, _whole(F.col("_parsed")).alias("data"))
    return df.select(*rest, F.explode(F.array(decode_payload(value, schema, codec))).alias("data"))


def decodable(df: DataFrame, required: str) -> Column:
    """Whether a decoded message has the ``required`` sub-struct, with a value in it."""

    def some_value(kind: DataType, path: str) -> Column:
        if not isinstance(kind, StructType):
            return F.col(path).isNotNull()
        return reduce(or_, (some_value(f.dataType, f"{path}.`{f.name}`") for f in kind.fields), F.lit(False))

    data = df.schema["data"].dataType
    return some_value(data[required].dataType, f"data.`{required}`")


def split_decoded(df: DataFrame, required: str) -> tuple[DataFrame, DataFrame]:
    """Decodable and undecodable rows, told apart by the ``required`` sub-struct."""
    whole = decodable(df, required)
    return df.filter(whole), df.filter(~whole)


def encode_payload(
    columns: Sequence[str], codec: str = "json", schema: str | None = None
) -> Column:
    """The named columns as one payload."""
    record = F.struct(*columns)
    if codec == "json":
        return F.to_json(record)
    if codec == "avro":
        return to_avro(record, schema) if schema else to_avro(record)
    raise ValueError(f"Unknown codec: {codec}")


def encode(
    df: DataFrame,
    key: Column,
    columns: Sequence[str],
    codec: str = "json",
    schema: str | None = None,
) -> DataFrame:
    """``key, value`` rows, ready for a topic."""
    payload = encode_payload(columns, codec, schema)
    return df.select(key.cast("string").alias("key"), payload.alias("value"))


def as_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON ``value``. Null fields and microseconds are kept."""
    record = F.struct(*(columns or df.columns))
    return df.select(F.to_json(record, WHOLE).alias("value"))
