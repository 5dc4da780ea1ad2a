"""Joins with reference data.

No side is broadcast by a hint. Spark broadcasts a side whose size it knows to be
small and otherwise sorts and merges, splitting oversized partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.plans.spec import JoinKind


def join_reference(
    df: DataFrame, reference: DataFrame, keys: Sequence[str], kind: JoinKind
) -> DataFrame:
    """Combine a frame with reference data on shared key columns."""
    if kind is JoinKind.NONE:
        return df
    if kind is JoinKind.UNION:
        return df.unionByName(reference, allowMissingColumns=True)
    if not keys:
        raise ValueError("A join needs at least one key column")
    if kind is JoinKind.LEFT:
        return df.join(reference, list(keys), "left")
    return _right_join(df, reference, list(keys))


def _right_join(df: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join, plus the reference rows without a partner.

    A plain right join can neither broadcast the reference side nor split a hot key of
    the incoming side. The inner join can do both, and the second part only needs the
    distinct incoming keys.
    """
    names = {k.lower() for k in keys}
    matched = df.join(reference, keys, "inner")
    alone = reference.join(distinct_keys(df, keys), keys, "left_anti")
    blank = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
        if f.name.lower() not in names
    ]
    rest = [alone[f"`{c}`"] for c in reference.columns if c.lower() not in names]
    return matched.union(alone.select(*(alone[f"`{k}`"] for k in keys), *blank, *rest))


def enrich_left(
    df: DataFrame, reference: DataFrame, key: Column, reference_key: str
) -> DataFrame:
    """Left join on a computed key. Rows whose key is null stay without a partner."""
    keyed = df.withColumn("_key", key)
    on = keyed["_key"] == reference[reference_key]
    return keyed.join(reference, on, "left").drop("_key")


def key_range(incoming: DataFrame, key: str) -> Column:
    """A filter for the range in which the keys of a frame lie. Sources can skip the rest.

    Two values reach the driver, so hand in a frame that is persisted or cheap.
    """
    low, high = incoming.agg(F.min(quoted(key)), F.max(quoted(key))).first()
    return F.lit(False) if low is None else F.col(quoted(key)).between(low, high)


def quoted(column: str) -> str:
    """A column name for an expression; a dot in it is part of the name."""
    return f"`{column}`"


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once."""
    return df.select(*map(quoted, keys)).distinct()


def lookup_semi(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = ("*",),
) -> DataFrame:
    """Rows of ``target`` whose key occurs in ``incoming``. No keys, no rows."""
    return target.join(distinct_keys(incoming, keys), list(keys), "left_semi").select(*columns)
