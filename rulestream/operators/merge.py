"""Upsert of keyed rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.operators.joins import quoted


@dataclass(frozen=True)
class Versioned:
    """Columns that change together, and the expression of their version in SQL. A null version is the oldest.

    Give every change a version of its own, such as its time and its sequence number.
    """

    columns: tuple[str, ...]
    version: str


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame as it is; it raises while it runs if a key is null or occurs twice.

    The rows meet by key, as they have to for a merge.
    """
    names = {k.lower() for k in keys}
    rest = [c for c in df.columns if c.lower() not in names]
    row = F.struct(F.lit(0).alias("_"), *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(rest)))
    by_key = df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("_rows"), F.first(row).alias("_row"))
    null = F.greatest(*(F.col(quoted(k)).isNull() for k in keys), F.lit(False))
    told = F.concat_ws(",", *(F.coalesce(F.col(quoted(k)).cast("string"), F.lit("null")) for k in keys))
    right = (
        F.when(null, F.raise_error(F.concat(F.lit("A key is null: "), told)).cast("boolean"))
        .when(F.col("_rows") > 1, F.raise_error(F.concat(F.lit("A key occurs more than once: "), told)).cast("boolean"))
        .otherwise(True)
    )
    of_key = {k.lower(): k for k in keys}
    place = {c: i for i, c in enumerate(rest)}
    return by_key.filter(right).select(
        *(
            F.col(quoted(of_key[c.lower()])).alias(c) if c.lower() in names else F.col(f"_row.c{place[c]}").alias(c)
            for c in df.columns
        )
    )


def complete_rows(
    updates: DataFrame, old: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Updates widened to ``columns``; what an update does not carry keeps its old value.

    Values are cast to the type of the old column, and names taken from it.
    """
    given = {c.lower() for c in updates.columns}
    missing = [c for c in columns if c.lower() not in given]
    if missing:
        updates = updates.join(old.select(*map(quoted, (*keys, *missing))), list(keys), "left")
    types = {f.name: f.dataType for f in old.schema.fields}
    return updates.select(*(F.col(quoted(c)).cast(types[c]).alias(c) for c in columns))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after the updates; columns that an update does not carry keep their value.

    A null or repeated key among the updates raises while the result is computed. One left join gives
    the rows that stay and those that change, and the keys of the table alone tell which updates
    are new. With updates that Spark knows to be small the table is read in place; hand in
    a frame that is persisted or written out, for it is read twice.
    """
    names = {k.lower() for k in keys}
    types = {f.name: f.dataType for f in target.schema.fields}
    given = {c.lower(): c for c in updates.columns}
    single = one_row_per_key(updates, keys)
    typed = single.select(
        *(F.col(quoted(given[c.lower()])).cast(types[c]).alias(c) for c in target.columns if c.lower() in given)
    )
    changes = typed.select(
        *(F.col(quoted(c)).alias(c if c.lower() in names else f"_new_{c}") for c in typed.columns),
        F.lit(True).alias("_changed"),
    )
    joined = target.join(changes, list(keys), "left")
    merged = joined.select(
        *(
            F.when(F.col("_changed"), F.col(quoted(f"_new_{c}"))).otherwise(F.col(quoted(c))).alias(c)
            if c in typed.columns and c.lower() not in names
            else F.col(quoted(c))
            for c in target.columns
        )
    )
    new = typed.join(target.select(*map(quoted, keys)), list(keys), "left_anti")
    return merged.unionByName(new, allowMissingColumns=True).select(*map(quoted, target.columns))


def merge_rows(
    old: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    versioned: Sequence[Versioned] = (),
    together: Sequence[str] = (),
) -> DataFrame:
    """The old rows after the updates, by one aggregate over both.

    A versioned group takes the value with the higher version, and keeps the old one where they are equal: the result does not
    depend on the order in which updates come, and the same ones may come twice. The other columns take the value of
    the update. Columns that an update does not carry, or a group of which it lacks a column, keep the old one.
    A null or repeated key among the updates raises while the result is computed. ``together`` names columns
    derived from the key, among ``keys`` as well, by which the rows are brought together; without it Spark does so by the whole key.
    """
    names = {k.lower() for k in keys}
    given = {c.lower() for c in updates.columns}
    of_group = {c.lower() for group in versioned for c in group.columns}
    rest = [c for c in old.columns if c.lower() not in names | of_group]
    groups = [(list(group.columns), group.version) for group in versioned]
    groups += [([c for c in rest if c.lower() in given], None), ([c for c in rest if c.lower() not in given], None)]
    groups = [(columns, version) for columns, version in groups if columns]

    new = F.col("_new")
    both = old.withColumn("_new", F.lit(False)).unionByName(updates.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    if together:
        both = both.repartition(*map(quoted, together))

    def latest(number: int, columns: list[str], version: str | None) -> Column:
        values = F.struct(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)))
        if not all(c.lower() in given for c in columns):
            order = ~new
        else:
            order = F.struct(F.expr(version), ~new) if version else new
        return F.max_by(values, order).alias(f"_group{number}")

    found = [latest(i, columns, version) for i, (columns, version) in enumerate(groups)]
    by_key = both.groupBy(*map(quoted, keys)).agg(F.count_if(new).alias("_updates"), *found)
    own = [k for k in keys if k not in together]
    told = F.concat_ws(",", *(F.coalesce(F.col(quoted(k)).cast("string"), F.lit("null")) for k in own))
    null = F.greatest(*(F.col(quoted(k)).isNull() for k in own), F.lit(False))
    right = (
        F.when(null, F.raise_error(F.concat(F.lit("A key is null: "), told)).cast("boolean"))
        .when(F.col("_updates") > 1, F.raise_error(F.concat(F.lit("A key occurs more than once: "), told)).cast("boolean"))
        .otherwise(True)
    )
    place = {c.lower(): f"_group{i}.c{j}" for i, (columns, _) in enumerate(groups) for j, c in enumerate(columns)}
    return by_key.filter(right).select(
        *(F.col(quoted(c)) if c.lower() in names else F.col(place[c.lower()]).alias(c) for c in old.columns)
    )
