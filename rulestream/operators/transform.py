"""Ordered SQL steps, the source query, column mappings and latest rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from rulestream.operators.joins import join_reference
from rulestream.plans.spec import (
    PASSTHROUGH,
    PROCESS_NAME,
    ColumnMapping,
    JoinKind,
    Latest,
    SourceQuery,
    SqlStep,
    StepKind,
    check_mappings,
)
from rulestream.sources.shared import run_folder, written

GLOBAL_VIEWS = "global_temp."

TableReader = Callable[[SparkSession, str], DataFrame]
#: Writes a frame out under the name of its view, and reads it back.
Keeper = Callable[[DataFrame, str], DataFrame]


def publish(df: DataFrame, view: str) -> None:
    """Make a frame readable by name in later SQL of the same session."""
    if view.startswith(GLOBAL_VIEWS):
        df.createOrReplaceGlobalTempView(view.removeprefix(GLOBAL_VIEWS))
    else:
        df.createOrReplaceTempView(view)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def keep_in_run_folder(df: DataFrame, view: str) -> DataFrame:
    return written(df, run_folder(df.sparkSession, "view"))


def names_read(spark: SparkSession, query: str) -> set[str]:
    """The tables and views that a query names, in lower case, from its parsed plan. Names of its own subqueries are among them."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query).toString()
    return {name.replace(", ", ".").replace("`", "").lower() for name in re.findall(r"UnresolvedRelation \[([^\]]+)\]", plan)}


def shared_views(spark: SparkSession, steps: Sequence[SqlStep], then: Sequence[str] = ()) -> set[int]:
    """Places of the steps whose view is read by two or more of the later steps, or of the queries that come ``then``.

    A step that publishes a view of the same name ends the life of the earlier one. A table is not among them: a copy of it
    costs more than to read the columns that each step needs.
    """
    read = [
        set() if s.kind is StepKind.TABLE else {s.query.lower()} if s.kind is StepKind.LATEST else names_read(spark, s.query)
        for s in steps
    ]
    read += [names_read(spark, query) for query in then]
    shared = set()
    for place, step in enumerate(steps):
        if step.kind is StepKind.TABLE:
            continue
        view = step.view.lower()
        readers = 0
        for later in range(place + 1, len(read)):
            readers += view in read[later]
            if later < len(steps) and steps[later].view.lower() == view:
                break
        if readers > 1:
            shared.add(place)
    return shared


def run_steps(
    spark: SparkSession,
    steps: Sequence[SqlStep],
    read_table: TableReader = read_catalog_table,
    then: Sequence[str] = (),
    keep: Keeper = keep_in_run_folder,
) -> DataFrame | None:
    """Run the steps in order and return the last frame, or None without steps.

    A step only adds to the plan of those that read it. Where several do, it would be computed for each of them: such a view
    is written out once with ``keep``, and they read that. ``then`` are queries over the views that follow the steps.
    """
    last = None
    ordered = sorted(steps, key=lambda s: s.order)
    shared = shared_views(spark, ordered, then)
    for place, step in enumerate(ordered):
        if step.kind is StepKind.TABLE:
            last = read_table(spark, step.query)
        elif step.kind is StepKind.LATEST:
            last = _latest(spark.table(step.query), step.latest)
        else:
            last = spark.sql(step.query)
        if place in shared:
            last = keep(last, step.view)
        publish(last, step.view)
    return last


def _latest(df: DataFrame, by: Latest) -> DataFrame:
    if by.status:
        return latest_per_status(df, by.keys, by.status, by.statuses, by.order, by.values)
    if by.rows > 1:
        return latest_n_per_key(df, by.keys, by.order, by.rows)
    return latest_per_key(df, by.keys, by.order[:1], by.order)


def run_source_query(
    spark: SparkSession, source: SourceQuery, reference: DataFrame | None
) -> DataFrame:
    """The source query, combined with the reference frame if one is asked for."""
    if source.join is not JoinKind.NONE and reference is None:
        raise ValueError("Join type specified, but no reference data")
    df = spark.sql(source.query)
    if source.join is JoinKind.NONE or reference is None:
        return df
    return join_reference(df, reference, source.merge_key, source.join)


def mapped_column(mapping: ColumnMapping, process_name: str, strict: bool = False) -> Column:
    """The value of one output column in its target type.

    A value that does not fit the type becomes null; with ``strict`` it raises.
    """
    rule = mapping.rule.lower()
    if rule == PASSTHROUGH:
        value = F.col(mapping.source)
    elif rule == PROCESS_NAME:
        value = F.lit(process_name)
    else:
        value = F.expr(mapping.rule)
    return value.cast(mapping.target_type) if strict else value.try_cast(mapping.target_type)


def apply_mapping(
    df: DataFrame,
    mappings: Sequence[ColumnMapping],
    process_name: str,
    strict: bool = False,
) -> DataFrame:
    """All target columns, each computed from the input columns, in mapping order."""
    check_mappings(mappings)
    return df.select(
        *(
            mapped_column(m, process_name, strict).alias(m.target)
            for m in sorted(mappings, key=lambda m: m.order)
        )
    )


def flatten(
    df: DataFrame, fields: Mapping[str, str], where: Column | None = None
) -> DataFrame:
    """Nested fields as top-level columns, ``{name: path}``, after an optional filter."""
    kept = df if where is None else df.filter(where)
    return kept.select(*(F.col(path).alias(name) for name, path in fields.items()))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """The row with the highest ``order`` columns per key; ``tiebreak`` decides ties.

    Both forms keep one row per key in each map task before they shuffle, so a key that
    holds a large share of the rows still sends one row per task. The maximum of the
    whole row, order columns first, sorts by the key alone and is the faster form; a
    map has no order, so rows with one are ranked instead. Select the columns you need
    first: the maximum carries all of them.
    """
    if not tiebreak:
        raise ValueError("A tie-break column is needed for a repeatable result")
    first = list(dict.fromkeys(c.lower() for c in (*order, *tiebreak)))
    names = {c.lower(): c for c in df.columns if c.lower() not in {k.lower() for k in keys}}
    ordered = [names[c] for c in first if c in names]
    rest = [c for c in names.values() if c not in ordered]
    if any(has_map(df.schema[c].dataType) for c in rest):
        ranked = W.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*(F.desc(c) for c in (*order, *tiebreak)))
        rows = df.withColumn("_rank", F.row_number().over(ranked))
        return rows.filter("_rank = 1").drop("_rank")
    row = F.struct(*(F.col(f"`{c}`") for c in (*ordered, *rest)))
    latest = df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.max(row).alias("_row"))
    key_names = {k.lower(): k for k in keys}
    return latest.select(
        *(
            F.col(f"`{key_names[c.lower()]}`").alias(c)
            if c.lower() in key_names
            else F.col(f"_row.`{c}`").alias(c)
            for c in df.columns
        )
    )


def latest_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, place: str = "place") -> DataFrame:
    """The ``rows`` rows with the highest ``order`` columns of each key, and their ``place`` from 1.

    Columns are compared one after the other, nulls are lowest, and rows that are alike in all of them may stand in for each
    other: end the order with a column that is unique within a key. Spark limits the rows of a key in each map task
    before it shuffles, so that a hot key sends so many rows per task.
    """
    ranked = W.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*(F.desc(f"`{c}`") for c in order))
    return df.withColumn(place, F.row_number().over(ranked)).filter(F.col(place) <= rows)


def has_map(kind: DataType) -> bool:
    """Whether a type is, or holds, one that has no order."""
    if isinstance(kind, StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, (MapType, VariantType))


def latest_per_status(
    df: DataFrame,
    keys: Sequence[str],
    status: str,
    statuses: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """One row per key with the latest ``values`` of each status side by side.

    Columns are named ``<status>_<value>`` in lower case. ``order`` has to be unique
    per key. One aggregation, combined before the shuffle.
    """
    fields = list(dict.fromkeys((*order, *values)))
    latest = df.groupBy(*keys).agg(
        *(F.max(F.when(F.col(status) == s, F.struct(*fields))).alias(f"_{s}") for s in statuses)
    )
    return latest.select(
        *keys,
        *(F.col(f"_{s}.{v}").alias(f"{s.lower()}_{v}") for s in statuses for v in values),
    )
