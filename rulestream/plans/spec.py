"""The specification of a run: SQL steps, source query, mappings and rules.

A specification is plain data. It can be written in Python, or picked out of
specification tables with the ``*_from_rows`` helpers, which take rows as dicts
(for example ``[r.asDict() for r in spark.read.csv(path, header=True).collect()]``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from enum import Enum
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

Row = Mapping[str, Any]


class Stage(Enum):
    """When a SQL step runs."""

    NORMALISE = "normalise"
    TRANSFORM = "transform"


class StepKind(Enum):
    """SQL text, the name of a table read through a connector, or the latest rows of a view."""

    SQL = "sql"
    TABLE = "table"
    LATEST = "latest"


class JoinKind(Enum):
    """How the source query is combined with the last reference frame."""

    LEFT = "left"
    RIGHT = "right"
    UNION = "union"
    NONE = "none"


class RuleKind(Enum):
    """What a validation rule checks."""

    MANDATORY = "is_mandatory"
    DATE = "is_valid_date"
    ENUM = "is_enum"
    INTEGER = "is_integer"
    FLOAT = "is_float"


class ValidationStage(Enum):
    """Whether a rule applies before the transformation, after it, or both."""

    PRE = "pre_transform"
    POST = "post_transform"
    BOTH = "both"


# Marks of the specification tables, with the names of their columns below. The texts of the
# errors about missing, repeated or unknown entries are fixed values too.
VALIDATION_KEY = "validation_key"
PASSTHROUGH = "passthrough"
PROCESS_NAME = "stream_process_name"


@dataclass(frozen=True)
class Latest:
    """Which rows are the latest: the highest ``order`` columns of each key, so many ``rows`` of them.

    With a ``status`` column, the latest ``values`` of each of the ``statuses`` stand side by side.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    status: str = ""
    statuses: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    rows: int = 1

    def __post_init__(self) -> None:
        if self.rows < 1 or (self.status and self.rows > 1):
            raise ValueError("The latest rows are one or more, and one of each status")


@dataclass(frozen=True)
class SqlStep:
    """One step, published under ``view``: SQL text, a table name, or a view and ``latest``."""

    order: int
    query: str
    view: str
    kind: StepKind = StepKind.SQL
    stage: Stage = Stage.TRANSFORM
    latest: Latest | None = None

    def __post_init__(self) -> None:
        if (self.kind is StepKind.LATEST) != (self.latest is not None):
            raise ValueError(f"Step {self.view}: a latest step needs keys and an order, others none")


@dataclass(frozen=True)
class SourceQuery:
    """SQL over the published views, optionally combined with the reference."""

    query: str
    join: JoinKind = JoinKind.NONE
    merge_key: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnMapping:
    """One output column: where it comes from and its type.

    ``rule`` is ``passthrough``, ``stream_process_name`` or a SQL expression.
    """

    order: int
    source: str
    target: str
    target_type: str
    rule: str = PASSTHROUGH


@dataclass(frozen=True)
class ValidationRule:
    """One check of one column."""

    column: str
    kind: RuleKind
    date_format: str = ""
    enum: tuple[str | None, ...] = ()
    stage: ValidationStage = ValidationStage.BOTH
    strict: bool = False


@dataclass(frozen=True)
class RuleSet:
    """The rules of one stage and the columns that identify a record."""

    key: tuple[str, ...] = ()
    rules: tuple[ValidationRule, ...] = ()

    def __post_init__(self) -> None:
        if self.rules and not self.key:
            raise ValueError("Validation key not found")


@dataclass(frozen=True)
class PipelineSpec:
    """Everything one run needs to know.

    ``batch_view`` is the name under which the incoming frame is published. A name
    that starts with ``global_temp.`` is published as a global view, for SQL text
    written that way; a plain name keeps concurrent streams apart.
    """

    name: str
    source: SourceQuery
    mappings: tuple[ColumnMapping, ...]
    steps: tuple[SqlStep, ...] = ()
    pre_rules: RuleSet = RuleSet()
    post_rules: RuleSet = RuleSet()
    batch_view: str = "stream_df"
    strict_casts: bool = False

    def __post_init__(self) -> None:
        check_mappings(self.mappings)

    def steps_of(self, stage: Stage) -> list[SqlStep]:
        return sorted((s for s in self.steps if s.stage is stage), key=lambda s: s.order)

    @property
    def normalised_view(self) -> str:
        """The view later SQL reads the normalised records from."""
        normalise = self.steps_of(Stage.NORMALISE)
        return normalise[-1].view if normalise else self.batch_view


def check_mappings(mappings: Sequence[ColumnMapping]) -> None:
    if not mappings:
        raise ValueError("Cannot find transformation column mapping configuration")
    seen: set[str] = set()
    for mapping in mappings:
        if not mapping.rule:
            raise ValueError(f"Target column {mapping.target} has no transformation rule")
        name = mapping.target.lower()
        if name in seen:
            raise ValueError(f"Duplicate target column: {mapping.target}")
        seen.add(name)


def check_date_patterns(spark: SparkSession, rules: Iterable[ValidationRule]) -> None:
    """Raise ValueError for a date pattern Spark cannot use.

    Spark reports a bad pattern only when a row reaches it, even in the tolerant
    parse functions, so each pattern is tried once on a literal.
    """
    for pattern in sorted({r.date_format for r in rules if r.kind is RuleKind.DATE}):
        try:
            spark.range(1).select(F.try_to_date(F.lit("2000-01-01"), pattern)).collect()
        except Exception as exc:  # the JVM side uses several exception classes
            raise ValueError(f"Date pattern not supported: {pattern}") from exc


def enum_values(text: str | None) -> tuple[str | None, ...]:
    """``"Y,N,"`` gives ``("Y", "N", None)``: an empty item allows nulls."""
    if not text or not text.strip():
        return ()
    return tuple(item.strip() or None for item in text.split(","))


def _of_task(rows: Iterable[Row], task_id: str) -> list[Row]:
    return [row for row in rows if row["pipeline_task_id"] == task_id]


def _step_kind(store: str, query: str) -> StepKind:
    match store.lower():
        case "phoenix":
            return StepKind.TABLE
        case "sparksql":
            return StepKind.SQL
        case "hive":
            return StepKind.TABLE if len(query.split()) == 1 else StepKind.SQL
    raise ValueError(f"Unknown database type: {store}")


def remap_schema(step: SqlStep, schemas: Mapping[str, str]) -> SqlStep:
    """Point a table step at another schema. SQL steps are left as they are."""
    if step.kind is not StepKind.TABLE or not schemas:
        return step
    parts = step.query.split(".")
    if len(parts) != 2:
        raise ValueError(
            f"Invalid reference table format: {step.query}. Expected <schema>.<table>."
        )
    schema, table = parts
    return replace(step, query=f"{schemas.get(schema) or schema}.{table}")


def steps_from_rows(
    rows: Iterable[Row], task_id: str, schemas: Mapping[str, str] | None = None
) -> tuple[SqlStep, ...]:
    """The steps of a task in query order. No steps is allowed."""
    steps = [
        SqlStep(
            order=int(row["query_order"]),
            query=row["sql_query"],
            view=row["temp_table_name"],
            kind=_step_kind(row["database_type"], row["sql_query"]),
            stage=Stage(row["transformation_step"].lower()),
        )
        for row in _of_task(rows, task_id)
    ]
    remapped = (remap_schema(step, schemas or {}) for step in steps)
    return tuple(sorted(remapped, key=lambda s: s.order))


def source_from_rows(rows: Iterable[Row], task_id: str) -> SourceQuery:
    """The one source query of a task."""
    found = _of_task(rows, task_id)
    if not found:
        raise ValueError("Cannot find source data query configuration")
    if len(found) > 1:
        raise ValueError("Multiple source data query configuration entries")
    row = found[0]
    keys = tuple(k.strip() for k in (row.get("merge_key") or "").split(",") if k.strip())
    return SourceQuery(row["sql_query"], JoinKind(row["join_type"].lower()), keys)


def mappings_from_rows(rows: Iterable[Row], task_id: str) -> tuple[ColumnMapping, ...]:
    """The column mappings of a task in column order."""
    mappings = sorted(
        (
            ColumnMapping(
                order=int(row["column_order"]),
                source=row["source_col_name"],
                target=row["target_col_name"],
                target_type=row["target_data_type"],
                rule=row["transformation_rule"],
            )
            for row in _of_task(rows, task_id)
        ),
        key=lambda m: m.order,
    )
    check_mappings(mappings)
    return tuple(mappings)


def rules_from_rows(rows: Iterable[Row], task_id: str, stage: ValidationStage) -> RuleSet:
    """The rules of a task that apply to ``stage``, and the record key."""
    chosen = [
        row
        for row in _of_task(rows, task_id)
        if ValidationStage(row["validation_type"].lower()) in (stage, ValidationStage.BOTH)
    ]
    keys = [r for r in chosen if r["validation_name"].lower() == VALIDATION_KEY]
    rules = tuple(
        ValidationRule(
            column=row["col_name"],
            kind=RuleKind(row["validation_name"].lower()),
            date_format=row.get("source_date_format") or "",
            enum=enum_values(row.get("enum_value")),
            stage=ValidationStage(row["validation_type"].lower()),
        )
        for row in chosen
        if row["validation_name"].lower() != VALIDATION_KEY
    )
    key = tuple(c.strip() for c in keys[0]["col_name"].split(",")) if keys else ()
    return RuleSet(key, rules)


def pipeline_from_rows(
    name: str,
    task_id: str,
    steps: Iterable[Row],
    sources: Iterable[Row],
    mappings: Iterable[Row],
    rules: Iterable[Row],
    schemas: Mapping[str, str] | None = None,
    batch_view: str = "stream_df",
    strict_casts: bool = False,
    strict_rules: bool = False,
) -> PipelineSpec:
    """The whole specification of a task from the rows of its four tables."""
    rules = list(rules)

    def stage_rules(stage: ValidationStage) -> RuleSet:
        found = rules_from_rows(rules, task_id, stage)
        return RuleSet(found.key, tuple(replace(rule, strict=strict_rules) for rule in found.rules))

    return PipelineSpec(
        name=name,
        source=source_from_rows(sources, task_id),
        mappings=mappings_from_rows(mappings, task_id),
        steps=steps_from_rows(steps, task_id, schemas),
        pre_rules=stage_rules(ValidationStage.PRE),
        post_rules=stage_rules(ValidationStage.POST),
        batch_view=batch_view,
        strict_casts=strict_casts,
    )
