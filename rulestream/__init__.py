"""Rule-driven record processing on Spark tables and streams."""

from rulestream.plans.pipeline import BatchResult, process_batch
from rulestream.plans.spec import (
    ColumnMapping,
    JoinKind,
    PipelineSpec,
    RuleKind,
    RuleSet,
    SourceQuery,
    SqlStep,
    Stage,
    StepKind,
    ValidationRule,
    ValidationStage,
)
from rulestream.streaming.runner import StreamJob

__all__ = [
    "BatchResult",
    "ColumnMapping",
    "JoinKind",
    "PipelineSpec",
    "RuleKind",
    "RuleSet",
    "SourceQuery",
    "SqlStep",
    "Stage",
    "StepKind",
    "StreamJob",
    "ValidationRule",
    "ValidationStage",
    "process_batch",
]
