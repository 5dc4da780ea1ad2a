"""One run over one bounded frame: normalise, validate, transform, validate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from rulestream.operators.transform import (
    Keeper,
    TableReader,
    apply_mapping,
    keep_in_run_folder,
    publish,
    read_catalog_table,
    run_source_query,
    run_steps,
)
from rulestream.operators.validate import drop_meta, split_tagged, tag
from rulestream.plans.spec import PipelineSpec, Stage, check_date_patterns


@dataclass(frozen=True)
class BatchResult:
    """The frames of one run. None of them has been executed yet.

    ``normalised`` and ``transformed`` hold all records of their stage, with the outcomes
    of its rules if it has rules.
    """

    normalised: DataFrame
    rejected_before: DataFrame
    transformed: DataFrame
    accepted: DataFrame
    rejected_after: DataFrame


def normalise(
    batch: DataFrame, spec: PipelineSpec, read_table: TableReader = read_catalog_table, keep: Keeper = keep_in_run_folder
) -> DataFrame:
    """The records of a batch after the normalise steps, tagged by the rules before the transformation.

    SQL runs in the session of the frame, where its views live.
    """
    publish(batch, spec.batch_view)
    rows = run_steps(batch.sparkSession, spec.steps_of(Stage.NORMALISE), read_table, keep=keep)
    return tag(batch if rows is None else rows, spec.pre_rules)


def transform(
    valid: DataFrame, spec: PipelineSpec, read_table: TableReader = read_catalog_table, keep: Keeper = keep_in_run_folder
) -> DataFrame:
    """The mapped records, tagged by the rules after the transformation.

    The transformation reads the validated records: they are published under the view
    name of the last normalise step, so that a record rejected before the
    transformation cannot reach the target.
    """
    publish(valid, spec.normalised_view)
    reference = run_steps(valid.sparkSession, spec.steps_of(Stage.TRANSFORM), read_table, [spec.source.query], keep)
    source = run_source_query(valid.sparkSession, spec.source, reference)
    mapped = apply_mapping(source, spec.mappings, spec.name, spec.strict_casts)
    return tag(mapped, spec.post_rules)


def process_batch(batch: DataFrame, spec: PipelineSpec, read_table: TableReader = read_catalog_table) -> BatchResult:
    """Plan a run. Date patterns are tried on a literal first, for a bad one would fail only at some row."""
    check_date_patterns(batch.sparkSession, (*spec.pre_rules.rules, *spec.post_rules.rules))
    normalised = normalise(batch, spec, read_table)
    valid, rejected_before = split_tagged(normalised, spec.pre_rules)
    transformed = transform(drop_meta(valid), spec, read_table)
    accepted, rejected_after = split_tagged(transformed, spec.post_rules)
    return BatchResult(
        normalised, rejected_before, transformed, drop_meta(accepted), rejected_after
    )
