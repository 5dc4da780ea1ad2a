"""Picking a specification out of its tables."""

from __future__ import annotations

import pytest

from rulestream.plans import spec as s


def step_row(order, store="sparksql", query="SELECT 1", task="t1", stage="transform"):
    return {
        "pipeline_task_id": task,
        "query_order": str(order),
        "sql_query": query,
        "temp_table_name": f"v{order}",
        "database_type": store,
        "transformation_step": stage,
    }


def mapping_row(order, target, rule="passthrough", task="t1"):
    return {
        "pipeline_task_id": task,
        "column_order": str(order),
        "source_col_name": f"s_{target}",
        "target_col_name": target,
        "target_data_type": "string",
        "transformation_rule": rule,
    }


def source_row(join="none", key="", task="t1"):
    return {
        "pipeline_task_id": task,
        "sql_query": "SELECT * FROM x",
        "join_type": join,
        "merge_key": key,
    }


def rule_row(column, kind, stage="both", enum="", fmt="", task="t1"):
    return {
        "pipeline_task_id": task,
        "col_name": column,
        "validation_type": stage,
        "validation_name": kind,
        "enum_value": enum,
        "source_date_format": fmt,
    }


def test_steps_of_a_task_in_order():
    rows = [step_row(3), step_row(1, stage="NORMALISE"), step_row(2, task="other")]
    steps = s.steps_from_rows(rows, "t1")
    assert [(x.order, x.stage) for x in steps] == [
        (1, s.Stage.NORMALISE),
        (3, s.Stage.TRANSFORM),
    ]
    assert s.steps_from_rows(rows, "none") == ()


@pytest.mark.parametrize(
    "store, query, kind",
    [
        ("phoenix", "db.t", s.StepKind.TABLE),
        ("HIVE", "db.t", s.StepKind.TABLE),
        ("hive", "SELECT a.b FROM db.t", s.StepKind.SQL),
        ("sparksql", "SELECT a.b FROM db.t", s.StepKind.SQL),
    ],
)
def test_step_kinds(store, query, kind):
    assert s.steps_from_rows([step_row(1, store, query)], "t1")[0].kind is kind


def test_unknown_store_and_stage():
    with pytest.raises(ValueError, match="Unknown database type"):
        s.steps_from_rows([step_row(1, "mongo")], "t1")
    with pytest.raises(ValueError):
        s.steps_from_rows([step_row(1, stage="later")], "t1")


def test_schema_remap_touches_tables_only():
    rows = [
        step_row(1, "phoenix", "db.t"),
        step_row(2, "phoenix", "other.t"),
        step_row(3, "hive", "SELECT a.b FROM db.t"),
    ]
    queries = [x.query for x in s.steps_from_rows(rows, "t1", {"db": "db_test"})]
    assert queries == ["db_test.t", "other.t", "SELECT a.b FROM db.t"]
    with pytest.raises(ValueError, match=r"Invalid reference table format: t\. Expected"):
        s.steps_from_rows([step_row(1, "phoenix", "t")], "t1", {"db": "x"})
    assert s.steps_from_rows([step_row(1, "phoenix", "t")], "t1")[0].query == "t"


def test_source_query_has_to_be_unique():
    source = s.source_from_rows([source_row("LEFT", "a, b"), source_row(task="x")], "t1")
    assert (source.join, source.merge_key) == (s.JoinKind.LEFT, ("a", "b"))
    with pytest.raises(ValueError, match="Cannot find source data query configuration"):
        s.source_from_rows([], "t1")
    with pytest.raises(ValueError, match="Multiple source data query configuration entries"):
        s.source_from_rows([source_row(), source_row()], "t1")


def test_mappings_are_ordered_and_unique():
    rows = [mapping_row(10, "b"), mapping_row(2, "a"), mapping_row(1, "z", task="x")]
    assert [m.target for m in s.mappings_from_rows(rows, "t1")] == ["a", "b"]
    with pytest.raises(ValueError, match="Cannot find transformation column mapping"):
        s.mappings_from_rows(rows, "none")
    with pytest.raises(ValueError, match="Duplicate target column: A"):
        s.mappings_from_rows([mapping_row(1, "a"), mapping_row(2, "A")], "t1")


RULE_ROWS = [
    rule_row("k1, k2", "validation_key"),
    rule_row("flag", "is_enum", "pre_transform", enum="Y, N,"),
    rule_row("name", "IS_MANDATORY"),
    rule_row("day", "is_valid_date", "post_transform", fmt="yyyy-MM-dd"),
    rule_row("x", "is_integer", task="t2"),
]


def test_rules_of_a_stage():
    pre = s.rules_from_rows(RULE_ROWS, "t1", s.ValidationStage.PRE)
    assert pre.key == ("k1", "k2")
    assert [(r.column, r.kind) for r in pre.rules] == [
        ("flag", s.RuleKind.ENUM),
        ("name", s.RuleKind.MANDATORY),
    ]
    assert pre.rules[0].enum == ("Y", "N", None)
    post = s.rules_from_rows(RULE_ROWS, "t1", s.ValidationStage.POST)
    assert [r.date_format for r in post.rules] == ["", "yyyy-MM-dd"]


def test_rules_without_key_or_without_rules():
    with pytest.raises(ValueError, match="Validation key not found"):
        s.rules_from_rows(RULE_ROWS, "t2", s.ValidationStage.PRE)
    assert s.rules_from_rows(RULE_ROWS, "none", s.ValidationStage.PRE) == s.RuleSet()


@pytest.mark.parametrize(
    "text, values",
    [("", ()), ("  ", ()), (None, ()), ("0,1", ("0", "1")), ("Y,N,", ("Y", "N", None))],
)
def test_enum_values(text, values):
    assert s.enum_values(text) == values


def test_date_patterns_are_tried_once(spark):
    good = s.ValidationRule("d", s.RuleKind.DATE, date_format="dd/MM/yyyy")
    s.check_date_patterns(spark, [good, s.ValidationRule("a", s.RuleKind.INTEGER)])
    for pattern in ("YY/MM/DD", "nonsense"):
        bad = s.ValidationRule("d", s.RuleKind.DATE, date_format=pattern)
        with pytest.raises(ValueError, match="Date pattern not supported"):
            s.check_date_patterns(spark, [good, bad])


def test_whole_specification_from_csv_tables(spark, folder):
    spark.createDataFrame([step_row(1, stage="normalise")]).write.option(
        "header", "true"
    ).csv(f"{folder}/steps")
    rows = [
        r.asDict() for r in spark.read.csv(f"{folder}/steps", header=True, quote='"').collect()
    ]
    made = s.pipeline_from_rows(
        "demo", "t1", rows, [source_row()], [mapping_row(1, "a")], RULE_ROWS
    )
    assert made.normalised_view == "v1"
    assert made.pre_rules.key == ("k1", "k2")
    assert made.steps_of(s.Stage.TRANSFORM) == []
    assert (made.batch_view, made.strict_casts) == ("stream_df", False)
    whole = s.pipeline_from_rows(
        "demo",
        "t1",
        rows,
        [source_row()],
        [mapping_row(1, "a")],
        RULE_ROWS,
        batch_view="global_temp.stream_df",
        strict_casts=True,
        strict_rules=True,
    )
    assert (whole.batch_view, whole.strict_casts) == ("global_temp.stream_df", True)
    assert all(rule.strict for rule in whole.pre_rules.rules)


def test_an_empty_rule_and_a_step_without_its_order_are_refused():
    with pytest.raises(ValueError, match="no transformation rule"):
        s.mappings_from_rows([{**mapping_row(1, "a"), "transformation_rule": None}], "t1")
    with pytest.raises(ValueError, match="latest step needs"):
        s.SqlStep(1, "flat", "latest", s.StepKind.LATEST)
    with pytest.raises(ValueError, match="latest step needs"):
        s.SqlStep(1, "SELECT 1", "x", latest=s.Latest(("k",), ("o",)))
