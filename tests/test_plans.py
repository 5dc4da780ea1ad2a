"""The plans behind the operators: what they read, shuffle and broadcast."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import registry
from registry import data
from rulestream.operators import joins, transform
from rulestream.operators.audit import latest_offsets
from rulestream.plans.spec import JoinKind, SqlStep, StepKind

registry.load()
# Queries that only plan; the others write tables before they return a frame.
PLANNED = [
    name
    for name, function in registry.QUERIES.items()
    if function.__module__ not in ("registry.tables", "registry.streams")
]


@contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loops_and_no_python(spark, sf, name):
    plan = physical(registry.QUERIES[name](spark, sf))
    for operator in ("NestedLoopJoin", "CartesianProduct", "Python", "Pandas", "Arrow"):
        assert operator not in plan


def test_computed_key_beside_a_condition_in_the_join(spark, sf):
    """The same join with a CASE in its ON clause runs as a nested loop."""
    messages, accounts = data.messages(spark, sf), data.accounts(spark, sf)
    condition = F.when(
        F.col("origin") == "APP",
        F.concat(F.lit("ACCT^"), "acc_num", F.lit("^"), "nsc") == F.col("account_key"),
    )
    assert "NestedLoopJoin" in physical(messages.join(accounts, condition, "left"))
    assert "HashJoin" in physical(registry.QUERIES["enrich_by_computed_key"](spark, sf))


def test_latest_row_is_reduced_before_the_shuffle(spark, sf):
    plan = physical(registry.QUERIES["latest_row"](spark, sf))
    assert re.search(r"SortAggregate.*Exchange.*SortAggregate.*partial_max", plan, re.S)
    with_map = data.messages(spark, sf).withColumn("m", F.create_map("seq_num", "nsc"))
    plan = physical(transform.latest_per_key(with_map, ["acc_num"], ["sent_at"], ["event_id"]))
    assert re.search(r"WindowGroupLimit .*Final.*Exchange.*WindowGroupLimit .*Partial", plan, re.S)


def test_latest_offsets_need_neither_sort_nor_window(spark, sf):
    plan = physical(registry.QUERIES["offsets_latest"](spark, sf))
    assert "Sort" not in plan
    assert "Window" not in plan
    assert "partial_max" in plan


def test_scans_read_only_what_is_used(spark, sf):
    plan = physical(registry.QUERIES["offsets_latest"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint>" in plan
    plan = physical(registry.QUERIES["reference_scan"](spark, sf))
    assert "c_acctbal" not in plan
    plan = physical(registry.QUERIES["source_query"](spark, sf))
    assert "o_totalprice" not in plan


def test_payloads_are_decoded_once(spark, sf):
    for name in ("normalise_nested", "split_valid", "split_invalid"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("from_json(") == 1


def test_rules_are_evaluated_once(spark, sf):
    for name in ("validate_accept", "validate_reject", "reject_summary_rows", "validate_tag"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("try_to_date") == 1


def test_validation_does_not_shuffle(spark, sf):
    for name in ("validate_accept", "validate_reject", "reject_summary_rows", "validate_tag"):
        assert "Exchange" not in physical(registry.QUERIES[name](spark, sf))


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key."""
    number = F.col("id")
    hot = F.when(number % 3 == 0, F.lit(7)).otherwise(number % 5000)
    return spark.range(0, 300_000, 1, 8).select(
        hot.alias("k"), number.alias("n"), F.repeat(F.lit("x"), 40).alias("pad")
    )


@pytest.fixture
def reference(spark):
    return spark.range(0, 6000, 1, 4).select(
        F.col("id").alias("k"), F.concat(F.lit("r"), F.col("id")).alias("name")
    )


@pytest.mark.parametrize("kind, rows", [(JoinKind.LEFT, 300_000), (JoinKind.RIGHT, 301_000)])
def test_a_hot_key_is_split(spark, skewed, reference, kind, rows):
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        shuffle__partitions="16",
    ):
        joined = joins.join_reference(skewed, reference, ["k"], kind)
        got = joined.collect()
        assert "skew=true" in physical(joined)
    assert len(got) == rows
    assert sum(r.k == 7 for r in got) == skewed.filter("k = 7").count()


def test_a_hot_key_sends_one_row_per_task(spark, skewed):
    latest = transform.latest_per_key(skewed, ["k"], ["n"], ["n"])
    expected = {r.k: r.n for r in skewed.groupBy("k").agg(F.max("n").alias("n")).collect()}
    assert {r.k: r.n for r in latest.collect()} == expected
    tree = latest._jdf.queryExecution().executedPlan()
    sent = _shuffled_rows(tree)
    assert sent <= 8 * len(expected)


def _shuffled_rows(plan) -> int:
    """Rows written by the only shuffle of an executed plan."""
    stages = [plan.executedPlan() if hasattr(plan, "executedPlan") else plan]
    while stages:
        node = stages.pop()
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            return metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        stages += [children.apply(i) for i in range(children.size())]
        if node.nodeName().endswith("QueryStage"):
            stages.append(node.plan())
    raise AssertionError("no shuffle found")


def test_latest_offsets_of_a_hot_partition(spark, skewed):
    rows = skewed.select(F.col("k").alias("partition"), F.col("n").alias("offset"))
    assert latest_offsets(rows).filter("partition = 7").first().offset == 299_997


def test_top_rows_are_limited_on_both_sides_of_the_shuffle(spark, sf):
    plan = physical(registry.QUERIES["latest_n_rows"](spark, sf))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert plan.count("Exchange") == 1
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below


def test_ties_of_top_rows_are_decided_by_the_whole_order(spark):
    rows = [(k, day, number) for k in (1, 2) for day in (1, 2) for number in range(5)] + [(3, None, 1), (3, 1, None)]
    frame = spark.createDataFrame(rows, "k int, day int, number int")
    top = transform.latest_n_per_key(frame, ["k"], ["day", "number"], 3)
    assert sorted((tuple(r) for r in top.collect()), key=str) == sorted(
        [(k, 2, 4 - i, i + 1) for k in (1, 2) for i in range(3)] + [(3, 1, None, 1), (3, None, 1, 2)], key=str
    )


def test_levels_of_rejects_take_one_shuffle(spark, sf):
    plan = physical(registry.QUERIES["reject_summary_cube"](spark, sf))
    assert plan.count("Exchange") == 1
    assert plan.count("FileScan parquet") == 1


def test_a_view_read_by_several_steps_is_computed_once(spark, sf):
    plan = physical(registry.QUERIES["shared_steps"](spark, sf))
    assert "lineitem.parquet" not in plan and "HashAggregate" not in plan
    assert plan.count("FileScan parquet") == 2


@pytest.mark.parametrize(
    ("query", "names"),
    [
        ("SELECT * FROM a JOIN db.b USING (k) WHERE x IN (SELECT y FROM `c`)", {"a", "db.b", "c"}),
        ("WITH own AS (SELECT 1 AS x FROM A) SELECT (SELECT max(z) FROM d) FROM own", {"a", "d", "own"}),
        ("SELECT 'FROM nothing'", set()),
    ],
)
def test_views_that_a_query_names(spark, query, names):
    assert transform.names_read(spark, query) == names


def test_views_that_are_shared(spark):
    def step(order, query, view, kind=StepKind.SQL):
        return SqlStep(order, query, view, kind)

    steps = [
        step(1, "t", "scan", StepKind.TABLE),
        step(2, "SELECT * FROM scan", "a"),
        step(3, "SELECT * FROM a JOIN a AS again USING (x)", "b"),
        step(4, "SELECT * FROM scan JOIN b USING (x)", "a"),
        step(5, "SELECT * FROM a JOIN b USING (x)", "c"),
    ]
    assert transform.shared_views(spark, steps) == {2}
    assert transform.shared_views(spark, steps, ["SELECT * FROM a"]) == {2, 3}


def test_a_lookup_of_accounts_prunes_buckets(spark, sf):
    plan = physical(registry.QUERIES["lookup_pruned"](spark, sf))
    assert "dynamicpruning" in plan
