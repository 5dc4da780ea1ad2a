"""Offsets and metrics."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rulestream.operators import audit

LEDGER = "topic_name string, topic_partition string, topic_offset bigint"


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def ledger(spark):
    return spark.createDataFrame(
        [("t", "0", 4), ("t", "1", 9), ("t", "0", 3), ("u", "0", 100)], LEDGER
    )


def test_latest_offset_per_partition(spark):
    df = spark.createDataFrame(
        [("0", 1), ("0", 4), ("0", 2), ("1", 7)], "partition string, offset bigint"
    )
    assert bag(audit.latest_offsets(df)) == [("0", 4), ("1", 7)]


def test_progress_counts_undecodable_rows(spark):
    df = spark.createDataFrame(
        [(0, 1, "a"), (0, 2, None), (1, 5, None)], "partition int, offset bigint, body string"
    )
    assert bag(audit.offset_ranges(df, "t")) == [("t", "0", 3, 1, 2), ("t", "1", 6, 5, 1)]


def by_offset(ranges):
    """Missing and repeated offsets of one partition, offset by offset."""
    read = [range(first, after) for first, after in sorted(ranges, key=lambda r: (r[0], -r[1]))]
    seen, again = set(), set()
    for part in read:
        again |= seen & set(part)
        seen |= set(part)
    return set(range(min(seen), max(seen))) - seen, again


@pytest.mark.parametrize(
    "ranges",
    [
        [(0, 5), (5, 9)],
        [(0, 5), (7, 9), (12, 13)],
        [(3, 9), (3, 5), (4, 6), (8, 12)],
        [(0, 100), (10, 20), (30, 40), (100, 101)],
        [(5, 6), (0, 2), (0, 2)],
    ],
)
def test_gaps_and_overlaps_of_ranges(spark, ranges):
    rows = [("t", "p", after, first) for first, after in ranges] + [("t", "q", 9, 1)]
    frame = spark.createDataFrame(rows, "topic_name string, topic_partition string, topic_offset bigint, first_offset bigint")
    missing, again = by_offset(ranges)
    gaps = audit.offset_gaps(frame).collect()
    assert {o for r in gaps for o in range(r.first_missing, r.last_missing + 1)} == missing
    overlaps = audit.offset_overlaps(frame).collect()
    assert {o for r in overlaps for o in range(r.first_again, r.last_again + 1)} == again
    assert {r.topic_partition for r in gaps + overlaps} <= {"p"}


def test_ledger_holds_the_next_offset(spark):
    latest = spark.createDataFrame([(0, 4), (1, 9)], "partition int, offset bigint")
    rows = audit.ledger_rows(latest, "t")
    assert rows.dtypes == [
        ("topic_name", "string"),
        ("topic_partition", "string"),
        ("topic_offset", "bigint"),
    ]
    assert bag(rows) == [("t", "0", 5), ("t", "1", 10)]


def test_changes_only_move_forward(spark, ledger):
    rows = spark.createDataFrame([("t", "0", 5), ("t", "1", 9), ("t", "2", 1)], LEDGER)
    assert bag(audit.ledger_changes(ledger, rows)) == [("t", "0", 5), ("t", "2", 1)]
    older = spark.createDataFrame([("t", "1", 2)], LEDGER)
    assert bag(audit.ledger_changes(ledger, older)) == []
    assert bag(audit.ledger_changes(ledger, rows.limit(0))) == []


def test_merge_is_idempotent_and_keeps_absent_partitions(spark, ledger):
    rows = spark.createDataFrame([("t", "0", 5), ("t", "1", 2)], LEDGER)
    once = audit.merge_ledger(ledger, rows)
    assert bag(once) == [("t", "0", 5), ("t", "1", 9), ("u", "0", 100)]
    assert bag(audit.merge_ledger(once, rows)) == bag(once)
    assert bag(audit.merge_ledger(ledger)) == [("t", "0", 4), ("t", "1", 9), ("u", "0", 100)]


def test_starting_offsets(spark, ledger):
    assert json.loads(audit.read_starting_offsets(ledger, "t")) == {"t": {"0": 4, "1": 9}}
    assert bag(audit.ledger_of_topic(ledger, "u")) == [("0", 100)]
    with pytest.raises(LookupError, match="No offsets found for x"):
        audit.read_starting_offsets(ledger, "x")


@pytest.fixture
def metrics(spark):
    def at(minute):
        return dt.datetime(2024, 1, 1, 0, minute, 0, 250000)

    names = "topic string, metrics_window_start_time timestamp_ntz, "
    names += "metrics_window_end_time timestamp_ntz, "
    names += ", ".join(f"{c} bigint" for c in audit.COUNTERS)
    rows = [
        ("t", at(5), at(9), 10, 1, 2, 3, 4, 5),
        ("t", at(1), at(3), 20, 1, 1, 1, 1, 1),
        ("t", at(2), at(12), 0, 0, 0, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, names)


def test_rollup_adds_every_counter(metrics):
    row = audit.metrics_rollup(metrics, ["topic"]).first()
    assert tuple(row)[3:] == (30, 2, 3, 4, 5, 6)
    assert (row.metrics_window_start_time.minute, row.metrics_window_end_time.minute) == (1, 12)


def test_payload(metrics):
    payload = json.loads(metrics.select(audit.metrics_payload().alias("p")).first().p)
    assert payload == {
        "topic_count": 10,
        "metrics_window_start_time": "2024-01-01T00:05:00.250000",
        "metrics_window_end_time": "2024-01-01T00:09:00.250000",
        "metrics_stages": {
            "01_validation": 1,
            "02_transformation": 2,
            "03_exception": 3,
            "04_dlq": 4,
            "05_target_write": 5,
        },
    }


def test_stats_skip_empty_batches(metrics):
    day = F.lit("2024-01-01").cast("date")
    stats = audit.stats_rows(metrics, "t", {"workflow": "w", "processed_on": day})
    assert stats.columns == ["workflow", "processed_on", "topic_name", "json_data", "logged_timestamp"]
    assert dict(stats.dtypes)["processed_on"] == "date"
    assert dict(stats.dtypes)["logged_timestamp"] == "timestamp"
    assert [(r.workflow, r.topic_name) for r in stats.collect()] == [("w", "t")] * 2
