"""The streaming run: micro-batches, restart, replay and failure."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, replace
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from registry import streams
from rulestream.functions.codec import decode, split_decoded
from rulestream.operators.audit import metrics_rollup, offset_gaps, offset_overlaps, read_starting_offsets
from rulestream.operators.validate import RejectLimitError
from rulestream.plans.pipeline import process_batch
from rulestream.plans.spec import (
    ColumnMapping,
    Latest,
    PipelineSpec,
    RuleKind,
    RuleSet,
    SourceQuery,
    SqlStep,
    Stage,
    StepKind,
    ValidationRule,
)
from rulestream.sources.bucket_table import BucketTable
from rulestream.sources.readers import read_stream
from rulestream.sources.sinks import FolderSink, place_of
from rulestream.streaming.runner import LEDGER_SCHEMA, PASSED, REJECTED, StreamJob

MESSAGE = "head struct<day:int, seq:int>, body struct<num:string, amount:int, status:string>"
ACCOUNT = "key string, name string, ledger int, ledger_day int, shadow int"
ACCOUNTS = [(f"A^{i}", f"name{i}", i, 0, -i) for i in range(6)]
TOPIC = "partition int, offset bigint, value binary"
LETTER = "key string, offset bigint, value binary"
MESSAGE_OUT = "key string, value string"


def spec(newer_only: bool = False) -> PipelineSpec:
    guard = "AND (ledger_day IS NULL OR day > ledger_day)" if newer_only else ""
    posted = f"(status = 'POSTED' {guard})"
    return PipelineSpec(
        name="demo",
        steps=(
            SqlStep(
                1,
                "SELECT data.head.day, data.head.seq, data.body.num, data.body.amount, "
                "data.body.status FROM stream_df",
                "flat",
                stage=Stage.NORMALISE,
            ),
            SqlStep(
                2,
                "SELECT *, concat('A^', num) AS k FROM (SELECT *, row_number() OVER "
                "(PARTITION BY num ORDER BY day DESC, seq DESC) AS rn FROM flat) WHERE rn = 1",
                "latest",
            ),
            SqlStep(3, "db.account", "account", StepKind.TABLE),
        ),
        source=SourceQuery(
            f"SELECT k, CASE WHEN {posted} THEN amount ELSE ledger END AS l, "
            f"CASE WHEN {posted} THEN day ELSE ledger_day END AS d, "
            "CASE WHEN status = 'POSTED' THEN shadow ELSE amount END AS s "
            "FROM latest LEFT JOIN account ON k = key"
        ),
        mappings=(
            ColumnMapping(1, "k", "key", "string"),
            ColumnMapping(2, "l", "ledger", "int"),
            ColumnMapping(3, "d", "ledger_day", "int"),
            ColumnMapping(4, "s", "shadow", "int"),
        ),
        pre_rules=RuleSet(
            ("num",), (ValidationRule("status", RuleKind.ENUM, enum=("POSTED", "SHADOW")),)
        ),
        post_rules=RuleSet(
            ("key",), (ValidationRule("ledger_day", RuleKind.MANDATORY),)
        ),
    )


def message(day, num, amount, status, seq=0):
    return json.dumps(
        {"head": {"day": day, "seq": seq}, "body": {"num": num, "amount": amount, "status": status}}
    )


FILES = [
    [
        message(1, "1", 10, "POSTED"),
        message(2, "1", 11, "POSTED"),
        "broken",
        message(1, "2", 20, "SHADOW"),
    ],
    [message(1, "1", 99, "POSTED"), message(3, "3", 30, "WRONG"), message(1, "9", 90, "SHADOW")],
    [
        message(4, "2", 21, "POSTED"),
        message(4, "8", 80, "POSTED"),
        message(4, "2", 22, "POSTED", 1),
    ],
]


def by_hand(files, newer_only=False):
    """The accounts after the files, each taken as one micro-batch."""
    table = {key: list(rest) for key, *rest in ACCOUNTS}
    for texts in files:
        latest = {}
        for text in texts:
            if not text.startswith("{"):
                continue
            parsed = json.loads(text)
            head, body = parsed["head"], parsed["body"]
            if body["status"] not in ("POSTED", "SHADOW"):
                continue
            stamp = (head["day"], head["seq"])
            if body["num"] not in latest or stamp > latest[body["num"]][0]:
                latest[body["num"]] = (stamp, body)
        for num, ((day, _), body) in latest.items():
            name, ledger, ledger_day, shadow = table.get(f"A^{num}", [None] * 4)
            if body["status"] == "SHADOW":
                shadow = body["amount"]
            elif not newer_only or ledger_day is None or day > ledger_day:
                ledger, ledger_day = body["amount"], day
            if ledger_day is not None:
                table[f"A^{num}"] = [name, ledger, ledger_day, shadow]
    return sorted((k, *v) for k, v in table.items())


def put_file(spark, folder, number, texts):
    rows = [(i % 2, 100 * number + i, bytearray(t.encode())) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, TOPIC).coalesce(1)
    frame.write.mode("append").parquet(f"{folder}/topic")


def make_job(spark, folder, newer_only=False, target=BucketTable, **options):
    start = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    table = target(f"{folder}/account", ("key",), start.schema)
    if not Path(f"{folder}/account").exists():
        table.create(start)
    return StreamJob(
        spec=spec(newer_only),
        topic="t",
        schema=MESSAGE,
        required="body",
        target=table,
        target_name="db.account",
        target_key={"key": "concat('A^', num)"},
        dead_letters=FolderSink(f"{folder}/dead"),
        rejects=FolderSink(f"{folder}/rejects"),
        batches=f"{folder}/batches",
        ledger=FolderSink(f"{folder}/ledger", balance=False),
        metrics=FolderSink(f"{folder}/metrics", balance=False),
        **options,
    )


def run(spark, folder, job, files_per_batch="1", checkpoint="checkpoint"):
    source = read_stream(
        spark, "parquet", {"maxFilesPerTrigger": files_per_batch}, TOPIC, f"{folder}/topic"
    )
    query = job.start(source, f"{folder}/{checkpoint}", availableNow=True)
    query.awaitTermination()


def accounts(spark, job):
    return sorted(tuple(r) for r in job.target.current(spark).collect())


def counters(spark, job):
    row = metrics_rollup(job.batch_metrics(spark), ["topic_name"]).first().asDict()
    return {k: v for k, v in row.items() if isinstance(v, int)}


@pytest.mark.parametrize("newer_only", [False, True])
def test_batches_and_restart(spark, folder, newer_only):
    job = make_job(spark, folder, newer_only)
    put_file(spark, folder, 0, FILES[0])
    run(spark, folder, job)
    assert accounts(spark, job) == by_hand(FILES[:1], newer_only)

    put_file(spark, folder, 1, FILES[1])
    run(spark, folder, job)
    assert accounts(spark, job) == by_hand(FILES[:2], newer_only)

    put_file(spark, folder, 2, FILES[2])
    run(spark, folder, job)
    run(spark, folder, job)  # nothing new
    assert accounts(spark, job) == by_hand(FILES, newer_only)

    ledger = job.offsets(spark)
    assert json.loads(read_starting_offsets(ledger, "t")) == {"t": {"0": 203, "1": 202}}
    metrics = job.batch_metrics(spark)
    assert sorted(r.batch_id for r in metrics.collect()) == [0, 1, 2]
    assert counters(spark, job) == {
        "total": 10,
        "validation": 1,
        "transformation": 6,
        "exception": 1,
        "dlq": 1,
        "target_write": 5,
    }
    letters = job.dead_letters.read(spark, LETTER).collect()
    assert [(r.key, r.offset, bytes(r.value)) for r in letters] == [("0", 2, b"broken")]
    rejects = {r.key: json.loads(r.value) for r in job.rejects.read(spark, MESSAGE_OUT).collect()}
    assert rejects["pre_transform"]["num"] == "3"
    assert rejects["post_transform"]["key"] == "A^9"
    window = metrics_rollup(metrics, ["topic_name"]).first()
    assert window.metrics_window_start_time < window.metrics_window_end_time


def test_guard_decides_whether_a_late_message_wins():
    assert by_hand(FILES)[1][2] == 99
    assert by_hand(FILES, newer_only=True)[1][2] == 11


def test_one_batch_equals_the_batch_run(spark, folder):
    job = make_job(spark, folder)
    for number, texts in enumerate(FILES):
        put_file(spark, folder, number, texts)
    run(spark, folder, job, files_per_batch="1000")
    rows = spark.read.parquet(f"{folder}/topic")
    valid, _ = split_decoded(decode(rows, MESSAGE), "body")
    account = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    batch = process_batch(valid, spec(), lambda session, name: account)
    written = {r.key: r for r in job.target.current(spark).collect()}
    accepted = batch.accepted.collect()
    assert accepted
    for row in accepted:
        stored = written[row.key]
        assert (row.ledger, row.ledger_day, row.shadow) == (
            stored.ledger,
            stored.ledger_day,
            stored.shadow,
        )
    whole = [[t for texts in FILES for t in texts]]
    assert accounts(spark, job) == by_hand(whole)


@dataclass(frozen=True)
class Failing(BucketTable):
    """Fails once, after it has changed."""

    def merge(self, updates, batch_id, run=0):
        super().merge(updates, batch_id, run)
        if batch_id == 1 and not FAILED:
            FAILED.append(batch_id)
            raise RuntimeError("lost")


FAILED: list[int] = []


def test_failure_after_the_write(spark, folder):
    FAILED.clear()
    job = make_job(spark, folder, target=Failing)
    put_file(spark, folder, 0, FILES[0])
    run(spark, folder, job)
    put_file(spark, folder, 1, FILES[1])
    with pytest.raises(StreamingQueryException):
        run(spark, folder, job)
    assert sorted(r.batch_id for r in job.batch_metrics(spark).collect()) == [0]
    put_file(spark, folder, 2, FILES[2])
    run(spark, folder, job)
    assert FAILED == [1]
    assert accounts(spark, job) == by_hand(FILES)
    assert counters(spark, job)["total"] == 10
    assert job.dead_letters.read(spark, LETTER).count() == 1


def test_replaying_a_batch_changes_nothing(spark, folder):
    job = make_job(spark, folder)
    put_file(spark, folder, 0, FILES[0])
    batch = spark.read.schema(TOPIC).parquet(f"{folder}/topic")
    job.run_batch(batch, 0)
    once = accounts(spark, job), counters(spark, job)
    job.run_batch(batch, 0)
    assert (accounts(spark, job), counters(spark, job)) == once


def test_a_batch_without_rows(spark, folder):
    job = make_job(spark, folder)
    job.run_batch(spark.createDataFrame([], TOPIC), 0)
    assert accounts(spark, job) == sorted(ACCOUNTS)
    assert set(counters(spark, job).values()) == {0}
    assert job.offsets(spark).count() == 0


def test_bad_date_pattern_is_found_at_start(spark, folder):
    job = make_job(spark, folder)
    rule = ValidationRule("day", RuleKind.DATE, date_format="YY/MM/DD")
    job = replace(job, spec=replace(job.spec, pre_rules=RuleSet(("num",), (rule,))))
    put_file(spark, folder, 0, FILES[0])
    with pytest.raises(ValueError, match="Date pattern not supported"):
        run(spark, folder, job)
    with pytest.raises(ValueError, match="Date pattern not supported"):
        process_batch(spark.createDataFrame([], f"data struct<{MESSAGE.replace(' struct', ':struct')}>"), job.spec)


def test_rejected_records_do_not_reach_the_transformation(spark):
    """The only message of an account fails a rule, and an older one takes its place."""
    texts = [message(1, "1", 10, "POSTED"), message(9, "1", 99, "WRONG")]
    rows = spark.createDataFrame(
        [(0, i, bytearray(t.encode())) for i, t in enumerate(texts)], TOPIC
    )
    valid, _ = split_decoded(decode(rows, MESSAGE), "body")
    account = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    result = process_batch(valid, spec(), lambda session, name: account)
    assert [tuple(r) for r in result.accepted.collect()] == [("A^1", 10, 1, -1)]
    assert result.rejected_before.count() == 1


def test_global_view_for_sql_written_that_way(spark):
    frame = spark.createDataFrame([(1,), (2,)], "a int")
    made = PipelineSpec(
        name="g",
        source=SourceQuery("SELECT a FROM global_temp.incoming"),
        mappings=(ColumnMapping(1, "a", "a", "bigint"),),
        batch_view="global_temp.incoming",
    )
    assert sorted(r.a for r in process_batch(frame, made).accepted.collect()) == [1, 2]


def test_reject_limit_stops_before_the_target(spark, folder):
    job = replace(make_job(spark, folder), summaries=FolderSink(f"{folder}/summaries"))
    put_file(spark, folder, 0, FILES[1])
    batch = spark.read.schema(TOPIC).parquet(f"{folder}/topic")
    # two of three records are rejected, one before and one after the transformation
    with pytest.raises(RejectLimitError, match="2 of 3 records rejected"):
        replace(job, reject_limit=0.5).run_batch(batch, 0)
    assert accounts(spark, job) == sorted(ACCOUNTS)
    assert job.rejects.read(spark, MESSAGE_OUT).count() == 2
    replace(job, reject_limit=0.7).run_batch(batch, 0)
    assert accounts(spark, job) == by_hand([FILES[1]])
    schema = "field_validated string, validated_type string, record_id_value string"
    summary = job.summaries.read(spark, schema).drop("batch_id", "run")
    assert {tuple(r) for r in summary.collect()} == {
        ("status", "pre_transform", "3"),
        ("ledger_day", "post_transform", "A^9"),
    }


def test_metrics_use_utc(spark, folder):
    job = make_job(spark, folder)
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    put_file(spark, folder, 0, FILES[0])
    job.run_batch(spark.read.schema(TOPIC).parquet(f"{folder}/topic"), 0)
    started = job.batch_metrics(spark).selectExpr(
        "cast(cast(metrics_window_start_time AS timestamp_ntz) AS string) AS t"
    ).first().t
    assert abs(dt.datetime.fromisoformat(started) - before) < dt.timedelta(minutes=2)


def test_runs_with_a_fresh_checkpoint_keep_each_others_work(spark, folder):
    """Batch numbers start again with each checkpoint; run numbers keep them apart."""
    first = make_job(spark, folder, run=0)
    put_file(spark, folder, 0, FILES[0])
    put_file(spark, folder, 1, FILES[1])
    run(spark, folder, first)
    second = make_job(spark, folder, run=1)
    put_file(spark, f"{folder}/later", 2, FILES[2])
    source = read_stream(spark, "parquet", {}, TOPIC, f"{folder}/later/topic")
    second.start(source, f"{folder}/checkpoint-1", availableNow=True).awaitTermination()
    assert accounts(spark, second) == by_hand(FILES)
    assert second.dead_letters.read(spark, LETTER).count() == 1
    assert counters(spark, second)["total"] == 10
    assert sorted((r.run, r.batch_id) for r in second.batch_metrics(spark).collect()) == [(0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError, match="belongs to checkpoint"):
        run(spark, folder, make_job(spark, folder, run=1), checkpoint="another")


def test_replay_under_dynamic_overwriting(spark, folder):
    job = make_job(spark, folder)
    put_file(spark, folder, 0, FILES[0])
    batch = spark.read.schema(TOPIC).parquet(f"{folder}/topic")
    # what a failed attempt has left: letters, and a part of the buckets without the mark that ends a write
    job.dead_letters.write(spark.createDataFrame([("9", 9, b"left")], LETTER), 0)
    left = place_of(job.target.staged_path, 0, 0)
    spark.createDataFrame([("A^5", "x", 1, 1, 1, 3)], f"{ACCOUNT}, key_bucket int").write.partitionBy("key_bucket").parquet(left)
    Path(f"{left}/_SUCCESS").unlink()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        job.run_batch(batch, 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert accounts(spark, job) == by_hand(FILES[:1])
    assert [r.value for r in job.dead_letters.read(spark, LETTER).collect()] == [b"broken"]


def test_a_bad_amount_goes_to_the_dead_letters(spark, folder):
    job = make_job(spark, folder)
    bad = [
        message(5, "1", "n/a", "POSTED"),
        message(5, "2", 10**12, "POSTED"),
        message(5, "3", 7, "POSTED") + " tail",
        json.dumps({"head": {"day": 5, "seq": 0}, "body": {}}),
        json.dumps({"head": "5", "body": {"num": "4", "amount": 1, "status": "POSTED"}}),
    ]
    put_file(spark, folder, 0, [*bad, message(5, "5", 50, "POSTED")])
    run(spark, folder, job)
    assert accounts(spark, job) == by_hand([[message(5, "5", 50, "POSTED")]])
    assert job.dead_letters.read(spark, LETTER).count() == len(bad)
    assert counters(spark, job)["dlq"] == len(bad)


def test_both_statuses_of_an_account_in_one_batch(spark, folder):
    """One operator keeps the latest message of either status."""
    both = Latest(("num",), ("day", "seq"), "status", ("POSTED", "SHADOW"), ("amount", "day"))
    demo = spec()
    steps = tuple(
        replace(s, query="flat", kind=StepKind.LATEST, latest=both) if s.view == "latest" else s for s in demo.steps
    )
    source = SourceQuery(
        "SELECT concat('A^', num) AS k, coalesce(posted_amount, ledger) AS l, coalesce(posted_day, ledger_day) AS d, "
        "coalesce(shadow_amount, shadow) AS s FROM latest LEFT JOIN account ON concat('A^', num) = key"
    )
    job = replace(make_job(spark, folder), spec=replace(demo, steps=steps, source=source))
    put_file(spark, folder, 0, [message(1, "1", 10, "POSTED"), message(2, "1", 20, "SHADOW")])
    run(spark, folder, job)
    assert ("A^1", "name1", 10, 1, 20) in accounts(spark, job)


def test_a_batch_takes_few_jobs(spark, folder):
    job = make_job(spark, folder, summaries=FolderSink(f"{folder}/summaries"), stats=FolderSink(f"{folder}/stats", balance=False))
    put_file(spark, folder, 0, FILES[1] + ["broken"])
    batch = spark.read.schema(TOPIC).parquet(f"{folder}/topic")
    spark.sparkContext.setJobGroup("one batch", "counted")
    try:
        job.run_batch(batch, 0)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one batch")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 0 < len(jobs) <= 25
    assert counters(spark, job)["exception"] == counters(spark, job)["validation"] == counters(spark, job)["dlq"] == 1
    assert not list(Path(f"{folder}/batches").rglob("*.parquet"))


def test_a_batch_of_one_large_piece_is_dealt_out_and_decoded_once(spark, folder, monkeypatch):
    rows = spark.range(20000).selectExpr(
        "int(id % 2) AS partition",
        "id AS offset",
        "binary(concat('{\"head\":{\"day\":1,\"seq\":', id, '},\"body\":{\"num\":\"', sha2(string(id), 512), "
        "'\",\"amount\":1,\"status\":\"WRONG\"}}')) AS value",
    )
    rows.coalesce(1).write.parquet(f"{folder}/topic")
    pieces = []

    def watched(df, *given):
        pieces.append(df.rdd.getNumPartitions())
        return decode(df, *given)

    monkeypatch.setattr("rulestream.streaming.runner.decode", watched)
    job = make_job(spark, folder)
    job.run_batch(spark.read.schema(TOPIC).parquet(f"{folder}/topic").coalesce(1), 0)
    assert len(pieces) == 1 and pieces[0] > 1
    assert (counters(spark, job)["total"], counters(spark, job)["validation"]) == (20000, 20000)
    assert sorted(r.topic_offset for r in job.offsets(spark).collect()) == [19999, 20000]


def test_what_follows_reads_the_partition_of_its_outcome(spark, folder):
    job = make_job(spark, folder)
    put_file(spark, folder, 0, FILES[1] + ["broken"])
    decoded = decode(spark.read.schema(TOPIC).parquet(f"{folder}/topic"), MESSAGE)
    read, counts = job.write_read(decoded, 0)
    assert counts == {"total": 4, "dlq": 1, "validation": 1, "checked": 3}
    for outcome, rows in ((PASSED, 2), (REJECTED, 1)):
        frame = read.of(spark, outcome)
        assert frame.count() == rows
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        assert f"= {outcome})" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
        # records without undecodable rows, and the other way round
        assert "letter" not in scan.split("ReadSchema")[1]


def test_offsets_lost_between_batches_are_found(spark, folder):
    job = make_job(spark, folder)
    for number, texts in enumerate(FILES):
        put_file(spark, folder, number, texts)
    run(spark, folder, job)
    ranges = job.ledger.read(spark, LEDGER_SCHEMA)
    assert json.loads(read_starting_offsets(job.offsets(spark), "t")) == {"t": {"0": 203, "1": 202}}
    # the files of this test leave offsets out: a partition has those from 100 x the number of a file
    gaps = {(r.topic_partition, r.first_missing, r.last_missing) for r in offset_gaps(ranges).collect()}
    assert gaps == {("0", 3, 99), ("0", 103, 199), ("1", 4, 100), ("1", 102, 200)}
    assert offset_overlaps(ranges).count() == 0


def test_a_view_that_several_steps_read_goes_with_the_batch(spark, folder):
    demo = spec()
    steps = (
        *(replace(s, view="flat_twice") if s.view == "latest" else s for s in demo.steps),
        SqlStep(4, "SELECT * FROM flat_twice WHERE status = 'POSTED'", "some"),
        SqlStep(5, "SELECT * FROM some UNION ALL SELECT * FROM flat_twice WHERE status <> 'POSTED'", "latest"),
    )
    job = replace(make_job(spark, folder), spec=replace(demo, steps=steps))
    put_file(spark, folder, 0, FILES[0])
    run(spark, folder, job)
    assert accounts(spark, job) == by_hand(FILES[:1])
    assert not list(Path(f"{folder}/batches/views").rglob("*.parquet"))


@pytest.mark.parametrize("late_first", [False, True])
def test_a_stretch_of_time_is_one_batch_of_many_files(spark, folder, monkeypatch, late_first):
    kinds = "element_at(array('click', 'purchase', 'view'), int(id % 3) + 1)"
    events = spark.range(1200).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + id * interval '1' minute AS ts",
        "id % 7 AS user_id",
        f"{kinds} AS event_type",
        "double(id) AS value",
        "'{}' AS props",
    )
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    customers = spark.range(7).selectExpr("id AS c_custkey", "string(id) AS c_name", "int(id) AS c_nationkey", "0D AS c_acctbal")
    customers.write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(streams, "run_folder", lambda spark, name: f"{folder}/{name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64b")
    try:
        job = streams.run_parts(spark, folder, 4, late_first)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    batches = {r.batch_id: r.total for r in job.batch_metrics(spark).collect()}
    assert set(batches) == {0, 1, 2, 3} and all(299 <= n <= 301 for n in batches.values()) and sum(batches.values()) == 1200
    assert len(list(Path(folder, "stream-parts", "events").glob("*.parquet"))) > 4
    firsts = [r.first_offset for r in job.ledger.read(spark, LEDGER_SCHEMA).where("topic_partition = 0").sort("batch_id").collect()]
    assert firsts == ([225, 150, 75, 0] if late_first else [0, 75, 150, 225])


def test_stats_rows_of_batches_that_read_something(spark, folder):
    job = make_job(spark, folder, stats=FolderSink(f"{folder}/stats"), labels={"workflow": "w"})
    put_file(spark, folder, 0, FILES[0])
    run(spark, folder, job)
    job.run_batch(spark.createDataFrame([], TOPIC), 1)
    rows = job.stats.read(spark, "workflow string, topic_name string, json_data string").collect()
    assert [(r.workflow, r.topic_name, json.loads(r.json_data)["topic_count"]) for r in rows] == [("w", "t", 4)]


def test_a_topic_is_read_from_where_the_ledger_says(spark, folder, monkeypatch):
    asked = []
    frame = spark.createDataFrame([], TOPIC)
    monkeypatch.setattr("rulestream.streaming.runner.read_topic", lambda *given: asked.append(given[1:]) or frame)
    job = make_job(spark, folder)
    job.topic_source(spark, "host:1")
    put_file(spark, folder, 0, FILES[0])
    job.run_batch(spark.read.schema(TOPIC).parquet(f"{folder}/topic"), 0)
    source = job.topic_source(spark, "host:1", {"minPartitions": "8"})
    assert source.columns == ["partition", "offset", "value"]
    assert asked[0] == ("host:1", "t", "earliest", None)
    assert asked[1][:2] == ("host:1", "t") and asked[1][3] == {"minPartitions": "8"}
    assert json.loads(asked[1][2]) == {"t": {"0": 3, "1": 4}}
