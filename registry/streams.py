"""The whole run, as a batch and as a stream over the event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.codecs import DECODED_SQL, TEXT_SQL
from registry.data import ACCOUNTS_SQL, MESSAGE_SCHEMA, accounts, table, topic_rows, topic_rows_of
from registry.tables import ACCOUNT_COLUMNS
from rulestream.functions.codec import decode, split_decoded
from rulestream.operators.audit import COUNTERS, metrics_rollup
from rulestream.operators.merge import Versioned
from rulestream.operators.validate import drop_meta
from rulestream.plans.pipeline import BatchResult, process_batch
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
from rulestream.sources.shared import run_folder
from rulestream.sources.sinks import FolderSink
from rulestream.streaming.runner import StreamJob

ACCOUNT_KEY = "concat('ACCT^', acc_num, '^', nsc)"

# The latest message of either status moves its side of an account; the other side stays. Rules fail for views, whose
# status is not allowed, for every message after the twelfth of a month, whose day is no month, and
# for accounts of a nation that is not served.

SERVED = 20
SPEC = PipelineSpec(
    name="balances",
    steps=(
        SqlStep(
            10,
            "SELECT data.body.branch.nsc, data.body.account.acc_num, data.header.seq_num, "
            "cast(data.header.seq_num AS bigint) AS place, "
            "cast(data.header.sent_at AS timestamp_ntz) AS sent_at, "
            "date_format(cast(data.header.sent_at AS timestamp_ntz), 'dd/MM/yyyy') AS sent_day, "
            "data.body.account.balance, data.body.account.balance_status AS side "
            "FROM stream_df WHERE data.header.origin = 'APP'",
            "app_messages",
            stage=Stage.NORMALISE,
        ),
        SqlStep(
            20,
            "app_messages",
            "both_sides",
            StepKind.LATEST,
            latest=Latest(
                keys=("acc_num", "nsc"),
                order=("sent_at", "place"),
                status="side",
                statuses=("POSTED", "SHADOW"),
                values=("balance", "seq_num", "sent_at"),
            ),
        ),
        SqlStep(30, "bank.account", "account", StepKind.TABLE),
    ),
    source=SourceQuery(
        f"SELECT m.*, a.* FROM (SELECT *, {ACCOUNT_KEY} AS own_key FROM both_sides) m "
        "LEFT JOIN account a ON own_key = account_key"
    ),
    mappings=(
        ColumnMapping(1, "own_key", "account_key", "string"),
        *(
            ColumnMapping(place, "", f"{side}_{old}", kind, f"coalesce({status}_{new}, {side}_{old})")
            for place, (side, status, old, new, kind) in enumerate(
                (
                    (side, status, *column)
                    for column in (
                        ("at", "sent_at", "timestamp_ntz"),
                        ("seq", "seq_num", "string"),
                        ("amt", "balance", "decimal(23,4)"),
                    )
                    for side, status in (("shadow", "shadow"), ("ledger", "posted"))
                ),
                start=2,
            )
        ),
        ColumnMapping(8, "nation", "nation", "int"),
    ),
    pre_rules=RuleSet(
        ("nsc", "acc_num", "seq_num"),
        (
            ValidationRule("sent_day", RuleKind.DATE, date_format="MM/dd/yyyy"),
            ValidationRule("side", RuleKind.ENUM, enum=("SHADOW", "POSTED")),
        ),
    ),
    post_rules=RuleSet(("account_key",), (ValidationRule("nation", RuleKind.ENUM, enum=tuple(map(str, range(SERVED)))),)),
)

# A side of an account changes only by a later message than the one it has; the first load has none.
SIDES = tuple(
    Versioned(
        (f"{side}_amt", f"{side}_seq", f"{side}_at"),
        f"CASE WHEN try_cast({side}_seq AS bigint) IS NOT NULL THEN struct({side}_at, cast({side}_seq AS bigint)) END",
    )
    for side in ("ledger", "shadow")
)


# The same in SQL. Errors do not decode and signups are of another origin.
RUN_SQL = f"""{DECODED_SQL}, {ACCOUNTS_SQL},
parsed AS (
  SELECT *, CAST(sent_at AS TIMESTAMP) AS sent,
         balance_status IN ('POSTED', 'SHADOW') AS side_ok,
         try_strptime(strftime(CAST(sent_at AS TIMESTAMP), '%d/%m/%Y'), '%m/%d/%Y') IS NOT NULL AS day_ok
  FROM decoded WHERE event_type <> 'error' AND origin = 'APP'),
messages AS (SELECT * FROM parsed WHERE side_ok AND day_ok),
sides AS (
  SELECT 'ACCT^' || acc_num || '^' || nsc AS own_key,
         max_by(balance, (sent, event_id)) FILTER (balance_status = 'POSTED') AS p_balance,
         max_by(seq_num, (sent, event_id)) FILTER (balance_status = 'POSTED') AS p_seq,
         max_by(sent, (sent, event_id)) FILTER (balance_status = 'POSTED') AS p_sent,
         max_by(balance, (sent, event_id)) FILTER (balance_status = 'SHADOW') AS s_balance,
         max_by(seq_num, (sent, event_id)) FILTER (balance_status = 'SHADOW') AS s_seq,
         max_by(sent, (sent, event_id)) FILTER (balance_status = 'SHADOW') AS s_sent
  FROM messages GROUP BY acc_num, nsc),
mapped AS (
  SELECT own_key AS account_key,
         CAST(coalesce(p_balance, ledger_amt) AS DECIMAL(23,4)) AS ledger_amt,
         coalesce(p_seq, ledger_seq) AS ledger_seq, coalesce(p_sent, ledger_at) AS ledger_at,
         CAST(coalesce(s_balance, shadow_amt) AS DECIMAL(23,4)) AS shadow_amt,
         coalesce(s_seq, shadow_seq) AS shadow_seq, coalesce(s_sent, shadow_at) AS shadow_at, nation
  FROM sides LEFT JOIN accounts ON own_key = accounts.account_key),
checked AS (SELECT *, coalesce(nation BETWEEN 0 AND {SERVED - 1}, false) AS ok FROM mapped)"""

RESULT_SQL = f"""WITH {RUN_SQL},
done AS (SELECT c.account_key, account_name, c.nation, c.ledger_amt, c.ledger_seq, c.ledger_at,
                c.shadow_amt, c.shadow_seq, c.shadow_at
         FROM checked c LEFT JOIN accounts a ON c.account_key = a.account_key WHERE ok)
SELECT {ACCOUNT_COLUMNS} FROM accounts
WHERE account_key NOT IN (SELECT account_key FROM done)
UNION ALL SELECT {ACCOUNT_COLUMNS} FROM done"""


def _batch(spark: SparkSession, sf: str) -> BatchResult:
    valid, _ = split_decoded(decode(topic_rows(spark, sf), MESSAGE_SCHEMA), "body")
    return process_batch(valid, SPEC, lambda session, name: accounts(session, sf))


MAPPED = "account_key, ledger_amt, ledger_seq, ledger_at, shadow_amt, shadow_seq, shadow_at, nation"


@query(f"WITH {RUN_SQL} SELECT {MAPPED} FROM checked WHERE ok")
def batch_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return _batch(spark, sf).accepted


@query(f"WITH {RUN_SQL} SELECT {MAPPED} FROM checked")
def balance_update_both(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of an account that has messages of both statuses in one batch."""
    return drop_meta(_batch(spark, sf).transformed)


@query(f"WITH {RUN_SQL} SELECT {MAPPED} FROM checked WHERE NOT ok")
def batch_rejected_after(spark: SparkSession, sf: str) -> DataFrame:
    return drop_meta(_batch(spark, sf).rejected_after)


@query(
    f"""WITH {RUN_SQL}
SELECT nsc, acc_num, seq_num, event_id AS place, sent AS sent_at,
       strftime(sent, '%d/%m/%Y') AS sent_day, balance, balance_status AS side
FROM parsed WHERE NOT (side_ok AND day_ok)"""
)
def batch_rejected_before(spark: SparkSession, sf: str) -> DataFrame:
    return drop_meta(_batch(spark, sf).rejected_before)


def stream_job(spark: SparkSession, sf: str, folder: str, run: int = 0) -> StreamJob:
    """A stream into the accounts, with all its outputs below a folder."""
    return StreamJob(
        spec=SPEC,
        topic="events",
        schema=MESSAGE_SCHEMA,
        required="body",
        target=BucketTable(f"{folder}/accounts", ("account_key",), accounts(spark, sf).schema, versioned=SIDES),
        target_name="bank.account",
        target_key={"account_key": ACCOUNT_KEY},
        batches=f"{folder}/batches",
        dead_letters=FolderSink(f"{folder}/dead_letters"),
        rejects=FolderSink(f"{folder}/rejects"),
        ledger=FolderSink(f"{folder}/ledger", balance=False),
        metrics=FolderSink(f"{folder}/metrics", balance=False),
        summaries=FolderSink(f"{folder}/summaries", partitions=("validation_yr_month",)),
        stats=FolderSink(f"{folder}/stats", balance=False),
        labels={"workflow": "accounts", "task": "balances"},
        run=run,
    )


def run_stream(spark: SparkSession, sf: str, parts: tuple[str, ...] = ("true",)) -> StreamJob:
    """Process all events as a stream, and return the finished job.

    Each of the ``parts`` is a filter over the events and a run with a checkpoint of its own.
    """
    folder = run_folder(spark, "stream")
    stream_job(spark, sf, folder).target.create(accounts(spark, sf))
    for run, part in enumerate(parts):
        events = read_stream(
            spark,
            "parquet",
            {"pathGlobFilter": "events.parquet"},
            schema=table(spark, sf, "events").schema,
            path=sf,
        )
        job = stream_job(spark, sf, folder, run)
        source = topic_rows_of(events.filter(part))
        job.start(source, f"{folder}/checkpoint-{run}", availableNow=True).awaitTermination()
    return job


def run_parts(spark: SparkSession, sf: str, parts: int, late_first: bool) -> StreamJob:
    """All events in one run, as so many micro-batches of a stretch of time each: forward, or the last one first.

    A stretch arrives as any number of files; the query goes on from its checkpoint and takes what is new as one batch.
    """
    folder = run_folder(spark, "stream-parts")
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    step = (high - low) / parts
    job = stream_job(spark, sf, folder)
    job.target.create(accounts(spark, sf))
    for number in reversed(range(parts)) if late_first else range(parts):
        inside = (F.col("ts") >= low + step * number) & (F.col("ts") < low + step * (number + 1))
        if number == parts - 1:
            inside = F.col("ts") >= low + step * number
        events.where(inside).hint("rebalance", "event_id").write.mode("append").parquet(f"{folder}/events")
        source = read_stream(spark, "parquet", schema=events.schema, path=f"{folder}/events")
        job.start(topic_rows_of(source), f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return job


@query(RESULT_SQL)
def stream_balance_update(spark: SparkSession, sf: str) -> DataFrame:
    return run_stream(spark, sf).target.current(spark)


@query(RESULT_SQL)
def stream_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The same by two runs with a fresh checkpoint each, whose batches have the same numbers."""
    return run_stream(spark, sf, ("user_id % 2 = 0", "user_id % 2 = 1")).target.current(spark)


@query(RESULT_SQL)
def stream_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same by several micro-batches in the order of time."""
    return run_parts(spark, sf, 4, late_first=False).target.current(spark)


@query(RESULT_SQL)
def stream_late_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The same by several micro-batches of which the last stretch of time comes first."""
    return run_parts(spark, sf, 4, late_first=True).target.current(spark)


@query(
    f"""WITH {DECODED_SQL}
SELECT 'accounts' AS workflow, 'balances' AS task, 'events' AS topic_name,
       (SELECT count(*) FROM events) AS topic_count,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS dlq"""
)
def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    """One row per batch that read something."""
    columns = "workflow string, task string, topic_name string, json_data string"
    rows = run_stream(spark, sf).stats.read(spark, columns)
    return rows.select(
        "workflow",
        "task",
        "topic_name",
        F.get_json_object("json_data", "$.topic_count").cast("bigint").alias("topic_count"),
        F.get_json_object("json_data", "$.metrics_stages['04_dlq']").cast("bigint").alias("dlq"),
    )


@query(
    f"""WITH {DECODED_SQL}, texts AS (SELECT *, {TEXT_SQL} AS text FROM decoded)
SELECT CAST("partition" AS VARCHAR) AS key, "offset", left(text, length(text) - 2) AS value
FROM texts WHERE event_type = 'error'"""
)
def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_stream(spark, sf).dead_letters.read(spark, "key string, offset bigint, value binary")
    return rows.select("key", "offset", F.col("value").cast("string").alias("value"))


ISO = "%Y-%m-%dT%H:%M:%S.%f"


@query(
    f"""WITH {RUN_SQL}
SELECT 'pre_transform' AS key,
       '{{"nsc":"' || nsc || '","acc_num":"' || acc_num || '","seq_num":"' || seq_num
       || '","place":' || event_id || ',"sent_at":"' || strftime(sent, '{ISO}')
       || '","sent_day":"' || strftime(sent, '%d/%m/%Y') || '","balance":' || balance
       || ',"side":"' || balance_status || '"}}' AS value
FROM parsed WHERE NOT (side_ok AND day_ok)
UNION ALL
SELECT 'post_transform',
       '{{"account_key":"' || account_key || '","shadow_at":"' || strftime(shadow_at, '{ISO}')
       || '","ledger_at":"' || strftime(ledger_at, '{ISO}') || '","shadow_seq":"' || shadow_seq
       || '","ledger_seq":"' || ledger_seq || '","shadow_amt":' || shadow_amt
       || ',"ledger_amt":' || ledger_amt || ',"nation":' || nation || '}}'
FROM checked WHERE NOT ok"""
)
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = run_stream(spark, sf).rejects
    return rejects.read(spark, "key string, value string").select("key", "value")


@query(
    f"""WITH {RUN_SQL}, failed AS (SELECT *, nsc || ',' || acc_num || ',' || seq_num AS id FROM parsed)
SELECT 'balances' AS pipeline_name, 'side' AS field_validated,
       'nsc,acc_num,seq_num' AS record_id_key, id AS record_id_value,
       balance_status AS validated_data, 'pre_transform' AS validated_type,
       'is_enum' AS validated_name,
       'side = ' || balance_status || ': not among the values allowed' AS failure_reason
FROM failed WHERE NOT side_ok
UNION ALL
SELECT 'balances', 'sent_day', 'nsc,acc_num,seq_num', id, strftime(sent, '%d/%m/%Y'), 'pre_transform',
       'is_valid_date', 'sent_day = ' || strftime(sent, '%d/%m/%Y') || ': not a date of the pattern given'
FROM failed WHERE NOT day_ok
UNION ALL
SELECT 'balances', 'nation', 'account_key', account_key, CAST(nation AS VARCHAR), 'post_transform',
       'is_enum', 'nation = ' || nation || ': not among the values allowed'
FROM checked WHERE NOT ok"""
)
def stream_reject_summary(spark: SparkSession, sf: str) -> DataFrame:
    columns = (
        "pipeline_name",
        "field_validated",
        "record_id_key",
        "record_id_value",
        "validated_data",
        "validated_type",
        "validated_name",
        "failure_reason",
    )
    schema = ", ".join(f"{c} string" for c in columns)
    return run_stream(spark, sf).summaries.read(spark, schema).select(*columns)


@query(
    """SELECT 'events' AS topic_name, CAST(event_id % 4 AS VARCHAR) AS topic_partition,
       max(event_id // 4) + 1 AS topic_offset FROM events GROUP BY 2"""
)
def stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return run_stream(spark, sf).offsets(spark)


@query(
    f"""WITH {RUN_SQL}
SELECT 'events' AS topic_name, (SELECT count(*) FROM events) AS total,
       (SELECT count(*) FROM parsed WHERE NOT (side_ok AND day_ok)) AS validation,
       (SELECT count(*) FROM mapped) AS transformation,
       (SELECT count(*) FROM checked WHERE NOT ok) AS exception,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS dlq,
       (SELECT count(*) FROM checked WHERE ok) AS target_write"""
)
def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    totals = metrics_rollup(run_stream(spark, sf).batch_metrics(spark), ["topic_name"])
    return totals.select("topic_name", *COUNTERS)
