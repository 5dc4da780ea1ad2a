"""Decoding, splitting and encoding of messages, and the offset and metrics records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.data import MESSAGE_SCHEMA, TOPIC_STATUS_SQL, table, topic_rows
from rulestream.functions.codec import as_json, decode, encode, split_decoded
from rulestream.operators.audit import (
    latest_offsets,
    ledger_changes,
    ledger_of_topic,
    ledger_rows,
    merge_ledger,
    metrics_payload,
    metrics_rollup,
    offset_ranges,
    starting_offsets,
    stats_rows,
)
from rulestream.operators.audit import offset_gaps as gaps_of
from rulestream.operators.audit import offset_overlaps as overlaps_of
from rulestream.operators.transform import flatten
from rulestream.sources.sinks import dead_letters

FIELDS = {
    "sent_at": "data.header.sent_at",
    "seq_num": "data.header.seq_num",
    "origin": "data.header.origin",
    "acc_num": "data.body.account.acc_num",
    "balance": "data.body.account.balance",
    "balance_status": "data.body.account.balance_status",
    "nsc": "data.body.branch.nsc",
}

DECODED_SQL = f"""
decoded AS (
  SELECT event_id, event_type, CAST(event_id % 4 AS INTEGER) AS "partition",
         event_id // 4 AS "offset",
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS sent_at,
         CAST(event_id AS VARCHAR) AS seq_num,
         CASE WHEN event_type = 'signup' THEN 'WEB' ELSE 'APP' END AS origin,
         CAST(user_id AS VARCHAR) AS acc_num, CAST(value AS DECIMAL(32,6)) AS balance,
         {TOPIC_STATUS_SQL} AS balance_status, CAST(user_id % 10 AS VARCHAR) AS nsc
  FROM events)"""


@query(
    f"""WITH {DECODED_SQL}
SELECT sent_at, seq_num, origin, acc_num, balance, balance_status, nsc
FROM decoded WHERE event_type <> 'error' AND origin = 'APP'"""
)
def normalise_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Decode the payload, flatten its fields and keep one origin."""
    decoded = decode(topic_rows(spark, sf), MESSAGE_SCHEMA)
    return flatten(decoded, FIELDS, where=F.col("data.header.origin") == "APP")


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events"""
)
def normalise_json_text(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON text column decoded by a schema of its own."""
    events = table(spark, sf, "events")
    decoded = events.select("event_id", F.from_json("props", "k int").alias("data"))
    return flatten(decoded, {"event_id": "event_id", "k": "data.k"})


@query(
    f"""WITH {DECODED_SQL}
SELECT "partition", "offset", acc_num, balance FROM decoded WHERE event_type <> 'error'"""
)
def split_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = split_decoded(decode(topic_rows(spark, sf), MESSAGE_SCHEMA), "body")
    account = F.col("data.body.account")
    return valid.select(
        "partition",
        "offset",
        account["acc_num"].alias("acc_num"),
        account["balance"].alias("balance"),
    )


TEXT_SQL = """'{"header":{"sent_at":"' || sent_at || '","seq_num":"' || seq_num
       || '","origin":"' || origin || '"},"body":{"account":{"acc_num":"' || acc_num
       || '","balance":' || balance || ',"balance_status":"' || balance_status
       || '"},"branch":{"nsc":"' || nsc || '"}}}'"""


@query(
    f"""WITH {DECODED_SQL}, texts AS (SELECT *, {TEXT_SQL} AS text FROM decoded)
SELECT "partition", "offset", left(text, length(text) - 2) AS text
FROM texts WHERE event_type = 'error'"""
)
def split_invalid(spark: SparkSession, sf: str) -> DataFrame:
    _, invalid = split_decoded(decode(topic_rows(spark, sf), MESSAGE_SCHEMA), "body")
    return invalid.select("partition", "offset", F.col("value").cast("string").alias("text"))


@query(
    f"""WITH {DECODED_SQL}, texts AS (SELECT *, {TEXT_SQL} AS text FROM decoded)
SELECT CAST("partition" AS VARCHAR) AS key, "offset", left(text, length(text) - 2) AS value
FROM texts WHERE event_type = 'error'"""
)
def dead_letter_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, invalid = split_decoded(decode(topic_rows(spark, sf), MESSAGE_SCHEMA), "body")
    return dead_letters(invalid).withColumn("value", F.col("value").cast("string"))


# Messages with one fault each, by number: a wrong type, an overflow, an empty body, text after the
# record, a body that is no record, and none.


@query(
    """SELECT event_id, event_id % 6 = 5 AS valid FROM events"""
)
def split_bad_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Decodable and undecodable messages, faults within fields included."""
    number = F.col("event_id") % 6
    amount = (
        F.when(number == 0, '"n/a"').when(number == 1, "1234567.5").otherwise(F.format_string("%.2f", F.pmod("value", F.lit(1000))))
    )
    body = (
        F.when(number == 2, "{}").when(number == 4, '"none"').otherwise(F.concat(F.lit('{"amount":'), amount, F.lit("}")))
    )
    text = F.concat(F.lit('{"head":{"id":'), "event_id", F.lit('},"body":'), body, F.lit("}"))
    rows = table(spark, sf, "events").select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(number == 3, F.concat(text, F.lit(" tail"))).otherwise(text).cast("binary").alias("value"),
    )
    parts = split_decoded(decode(rows, "head struct<id:bigint>, body struct<amount:decimal(6,2)>"), "body")
    told = [part.select(F.col("offset").alias("event_id"), F.lit(whole).alias("valid")) for part, whole in zip(parts, (True, False))]
    return told[0].unionByName(told[1])


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS key,
       '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS value
FROM customer"""
)
def encode_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    return encode(customers, F.col("c_nationkey"), ["c_custkey", "c_name"])


@query(
    """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"status":'
       || coalesce('"' || nullif(event_type, 'error') || '"', 'null') || '}' AS value
FROM events"""
)
def reject_json(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as JSON with their null fields kept."""
    status = F.nullif("event_type", F.lit("error")).alias("status")
    return as_json(table(spark, sf, "events").select("event_id", "user_id", status))


# Offsets. The ledger knows three of four partitions, one of them too far ahead.

LEDGER_SQL = """
latest AS (SELECT event_id % 4 AS p, max(event_id // 4) AS o FROM events GROUP BY 1),
fresh AS (SELECT 'events' AS topic_name, CAST(p AS VARCHAR) AS topic_partition,
                 o + 1 AS topic_offset FROM latest),
ledger AS (
  SELECT topic_name, topic_partition,
         CASE topic_partition WHEN '0' THEN 1 WHEN '1' THEN topic_offset
              ELSE topic_offset + 5 END AS topic_offset
  FROM fresh WHERE topic_partition <> '3'
  UNION ALL SELECT 'other', topic_partition, topic_offset FROM fresh)"""


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("event_id")
    return table(spark, sf, "events").select(
        (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).cast("bigint").alias("offset"),
    )


def _fresh_and_ledger(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    fresh = ledger_rows(latest_offsets(_positions(spark, sf)), "events")
    stored = (
        F.when(F.col("topic_partition") == "0", F.lit(1).cast("bigint"))
        .when(F.col("topic_partition") == "1", F.col("topic_offset"))
        .otherwise(F.col("topic_offset") + 5)
    )
    known = fresh.filter("topic_partition <> '3'").withColumn("topic_offset", stored)
    other = fresh.withColumn("topic_name", F.lit("other"))
    return fresh, known.unionByName(other)


@query(
    """SELECT CAST(event_id % 4 AS INTEGER) AS "partition", max(event_id // 4) AS "offset"
FROM events GROUP BY 1"""
)
def offsets_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_offsets(_positions(spark, sf))


@query(
    f"""WITH {LEDGER_SQL}
SELECT f.* FROM fresh f LEFT JOIN ledger l
ON f.topic_name = l.topic_name AND f.topic_partition = l.topic_partition
WHERE l.topic_offset IS NULL OR f.topic_offset > l.topic_offset"""
)
def ledger_changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    fresh, ledger = _fresh_and_ledger(spark, sf)
    return ledger_changes(ledger, fresh)


@query(
    f"""WITH {LEDGER_SQL}
SELECT coalesce(l.topic_name, f.topic_name) AS topic_name,
       coalesce(l.topic_partition, f.topic_partition) AS topic_partition,
       greatest(coalesce(l.topic_offset, f.topic_offset),
                coalesce(f.topic_offset, l.topic_offset)) AS topic_offset
FROM ledger l FULL OUTER JOIN fresh f
ON f.topic_name = l.topic_name AND f.topic_partition = l.topic_partition"""
)
def ledger_merge(spark: SparkSession, sf: str) -> DataFrame:
    fresh, ledger = _fresh_and_ledger(spark, sf)
    return merge_ledger(ledger, fresh)


# The events as batches of a hundred, of which one in seven is lost, and of one in seven the later part is read again.

RANGES_SQL = """
consumed AS (
  SELECT CAST(event_id % 4 AS VARCHAR) AS topic_partition, event_id // 4 AS place, event_id // 100 AS batch_id, 0 AS run
  FROM events WHERE event_id // 100 % 7 <> 3
  UNION ALL
  SELECT CAST(event_id % 4 AS VARCHAR), event_id // 4, event_id // 100, 1
  FROM events WHERE event_id // 100 % 7 = 5 AND event_id % 100 >= 40)"""


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The range of offsets that each batch has read of each partition."""
    batch = F.floor(F.col("event_id") / 100)
    events = table(spark, sf, "events").select(
        (F.col("event_id") % 4).alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        batch.alias("batch_id"),
        (F.col("event_id") % 100).alias("place"),
    )
    runs = events.where("batch_id % 7 <> 3").withColumn("run", F.lit(0))
    again = events.where("batch_id % 7 = 5 AND place >= 40").withColumn("run", F.lit(1))
    return offset_ranges(runs.unionByName(again), "events", "run", "batch_id")


@query(
    f"""WITH {RANGES_SQL},
missing AS (
  SELECT e.topic_partition, e.place, e.place - row_number() OVER (PARTITION BY e.topic_partition ORDER BY e.place) AS island
  FROM (SELECT CAST(event_id % 4 AS VARCHAR) AS topic_partition, event_id // 4 AS place FROM events) e
  JOIN (SELECT topic_partition, min(place) AS low, max(place) AS high FROM consumed GROUP BY 1) c
  ON e.topic_partition = c.topic_partition AND e.place BETWEEN low AND high
  WHERE (e.topic_partition, e.place) NOT IN (SELECT (topic_partition, place) FROM consumed))
SELECT 'events' AS topic_name, topic_partition, min(place) AS first_missing, max(place) AS last_missing
FROM missing GROUP BY topic_partition, island"""
)
def offset_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets that no batch has read."""
    return gaps_of(_ranges(spark, sf))


@query(
    f"""WITH {RANGES_SQL},
twice AS (SELECT topic_partition, place, batch_id FROM consumed GROUP BY ALL HAVING count(*) > 1)
SELECT 'events' AS topic_name, topic_partition, min(place) AS first_again, max(place) AS last_again
FROM twice GROUP BY topic_partition, batch_id"""
)
def offset_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets that a batch has read again."""
    return overlaps_of(_ranges(spark, sf))


@query(
    f"""WITH {LEDGER_SQL}
SELECT topic_partition, topic_offset FROM ledger WHERE topic_name = 'events'"""
)
def ledger_topic(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_of_topic(_fresh_and_ledger(spark, sf)[1], "events")


@query(
    f"""WITH {LEDGER_SQL}
SELECT topic_name, '{{"' || topic_name || '":{{'
       || string_agg('"' || topic_partition || '":' || topic_offset, ',' ORDER BY topic_partition)
       || '}}}}' AS starting_offsets
FROM ledger GROUP BY topic_name"""
)
def ledger_starting_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return starting_offsets(_fresh_and_ledger(spark, sf)[1])


# Metrics. Each day of events counts as one batch.

METRICS_SQL = """
metrics AS (
  SELECT CAST(ts AS DATE) AS day, 'events' AS topic_name,
         min(ts) AS metrics_window_start_time, max(ts) AS metrics_window_end_time,
         count(*) AS total, count(*) FILTER (WHERE event_type = 'view') AS validation,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS transformation,
         0 AS exception, count(*) FILTER (WHERE event_type = 'error') AS dlq,
         count(DISTINCT user_id) AS target_write
  FROM events GROUP BY 1)"""
PAYLOAD_SQL = """'{"topic_count":' || total
       || ',"metrics_window_start_time":"'
       || strftime(metrics_window_start_time, '%Y-%m-%dT%H:%M:%S.%f')
       || '","metrics_window_end_time":"'
       || strftime(metrics_window_end_time, '%Y-%m-%dT%H:%M:%S.%f')
       || '","metrics_stages":{"01_validation":' || validation
       || ',"02_transformation":' || transformation || ',"03_exception":' || exception
       || ',"04_dlq":' || dlq || ',"05_target_write":' || target_write || '}}'"""


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.lit("events").alias("topic_name"),
            F.min("ts").alias("metrics_window_start_time"),
            F.max("ts").alias("metrics_window_end_time"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(kind == "view").alias("validation"),
            F.count_if(kind.isin("click", "purchase")).alias("transformation"),
            F.lit(0).cast("bigint").alias("exception"),
            F.count_if(kind == "error").alias("dlq"),
            F.count_distinct("user_id").alias("target_write"),
        )
    )


@query(
    f"""WITH {METRICS_SQL}
SELECT topic_name, min(metrics_window_start_time) AS metrics_window_start_time,
       max(metrics_window_end_time) AS metrics_window_end_time,
       CAST(sum(total) AS BIGINT) AS total, CAST(sum(validation) AS BIGINT) AS validation,
       CAST(sum(transformation) AS BIGINT) AS transformation,
       CAST(sum(exception) AS BIGINT) AS exception, CAST(sum(dlq) AS BIGINT) AS dlq,
       CAST(sum(target_write) AS BIGINT) AS target_write
FROM metrics GROUP BY topic_name"""
)
def metrics_total(spark: SparkSession, sf: str) -> DataFrame:
    return metrics_rollup(_metrics(spark, sf), ["topic_name"])


@query(f"WITH {METRICS_SQL} SELECT day, {PAYLOAD_SQL} AS json_data FROM metrics")
def metrics_json(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select("day", metrics_payload().alias("json_data"))


@query(
    f"""WITH {METRICS_SQL}
SELECT 'daily' AS workflow, 'run-1' AS run_name, DATE '2024-02-01' AS processed_on,
       'events' AS topic_name, {PAYLOAD_SQL} AS json_data,
       metrics_window_end_time AS logged_timestamp
FROM metrics WHERE total > 0"""
)
def stats_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stats_rows(
        _metrics(spark, sf),
        topic="events",
        labels={"workflow": "daily", "run_name": "run-1", "processed_on": F.lit("2024-02-01").cast("date")},
        at=F.col("metrics_window_end_time"),
    )
