"""Frames derived from the given tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.functions.keys import composite_key

ACCOUNT_PREFIX = "ACCT"
ORIGIN = "APP"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Events as balance messages. Purchases and signups post a balance, clicks and views
# shadow it, errors carry no status. Signups come from another origin.

MESSAGES_SQL = """
messages AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS seq_num, ts AS sent_at,
         CASE WHEN event_type = 'signup' THEN 'WEB' ELSE 'APP' END AS origin,
         CAST(user_id AS VARCHAR) AS acc_num, CAST(user_id % 10 AS VARCHAR) AS nsc,
         CAST(value AS DECIMAL(32,6)) AS balance,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POSTED'
              WHEN event_type IN ('click', 'view') THEN 'SHADOW' END AS balance_status
  FROM events)"""


def messages_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("event_id").cast("string").alias("seq_num"),
        F.col("ts").alias("sent_at"),
        F.when(kind == "signup", "WEB").otherwise(ORIGIN).alias("origin"),
        F.col("user_id").cast("string").alias("acc_num"),
        (F.col("user_id") % 10).cast("string").alias("nsc"),
        F.col("value").cast("decimal(32,6)").alias("balance"),
        F.when(kind.isin("purchase", "signup"), "POSTED")
        .when(kind.isin("click", "view"), "SHADOW")
        .alias("balance_status"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return messages_of(table(spark, sf, "events"))


# Customers as accounts, with a balance on both sides.

ACCOUNTS_SQL = """
accounts AS (
  SELECT 'ACCT^' || c_custkey || '^' || (c_custkey % 10) AS account_key,
         c_name AS account_name, c_nationkey AS nation,
         CAST(c_acctbal AS DECIMAL(23,4)) AS ledger_amt,
         'L' || c_custkey AS ledger_seq, TIMESTAMP '2024-01-15 00:00:00' AS ledger_at,
         CAST(-c_acctbal AS DECIMAL(23,4)) AS shadow_amt,
         'S' || c_custkey AS shadow_seq, TIMESTAMP '2024-01-25 00:00:00' AS shadow_at
  FROM customer)"""


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        composite_key(ACCOUNT_PREFIX, [number, number % 10]).alias("account_key"),
        F.col("c_name").alias("account_name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").cast("decimal(23,4)").alias("ledger_amt"),
        F.concat(F.lit("L"), number).alias("ledger_seq"),
        F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").alias("ledger_at"),
        (-F.col("c_acctbal")).cast("decimal(23,4)").alias("shadow_amt"),
        F.concat(F.lit("S"), number).alias("shadow_seq"),
        F.lit("2024-01-25 00:00:00").cast("timestamp_ntz").alias("shadow_at"),
    )


# Events as encoded topic rows. The payload nests header and body. Views carry a
# status no rule allows, and the payload of an error is cut off.

MESSAGE_SCHEMA = (
    "header struct<sent_at:string, seq_num:string, origin:string>, "
    "body struct<account:struct<acc_num:string, balance:decimal(32,6), balance_status:string>,"
    " branch:struct<nsc:string>>"
)

TOPIC_STATUS_SQL = """CASE WHEN event_type IN ('purchase', 'signup') THEN 'POSTED'
              WHEN event_type = 'click' THEN 'SHADOW' ELSE 'PENDING' END"""


def topic_rows_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind.isin("purchase", "signup"), "POSTED")
        .when(kind == "click", "SHADOW")
        .otherwise("PENDING")
    )
    rows = events.select(
        "event_id",
        kind.alias("event_type"),
        F.struct(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("sent_at"),
            F.col("event_id").cast("string").alias("seq_num"),
            F.when(kind == "signup", "WEB").otherwise(ORIGIN).alias("origin"),
        ).alias("header"),
        F.struct(
            F.struct(
                F.col("user_id").cast("string").alias("acc_num"),
                F.col("value").cast("decimal(32,6)").alias("balance"),
                status.alias("balance_status"),
            ).alias("account"),
            F.struct((F.col("user_id") % 10).cast("string").alias("nsc")).alias("branch"),
        ).alias("body"),
    )
    text = F.to_json(F.struct("header", "body"))
    cut = F.when(F.col("event_type") == "error", F.left(text, F.length(text) - 2)).otherwise(text)
    return rows.select(
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"),
        cut.cast("binary").alias("value"),
    )


def topic_rows(spark: SparkSession, sf: str) -> DataFrame:
    return topic_rows_of(table(spark, sf, "events"))
