"""Normalising, latest rows, SQL steps, mappings, keys and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.data import (
    ACCOUNT_PREFIX,
    ACCOUNTS_SQL,
    MESSAGES_SQL,
    ORIGIN,
    accounts,
    messages,
    table,
)
from rulestream.functions.keys import composite_key, key_part
from rulestream.functions.routing import Balance, route_by_status
from rulestream.operators.joins import enrich_left
from rulestream.operators.transform import (
    apply_mapping,
    latest_per_key,
    latest_per_status,
    publish,
    run_source_query,
    run_steps,
)
from rulestream.plans.spec import ColumnMapping, JoinKind, Latest, SourceQuery, SqlStep, Stage, StepKind

LATEST_SQL = """
latest AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY acc_num, nsc
                                 ORDER BY sent_at DESC, event_id DESC) AS rn FROM messages)
  WHERE rn = 1)"""

ROUTED_SQL = """
       CAST(CASE WHEN balance_status = 'POSTED' THEN balance ELSE ledger_amt END
            AS DECIMAL(23,4)) AS ledger_amt,
       CASE WHEN balance_status = 'POSTED' THEN seq_num ELSE ledger_seq END AS ledger_seq,
       CASE WHEN balance_status = 'POSTED' THEN sent_at ELSE ledger_at END AS ledger_at,
       CAST(CASE WHEN balance_status = 'POSTED' THEN shadow_amt ELSE balance END
            AS DECIMAL(23,4)) AS shadow_amt,
       CASE WHEN balance_status = 'SHADOW' THEN seq_num ELSE shadow_seq END AS shadow_seq,
       CASE WHEN balance_status = 'SHADOW' THEN sent_at ELSE shadow_at END AS shadow_at"""

# Which side each status replaces is fixed; names and types follow the account table.
MAPPINGS = (
    ColumnMapping(1, "key", "account_key", "string"),
    ColumnMapping(2, "new_ledger_amt", "ledger_amt", "decimal(23,4)"),
    ColumnMapping(3, "new_ledger_seq", "ledger_seq", "string"),
    ColumnMapping(4, "new_ledger_at", "ledger_at", "timestamp_ntz"),
    ColumnMapping(5, "new_shadow_amt", "shadow_amt", "decimal(23,4)"),
    ColumnMapping(6, "new_shadow_seq", "shadow_seq", "string"),
    ColumnMapping(7, "new_shadow_at", "shadow_at", "timestamp_ntz"),
)


def message_key():
    return composite_key(ACCOUNT_PREFIX, ["acc_num", "nsc"], only_if=F.col("origin") == ORIGIN)


def latest_messages(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(messages(spark, sf), ["acc_num", "nsc"], ["sent_at"], ["event_id"])


def routed(enriched: DataFrame, newer_only: bool = False) -> DataFrame:
    ledger, shadow = route_by_status(
        F.col("balance_status"),
        incoming=Balance(F.col("balance"), F.col("seq_num"), F.col("sent_at")),
        ledger=Balance(F.col("ledger_amt"), F.col("ledger_seq"), F.col("ledger_at")),
        shadow=Balance(F.col("shadow_amt"), F.col("shadow_seq"), F.col("shadow_at")),
        newer_only=newer_only,
    )
    return enriched.select(
        "event_id",
        message_key().alias("key"),
        ledger.amount.alias("new_ledger_amt"),
        ledger.seq.alias("new_ledger_seq"),
        ledger.at.alias("new_ledger_at"),
        shadow.amount.alias("new_shadow_amt"),
        shadow.seq.alias("new_shadow_seq"),
        shadow.at.alias("new_shadow_at"),
    )


@query(
    f"""WITH {MESSAGES_SQL}, {ACCOUNTS_SQL}, {LATEST_SQL},
keyed AS (SELECT *, CASE WHEN origin = 'APP' THEN 'ACCT^' || acc_num || '^' || nsc END AS key
          FROM latest)
SELECT key AS account_key, {ROUTED_SQL}
FROM keyed LEFT JOIN accounts ON keyed.key = accounts.account_key"""
)
def balance_update(spark: SparkSession, sf: str) -> DataFrame:
    """Latest message per account, joined to its account, routed and mapped."""
    latest = latest_messages(spark, sf)
    enriched = enrich_left(latest, accounts(spark, sf), message_key(), "account_key")
    return apply_mapping(routed(enriched), MAPPINGS, "balances")


@query(
    f"""WITH {MESSAGES_SQL}, {ACCOUNTS_SQL},
latest AS (SELECT * FROM messages),
keyed AS (SELECT *, CASE WHEN origin = 'APP' THEN 'ACCT^' || acc_num || '^' || nsc END AS key
          FROM latest)
SELECT event_id, key AS account_key, {ROUTED_SQL}
FROM keyed LEFT JOIN accounts ON keyed.key = accounts.account_key"""
)
def route_all_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Routing of every single message, null keys and unknown statuses included."""
    enriched = enrich_left(messages(spark, sf), accounts(spark, sf), message_key(), "account_key")
    with_id = (ColumnMapping(0, "event_id", "event_id", "bigint"), *MAPPINGS)
    return apply_mapping(routed(enriched), with_id, "balances")


@query(
    f"""WITH {MESSAGES_SQL}, {ACCOUNTS_SQL},
keyed AS (SELECT *, CASE WHEN origin = 'APP' THEN 'ACCT^' || acc_num || '^' || nsc END AS key
          FROM messages),
flagged AS (
  SELECT *, balance_status IS NOT DISTINCT FROM 'POSTED' AS posted,
         balance_status IS NOT DISTINCT FROM 'SHADOW' AS shadow,
         ledger_at IS NULL OR sent_at > ledger_at AS ledger_old,
         shadow_at IS NULL OR sent_at > shadow_at AS shadow_old
  FROM keyed LEFT JOIN accounts ON keyed.key = accounts.account_key)
SELECT event_id, key AS account_key,
       CAST(CASE WHEN posted AND ledger_old THEN balance ELSE ledger_amt END
            AS DECIMAL(23,4)) AS ledger_amt,
       CASE WHEN posted AND ledger_old THEN seq_num ELSE ledger_seq END AS ledger_seq,
       CASE WHEN posted AND ledger_old THEN sent_at ELSE ledger_at END AS ledger_at,
       CAST(CASE WHEN NOT posted AND shadow_old THEN balance ELSE shadow_amt END
            AS DECIMAL(23,4)) AS shadow_amt,
       CASE WHEN shadow AND shadow_old THEN seq_num ELSE shadow_seq END AS shadow_seq,
       CASE WHEN shadow AND shadow_old THEN sent_at ELSE shadow_at END AS shadow_at
FROM flagged"""
)
def route_newer_only(spark: SparkSession, sf: str) -> DataFrame:
    """Routing that leaves a side alone when it is newer than the message."""
    enriched = enrich_left(messages(spark, sf), accounts(spark, sf), message_key(), "account_key")
    with_id = (ColumnMapping(0, "event_id", "event_id", "bigint"), *MAPPINGS)
    return apply_mapping(routed(enriched, newer_only=True), with_id, "balances")


@query(f"WITH {MESSAGES_SQL}, {LATEST_SQL} SELECT * FROM latest")
def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    return latest_messages(spark, sf)


@query(
    f"""WITH {MESSAGES_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY acc_num, nsc ORDER BY sent_at DESC, event_id DESC) AS place FROM messages)
SELECT * FROM ranked WHERE place <= 3"""
)
def latest_n_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The three latest messages of each account, by a step of the specification."""
    messages(spark, sf).createOrReplaceTempView("all_messages")
    latest = Latest(("acc_num", "nsc"), ("sent_at", "event_id"), rows=3)
    return run_steps(spark, [SqlStep(1, "all_messages", "three_latest", StepKind.LATEST, latest=latest)])


@query(
    """WITH per_order AS (
  SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) AS lines FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, quantity, 'large' AS kind FROM per_order WHERE quantity >= 150
UNION ALL SELECT l_orderkey, quantity, 'single' FROM per_order WHERE lines = 1"""
)
def shared_steps(spark: SparkSession, sf: str) -> DataFrame:
    """A step that two later ones read is computed once."""
    steps = [
        SqlStep(1, "lineitem", "shared_lines", StepKind.TABLE),
        SqlStep(
            2,
            "SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) AS lines FROM shared_lines GROUP BY l_orderkey",
            "per_order",
        ),
        SqlStep(3, "SELECT l_orderkey, quantity, 'large' AS kind FROM per_order WHERE quantity >= 150", "large_orders"),
        SqlStep(4, "SELECT l_orderkey, quantity, 'single' AS kind FROM per_order WHERE lines = 1", "single_orders"),
        SqlStep(5, "SELECT * FROM large_orders UNION ALL SELECT * FROM single_orders", "told_orders"),
    ]
    return run_steps(spark, steps, lambda session, name: table(session, sf, name))


@query(
    f"""WITH {MESSAGES_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY acc_num, nsc, balance_status
                               ORDER BY sent_at DESC, event_id DESC) AS rn FROM messages),
posted AS (SELECT * FROM ranked WHERE rn = 1 AND balance_status = 'POSTED'),
shadow AS (SELECT * FROM ranked WHERE rn = 1 AND balance_status = 'SHADOW'),
keys AS (SELECT DISTINCT acc_num, nsc FROM messages)
SELECT k.acc_num, k.nsc, p.balance AS posted_balance, p.seq_num AS posted_seq_num,
       p.sent_at AS posted_sent_at, s.balance AS shadow_balance,
       s.seq_num AS shadow_seq_num, s.sent_at AS shadow_sent_at
FROM keys k LEFT JOIN posted p ON k.acc_num = p.acc_num AND k.nsc = p.nsc
LEFT JOIN shadow s ON k.acc_num = s.acc_num AND k.nsc = s.nsc"""
)
def latest_row_per_status(spark: SparkSession, sf: str) -> DataFrame:
    """Neither status hides the other when both occur for an account."""
    return latest_per_status(
        messages(spark, sf),
        ["acc_num", "nsc"],
        status="balance_status",
        statuses=("POSTED", "SHADOW"),
        order=("sent_at", "event_id"),
        values=("balance", "seq_num", "sent_at"),
    )


@query(
    """WITH places AS (
  SELECT n_nationkey AS nation, n_name AS nation_name, r_name AS region_name
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, nation_name, region_name FROM customer JOIN places ON c_nationkey = nation"""
)
def sql_steps(spark: SparkSession, sf: str) -> DataFrame:
    """A chain of steps, each reading the views of those before it."""
    for name in ("nation", "region", "customer"):
        publish(table(spark, sf, name), f"given_{name}")
    steps = [
        SqlStep(
            2,
            "SELECT n_nationkey AS nation, n_name AS nation_name, r_name AS region_name "
            "FROM given_nation JOIN regions ON n_regionkey = r_regionkey",
            "places",
        ),
        SqlStep(1, "given_region", "regions", StepKind.TABLE),
        SqlStep(
            3,
            "SELECT c_custkey, nation_name, region_name "
            "FROM given_customer JOIN places ON c_nationkey = nation",
            "customer_places",
        ),
        SqlStep(0, "SELECT * FROM given_region", "regions_first", stage=Stage.NORMALISE),
    ]
    return run_steps(spark, steps)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
)
def source_query(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over views, then the configured left join with the last step."""
    publish(table(spark, sf, "orders"), "given_orders")
    publish(table(spark, sf, "customer"), "given_customer")
    steps = [
        SqlStep(
            1, "SELECT c_custkey AS o_custkey, c_name, c_mktsegment FROM given_customer", "buyers"
        )
    ]
    source = SourceQuery(
        "SELECT o_orderkey, o_custkey, o_orderstatus FROM given_orders",
        JoinKind.LEFT,
        ("o_custkey",),
    )
    return run_source_query(spark, source, run_steps(spark, steps))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'B' || o_custkey AS buyer,
       o_orderstatus AS state, CAST(o_totalprice AS DECIMAL(14,1)) AS price,
       CAST(year(o_orderdate) AS INTEGER) AS placed_in,
       TRY_CAST(o_orderstatus AS DOUBLE) AS no_number, 'orders_load' AS loaded_by,
       CASE WHEN o_totalprice > 150000 THEN 'large' ELSE 'small' END AS bracket
FROM orders"""
)
def column_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Columns taken over, computed, named by the process, and of a type that does not fit."""
    mappings = [
        ColumnMapping(9, "", "bracket", "string", "if(o_totalprice > 150000, 'large', 'small')"),
        ColumnMapping(2, "o_orderkey", "id", "string", "PassThrough"),
        ColumnMapping(1, "o_orderstatus", "state", "string"),
        ColumnMapping(4, "o_totalprice", "price", "decimal(14,1)"),
        ColumnMapping(3, "", "buyer", "string", "'B' || o_custkey"),
        ColumnMapping(6, "o_orderstatus", "no_number", "double"),
        ColumnMapping(5, "", "placed_in", "int", "year(o_orderdate)"),
        ColumnMapping(7, "", "loaded_by", "string", "stream_process_name"),
    ]
    return apply_mapping(table(spark, sf, "orders"), mappings, "orders_load")


@query(
    """SELECT s_suppkey, key, split_part(key, '^', 2) AS first_part,
       split_part(key, '^', 3) AS last_part
FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 0
             THEN 'SUPP^' || s_suppkey || '^' || s_nationkey END AS key FROM supplier)"""
)
def composite_key_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    key = composite_key("SUPP", ["s_suppkey", "s_nationkey"], only_if=F.col("s_acctbal") > 0)
    keyed = table(spark, sf, "supplier").select("s_suppkey", key.alias("key"))
    return keyed.select(
        "s_suppkey",
        "key",
        key_part("key", -2).alias("first_part"),
        key_part("key", -1).alias("last_part"),
    )
