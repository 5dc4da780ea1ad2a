"""Joins, lookups, unions and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.data import ACCOUNTS_SQL, MESSAGES_SQL, accounts, messages, table
from registry.transforms import message_key
from rulestream.operators.audit import row_count
from rulestream.operators.joins import distinct_keys, enrich_left, join_reference, lookup_semi
from rulestream.operators.transform import run_steps
from rulestream.plans.spec import JoinKind, SqlStep, StepKind
from rulestream.sources.readers import read_table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", F.col("o_custkey").alias("cust"), "o_orderstatus")


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select(F.col("c_custkey").alias("cust"), "c_name")


JOIN_SQL = """SELECT {key}.cust AS cust, o.o_orderkey, o.o_orderstatus, c.c_name
FROM (SELECT o_orderkey, o_custkey AS cust, o_orderstatus FROM orders) o
{how} JOIN (SELECT c_custkey AS cust, c_name FROM customer) c
ON o.cust = c.cust"""


@query(JOIN_SQL.format(key="o", how="LEFT"))
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    return join_reference(_orders(spark, sf), _customers(spark, sf), ["cust"], JoinKind.LEFT)


@query(JOIN_SQL.format(key="c", how="RIGHT"))
def join_right(spark: SparkSession, sf: str) -> DataFrame:
    return join_reference(_orders(spark, sf), _customers(spark, sf), ["cust"], JoinKind.RIGHT)


@query("SELECT o_orderkey, o_custkey AS cust, o_orderstatus FROM orders")
def join_none(spark: SparkSession, sf: str) -> DataFrame:
    return join_reference(_orders(spark, sf), _customers(spark, sf), ["cust"], JoinKind.NONE)


@query(
    """SELECT o_orderkey, o_custkey AS cust, o_orderstatus, NULL AS c_name FROM orders
UNION ALL SELECT NULL, c_custkey, NULL, c_name FROM customer"""
)
def join_union(spark: SparkSession, sf: str) -> DataFrame:
    return join_reference(_orders(spark, sf), _customers(spark, sf), [], JoinKind.UNION)


@query(
    """SELECT l_orderkey, l_linenumber, c_custkey, c_name FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
)
def join_inner_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Inner joins over the views of earlier steps."""
    steps = [
        SqlStep(place, name, f"chain_{name}", StepKind.TABLE)
        for place, name in enumerate(("lineitem", "orders", "customer"))
    ]
    steps += [
        SqlStep(
            3,
            "SELECT o_orderkey, c_custkey, c_name FROM chain_orders JOIN chain_customer ON o_custkey = c_custkey",
            "placed",
        ),
        SqlStep(
            4,
            "SELECT l_orderkey, l_linenumber, c_custkey, c_name FROM chain_lineitem JOIN placed ON l_orderkey = o_orderkey",
            "lines",
        ),
    ]
    return run_steps(spark, steps, lambda session, name: table(session, sf, name))


@query(
    f"""WITH {MESSAGES_SQL}, {ACCOUNTS_SQL}
SELECT event_id, seq_num, balance, account_key, account_name, ledger_amt
FROM messages LEFT JOIN accounts
ON CASE WHEN origin = 'APP' THEN 'ACCT^' || acc_num || '^' || nsc = account_key END"""
)
def enrich_by_computed_key(spark: SparkSession, sf: str) -> DataFrame:
    enriched = enrich_left(messages(spark, sf), accounts(spark, sf), message_key(), "account_key")
    return enriched.select(
        "event_id", "seq_num", "balance", "account_key", "account_name", "ledger_amt"
    )


@query(
    """SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT user_id FROM events)"""
)
def lookup_by_incoming_keys(spark: SparkSession, sf: str) -> DataFrame:
    incoming = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    customers = table(spark, sf, "customer")
    return lookup_semi(customers, incoming, ["c_custkey"], ["c_custkey", "c_name"])


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_incoming_keys(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(table(spark, sf, "events"), ["user_id", "event_type"])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def reference_scan(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return read_table(spark, "parquet", columns=columns, path=f"{sf}/customer.parquet")


@query("SELECT count(*) AS rows FROM lineitem")
def row_total(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(table(spark, sf, "lineitem"))
