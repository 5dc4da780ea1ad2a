"""Upserts, the table by buckets and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.data import ACCOUNT_PREFIX, ACCOUNTS_SQL, MESSAGES_SQL, accounts, table
from registry.transforms import LATEST_SQL, ROUTED_SQL, balance_update
from rulestream.functions.keys import composite_key
from rulestream.operators.joins import lookup_semi
from rulestream.operators.merge import upsert
from rulestream.sources.bucket_table import BucketTable
from rulestream.sources.readers import read_csv
from rulestream.sources.shared import run_folder, written

ACCOUNT_COLUMNS = (
    "account_key, account_name, nation, ledger_amt, ledger_seq, ledger_at, "
    "shadow_amt, shadow_seq, shadow_at"
)

UPDATES_SQL = f"""{MESSAGES_SQL}, {ACCOUNTS_SQL}, {LATEST_SQL},
keyed AS (SELECT *, CASE WHEN origin = 'APP' THEN 'ACCT^' || acc_num || '^' || nsc END AS key
          FROM latest),
updates AS (
  SELECT key AS account_key, account_name, nation, {ROUTED_SQL}
  FROM keyed LEFT JOIN accounts ON keyed.key = accounts.account_key
  WHERE key IS NOT NULL)"""

UPSERTED_SQL = f"""WITH {UPDATES_SQL}
SELECT {ACCOUNT_COLUMNS} FROM accounts
WHERE account_key NOT IN (SELECT account_key FROM updates)
UNION ALL SELECT {ACCOUNT_COLUMNS} FROM updates"""


def updates(spark: SparkSession, sf: str) -> DataFrame:
    rows = balance_update(spark, sf).filter("account_key IS NOT NULL")
    return written(rows, run_folder(spark, "updates"))


def account_table(spark: SparkSession, sf: str) -> BucketTable:
    """The accounts as a new table by buckets of their key."""
    rows = accounts(spark, sf)
    made = BucketTable(run_folder(spark, "accounts"), ("account_key",), rows.schema)
    made.create(rows)
    return made


@query(UPSERTED_SQL)
def upsert_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Updates carry the balances only; name and nation stay as they are."""
    return upsert(accounts(spark, sf), updates(spark, sf), ["account_key"])


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""
)
def upsert_whole_rows(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return upsert(table(spark, sf, "customer"), suppliers, ["c_custkey"])


@query(UPSERTED_SQL)
def keyed_table_current(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert through the table on files, with the batch merged twice."""
    made = account_table(spark, sf)
    changes = updates(spark, sf)
    made.merge(changes, batch_id=0)
    made.merge(changes, batch_id=0)
    return made.current(spark)


@query(
    f"""WITH {UPDATES_SQL} SELECT {ACCOUNT_COLUMNS} FROM updates
WHERE account_key IN (SELECT account_key FROM accounts)"""
)
def keyed_table_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Only the rows of the updated keys that were there before, as they are now."""
    made = account_table(spark, sf)
    changes = updates(spark, sf)
    made.merge(changes, batch_id=0)
    return made.lookup(lookup_semi(accounts(spark, sf), changes, ["account_key"]))


@query(UPSERTED_SQL)
def keyed_table_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The upserted table, dealt anew to more buckets."""
    made = account_table(spark, sf)
    made.merge(updates(spark, sf), batch_id=0)
    return made.resized(spark, run_folder(spark, "accounts"), 40).current(spark)


@query(
    f"""WITH {ACCOUNTS_SQL} SELECT {ACCOUNT_COLUMNS} FROM accounts
WHERE account_key IN (SELECT 'ACCT^' || o_custkey || '^' || (o_custkey % 10) FROM orders WHERE o_totalprice > 300000)"""
)
def lookup_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The accounts of the dearest orders; buckets without one are not read."""
    buyer = F.col("o_custkey")
    orders = table(spark, sf, "orders").where("o_totalprice > 300000")
    keys = orders.select(composite_key(ACCOUNT_PREFIX, [buyer, buyer % 10]).alias("account_key"))
    return account_table(spark, sf).lookup(keys)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files with a header, read by a given schema."""
    customers = table(spark, sf, "customer")
    folder = run_folder(spark, "csv")
    customers.write.option("header", "true").csv(folder)
    return read_csv(spark, folder, customers.schema)
