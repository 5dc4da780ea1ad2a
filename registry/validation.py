"""Validation rules, acceptance, rejects and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.data import table
from rulestream.functions.checks import is_date, is_enum, is_float, is_integer, is_mandatory
from rulestream.operators.validate import (
    LEVELS,
    META,
    META_VALID,
    accept,
    check_reject_limit,
    drop_meta,
    failure_counts,
    reject,
    reject_counts,
    reject_cube,
    reject_summary,
    select_rules,
    tag,
    with_messages,
)
from rulestream.plans.spec import RuleKind, RuleSet, ValidationRule, ValidationStage

# The number patterns in the SQL of this module.

# Number texts of many shapes, made from the number in the event properties.
RAW_SQL = r"""
raw AS (
  SELECT event_id,
         CASE event_type WHEN 'click' THEN k WHEN 'view' THEN '-' || k
              WHEN 'purchase' THEN ' ' || k || ' ' WHEN 'signup' THEN k || '.5e' || k
              WHEN 'error' THEN CASE WHEN k IN ('1', '2', '3') THEN NULL
                                     WHEN k IN ('4', '5') THEN '' WHEN k = '6' THEN '+'
                                     WHEN k = '7' THEN ' ' ELSE props END END AS raw
  FROM (SELECT *, regexp_extract(props, '(\d+)', 1) AS k FROM events))"""


def with_raw(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    k = F.col("k")
    odd = (
        F.when(k.isin("1", "2", "3"), F.lit(None))
        .when(k.isin("4", "5"), "")
        .when(k == "6", "+")
        .when(k == "7", " ")
        .otherwise(F.col("props"))
    )
    raw = (
        F.when(kind == "click", k)
        .when(kind == "view", F.concat(F.lit("-"), k))
        .when(kind == "purchase", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(kind == "signup", F.concat(k, F.lit(".5e"), k))
        .when(kind == "error", odd)
    )
    with_k = events.withColumn("k", F.regexp_extract("props", r"(\d+)", 1))
    return with_k.withColumn("raw", raw)


def raw_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return with_raw(table(spark, sf, "events")).select("event_id", "raw")


@query(
    rf"""WITH {RAW_SQL}
SELECT event_id, raw,
       raw IS NULL OR regexp_extract(raw, '^\s*[-+]?\d*\s*$', 0) <> '' AS ok
FROM raw"""
)
def validate_integer(spark: SparkSession, sf: str) -> DataFrame:
    return raw_numbers(spark, sf).select("event_id", "raw", is_integer("raw").alias("ok"))


@query(
    rf"""WITH {RAW_SQL}
SELECT event_id, raw,
       raw IS NULL OR regexp_extract(raw, '[-+]?\d*\.\d+(?:[eE][-+]?\d+)?', 0) <> '' AS ok
FROM raw"""
)
def validate_float(spark: SparkSession, sf: str) -> DataFrame:
    return raw_numbers(spark, sf).select("event_id", "raw", is_float("raw").alias("ok"))


@query(
    rf"""WITH {RAW_SQL}
SELECT event_id, raw,
       raw IS NULL OR regexp_full_match(raw, '\s*[-+]?\d+\s*') AS integer_ok,
       raw IS NULL OR regexp_full_match(raw, '[-+]?\d*\.\d+([eE][-+]?\d+)?') AS float_ok
FROM raw"""
)
def validate_strict_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return raw_numbers(spark, sf).select(
        "event_id",
        "raw",
        is_integer("raw", strict=True).alias("integer_ok"),
        is_float("raw", strict=True).alias("float_ok"),
    )


@query(
    r"""SELECT doc_id,
       regexp_extract(text, '[-+]?\d*\.\d+(?:[eE][-+]?\d+)?', 0) <> '' AS float_ok,
       regexp_extract(text, '^\s*[-+]?\d*\s*$', 0) <> '' AS integer_ok
FROM documents"""
)
def validate_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", is_float("text").alias("float_ok"), is_integer("text").alias("integer_ok")
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS raw,
       try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%d/%m/%Y') IS NOT NULL AS ok
FROM orders"""
)
def validate_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    raw = orders.select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("raw"))
    return raw.select("o_orderkey", "raw", is_date("raw", "dd/MM/yyyy").alias("ok"))


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    status = F.nullif("event_type", F.lit("error"))
    return table(spark, sf, "events").select("event_id", status.alias("status"))


STATUS_SQL = "SELECT event_id, nullif(event_type, 'error') AS status FROM events"


@query(
    f"""SELECT event_id, status,
       coalesce(status IN ('click', 'view'), false) AS ok FROM ({STATUS_SQL})"""
)
def validate_enum(spark: SparkSession, sf: str) -> DataFrame:
    return statuses(spark, sf).withColumn("ok", is_enum("status", ["click", "view"]))


@query(
    f"""SELECT event_id, status,
       status IS NULL OR status IN ('click', 'view') AS ok FROM ({STATUS_SQL})"""
)
def validate_enum_nullable(spark: SparkSession, sf: str) -> DataFrame:
    return statuses(spark, sf).withColumn("ok", is_enum("status", ["click", "view", None]))


@query(f"SELECT event_id, status, status IS NOT NULL AS ok FROM ({STATUS_SQL})")
def validate_mandatory(spark: SparkSession, sf: str) -> DataFrame:
    return statuses(spark, sf).withColumn("ok", is_mandatory("status"))


# A record of mixed quality, and rules that fail on parts of it.

RULES = RuleSet(
    key=("event_id", "user_id"),
    rules=(
        ValidationRule("raw", RuleKind.INTEGER, stage=ValidationStage.PRE),
        ValidationRule("raw", RuleKind.MANDATORY),
        ValidationRule("status", RuleKind.ENUM, enum=("click", "view", "purchase")),
        ValidationRule(
            "day", RuleKind.DATE, date_format="dd/MM/yyyy", stage=ValidationStage.POST
        ),
        ValidationRule("amount", RuleKind.FLOAT, stage=ValidationStage.PRE),
    ),
)

RECORDS_SQL = rf"""{RAW_SQL},
records AS (
  SELECT e.event_id, e.user_id, e.ts, r.raw, nullif(e.event_type, 'error') AS status,
         strftime(e.ts, '%m/%d/%Y') AS day,
         CASE WHEN e.event_id % 5 = 0 THEN CAST(e.event_id AS VARCHAR)
              ELSE CAST(CAST(e.value AS DECIMAL(12,2)) AS VARCHAR) END AS amount
  FROM events e JOIN raw r ON e.event_id = r.event_id),
checked AS (
  SELECT *, raw IS NULL OR regexp_extract(raw, '^\s*[-+]?\d*\s*$', 0) <> '' AS raw_0,
         raw IS NOT NULL AS raw_1,
         coalesce(status IN ('click', 'view', 'purchase'), false) AS status_2,
         try_strptime(day, '%d/%m/%Y') IS NOT NULL AS day_3,
         regexp_extract(amount, '[-+]?\d*\.\d+', 0) <> '' AS amount_4
  FROM records)"""
ALL_OK_SQL = "(raw_0 AND raw_1 AND status_2 AND day_3 AND amount_4)"
FIELDS_SQL = "event_id, user_id, ts, raw, status, day, amount"


def records(spark: SparkSession, sf: str) -> DataFrame:
    return with_raw(table(spark, sf, "events")).select(
        "event_id",
        "user_id",
        "ts",
        "raw",
        F.nullif("event_type", F.lit("error")).alias("status"),
        F.date_format("ts", "MM/dd/yyyy").alias("day"),
        F.when(F.col("event_id") % 5 == 0, F.col("event_id").cast("string"))
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
        .alias("amount"),
    )


@query(
    f"""WITH {RECORDS_SQL}
SELECT {FIELDS_SQL}, raw_0, raw_1, status_2, day_3, amount_4, {ALL_OK_SQL} AS all_ok
FROM checked"""
)
def validate_tag(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag(records(spark, sf), RULES)
    names = [f.name for f in tagged.schema[META].dataType.fields]
    return tagged.select(
        *drop_meta(tagged).columns,
        *(F.col(f"{META}.{n}.valid").alias(n) for n in names),
        F.col(META_VALID).alias("all_ok"),
    )


@query(
    f"""WITH {RECORDS_SQL}
SELECT {FIELDS_SQL}, 'is_integer' AS first_rule, true AS first_valid, true AS all_ok
FROM checked WHERE {ALL_OK_SQL}"""
)
def validate_accept(spark: SparkSession, sf: str) -> DataFrame:
    accepted = accept(records(spark, sf), RULES)
    return accepted.select(
        *drop_meta(accepted).columns,
        F.col(f"{META}.raw_0.validation").alias("first_rule"),
        F.col(f"{META}.raw_0.valid").alias("first_valid"),
        F.col(META_VALID).alias("all_ok"),
    )


@query(f"WITH {RECORDS_SQL} SELECT {FIELDS_SQL} FROM checked WHERE NOT {ALL_OK_SQL}")
def validate_reject(spark: SparkSession, sf: str) -> DataFrame:
    return drop_meta(reject(records(spark, sf), RULES))


@query(
    f"""WITH {RECORDS_SQL}
SELECT 'pre_transform' AS stage, {FIELDS_SQL} FROM checked
WHERE raw_0 AND raw_1 AND status_2 AND amount_4
UNION ALL
SELECT 'post_transform', {FIELDS_SQL} FROM checked WHERE raw_1 AND status_2 AND day_3"""
)
def validate_stages(spark: SparkSession, sf: str) -> DataFrame:
    df = records(spark, sf)
    parts = [
        drop_meta(accept(df, select_rules(RULES, stage))).withColumn("stage", F.lit(stage.value))
        for stage in (ValidationStage.PRE, ValidationStage.POST)
    ]
    return parts[0].unionByName(parts[1])


@query(
    f"""WITH {RECORDS_SQL}
SELECT event_id, concat_ws('; ',
         CASE WHEN NOT raw_0 THEN 'raw = ' || raw || ': not a whole number' END,
         CASE WHEN NOT raw_1 THEN 'raw = null: needed' END,
         CASE WHEN NOT status_2
              THEN 'status = ' || coalesce(status, 'null') || ': not among the values allowed' END,
         CASE WHEN NOT day_3 THEN 'day = ' || day || ': not a date of the pattern given' END,
         CASE WHEN NOT amount_4 THEN 'amount = ' || amount || ': not a number' END) AS messages
FROM checked"""
)
def reject_messages(spark: SparkSession, sf: str) -> DataFrame:
    told = with_messages(records(spark, sf), RULES)
    return told.select("event_id", F.concat_ws("; ", "_messages").alias("messages"))


FAILURES_SQL = """
failures AS (
  SELECT *, 'raw' AS field_validated, raw AS validated_data, 'is_integer' AS validated_name,
         'raw = ' || raw || ': not a whole number' AS failure_reason
  FROM checked WHERE NOT raw_0
  UNION ALL
  SELECT *, 'raw', raw, 'is_mandatory', 'raw = null: needed'
  FROM checked WHERE NOT raw_1
  UNION ALL
  SELECT *, 'status', status, 'is_enum',
         'status = ' || coalesce(status, 'null') || ': not among the values allowed'
  FROM checked WHERE NOT status_2
  UNION ALL
  SELECT *, 'day', day, 'is_valid_date', 'day = ' || day || ': not a date of the pattern given'
  FROM checked WHERE NOT day_3
  UNION ALL
  SELECT *, 'amount', amount, 'is_float', 'amount = ' || amount || ': not a number'
  FROM checked WHERE NOT amount_4)"""


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return reject_summary(
        records(spark, sf),
        RULES,
        pipeline="events",
        stage=ValidationStage.BOTH,
        at=F.col("ts"),
        file_name=F.lit("events.parquet"),
    )


@query(
    f"""WITH {RECORDS_SQL}, {FAILURES_SQL}
SELECT 'events.parquet' AS source_file_name, 'events' AS pipeline_name, field_validated,
       'event_id,user_id' AS record_id_key, event_id || ',' || user_id AS record_id_value,
       validated_data, 'both' AS validated_type, validated_name, failure_reason,
       ts AS validation_timestamp, strftime(ts, '%Y-%m') AS validation_yr_month
FROM failures"""
)
def reject_summary_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf)


@query(
    f"""WITH {RECORDS_SQL}, {FAILURES_SQL}
SELECT field_validated, validated_name, CAST(count(*) AS BIGINT) AS failures
FROM failures GROUP BY field_validated, validated_name"""
)
def reject_summary_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return failure_counts(records(spark, sf), RULES)


@query(
    f"""WITH {RECORDS_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE NOT {ALL_OK_SQL}) AS rejected FROM checked"""
)
def reject_rate(spark: SparkSession, sf: str) -> DataFrame:
    return reject_counts(records(spark, sf), RULES)


@query(
    f"""WITH {RECORDS_SQL}
SELECT count(*) AS total,
       count(*) FILTER (WHERE NOT (raw_0 AND raw_1 AND status_2 AND amount_4 AND day_3)) AS rejected
FROM checked"""
)
def reject_limit_two_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of both stages among the records that the first has read."""
    before, after = (select_rules(RULES, s) for s in (ValidationStage.PRE, ValidationStage.POST))
    rows = records(spark, sf)
    carried = check_reject_limit(rows, before, limit=1.0)
    left = drop_meta(accept(rows, before))
    rejected, total = check_reject_limit(left, after, limit=1.0, carried=carried)
    return spark.range(1).select(F.lit(total).cast("bigint").alias("total"), F.lit(rejected).cast("bigint").alias("rejected"))


@query(
    f"""WITH {RECORDS_SQL}, {FAILURES_SQL},
summary AS (SELECT 'both' AS validated_type, field_validated, validated_name,
                   strftime(ts, '%Y-%m') AS validation_yr_month FROM failures)
SELECT validated_type, field_validated, validated_name, validation_yr_month,
       CAST(grouping(validated_type) AS VARCHAR) || grouping(field_validated) || grouping(validated_name)
       || grouping(validation_yr_month) AS level, count(*) AS failures
FROM summary GROUP BY GROUPING SETS (
  (validated_type, field_validated, validated_name, validation_yr_month), (validated_type, validation_yr_month),
  (field_validated, validated_name), (validated_type), ())"""
)
def reject_summary_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Failures by stage, field, rule and month, and their totals at four levels."""
    levels = (LEVELS, ("validated_type", "validation_yr_month"), ("field_validated", "validated_name"), ("validated_type",), ())
    return reject_cube(_summary(spark, sf), levels)
