"""Steps, joins, mappings, keys, latest rows and routing."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rulestream.functions.keys import composite_key, key_part
from rulestream.functions.routing import Balance, route_by_status
from rulestream.operators import joins, transform
from rulestream.plans.spec import ColumnMapping, JoinKind, SourceQuery, SqlStep, StepKind


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def towns(spark):
    return spark.createDataFrame(
        [("FR", "Lyon", 5), ("FR", "Nice", 3), ("PE", "Cusco", 4), ("XX", "Atlantis", 0)],
        "code string, town string, size int",
    )


@pytest.fixture
def lands(spark):
    data = [("FR", "France"), ("PE", "Peru"), ("IS", "Iceland")]
    return spark.createDataFrame(data, "code string, land string")


def test_later_steps_read_earlier_views(spark, towns, lands):
    towns.createOrReplaceTempView("towns")
    lands.createOrReplaceTempView("lands")
    steps = [
        SqlStep(
            2, "SELECT town, l.name FROM towns t JOIN named l ON t.code = l.code", "town_lands"
        ),
        SqlStep(1, "SELECT code, land AS name FROM lands", "named"),
    ]
    last = transform.run_steps(spark, steps)
    assert last.columns == ["town", "name"]
    assert rows(spark.table("town_lands"), "town") == [
        ("Cusco", "Peru"),
        ("Lyon", "France"),
        ("Nice", "France"),
    ]


def test_no_steps_give_none(spark):
    assert transform.run_steps(spark, []) is None


def test_table_steps_use_the_reader(spark, lands):
    asked = []

    def reader(session, name):
        asked.append(name)
        return lands

    transform.run_steps(spark, [SqlStep(1, "db.lands", "read_lands", StepKind.TABLE)], reader)
    assert asked == ["db.lands"]
    assert spark.table("read_lands").count() == 3


def test_source_query_with_and_without_join(spark, towns, lands):
    towns.createOrReplaceTempView("towns")
    lands.createOrReplaceTempView("lands")
    left = SourceQuery("SELECT code, town FROM towns", JoinKind.LEFT, ("code",))
    assert rows(transform.run_source_query(spark, left, lands), "town")[0] == (
        "XX",
        "Atlantis",
        None,
    )
    own = SourceQuery("SELECT t.town, l.land FROM towns t JOIN lands l ON t.code = l.code")
    assert transform.run_source_query(spark, own, lands.limit(0)).count() == 3
    assert transform.run_source_query(spark, own, None).count() == 3


def test_join_without_reference_is_an_error(spark):
    with pytest.raises(ValueError, match="Join type specified, but no reference data"):
        transform.run_source_query(spark, SourceQuery("SELECT 1", JoinKind.LEFT, ("a",)), None)


def test_dotted_column_survives_a_join(spark, lands):
    dotted = spark.createDataFrame([("FR", 1), ("ZZ", 2)], ["code", "load.day"])
    for kind in (JoinKind.LEFT, JoinKind.RIGHT):
        joined = joins.join_reference(dotted, lands, ["code"], kind)
        assert joined.columns == ["code", "load.day", "land"]
        joined.collect()


def test_right_join_equals_the_built_in_one(spark):
    left = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (None, "n"), (7, "x")], "k int, v string"
    )
    right = spark.createDataFrame(
        [(1, "p"), (1, "q"), (3, "r"), (None, "m")], "k int, v string"
    )
    ours = joins.join_reference(left, right, ["k"], JoinKind.RIGHT)
    built_in = left.join(right, ["k"], "right")
    assert ours.columns == built_in.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, built_in.collect()))


def test_union_by_name(spark, towns, lands):
    both = joins.join_reference(towns, lands, [], JoinKind.UNION)
    assert both.columns == ["code", "town", "size", "land"]
    assert both.count() == 7


def test_join_needs_a_key(towns, lands):
    with pytest.raises(ValueError):
        joins.join_reference(towns, lands, [], JoinKind.LEFT)


def test_lookup_without_keys_finds_nothing(towns, lands):
    assert joins.lookup_semi(lands, towns.limit(0), ["code"]).count() == 0
    found = joins.lookup_semi(lands, towns, ["code"], ["land"])
    assert rows(found, "land") == [("France",), ("Peru",)]


@pytest.mark.parametrize(
    "value, kind, target, rule, expected",
    [
        ("12", "string", "integer", "passthrough", 12),
        (12, "int", "string", "Passthrough", "12"),
        ("2023-05-06", "string", "date", "passthrough", dt.date(2023, 5, 6)),
        ("06/05/23", "string", "date", "to_date(src, 'dd/MM/yy')", dt.date(2023, 5, 6)),
        ("any", "string", "string", "stream_process_name", "demo"),
        ("x", "string", "integer", "passthrough", None),
        ("1.23455", "string", "decimal(23,4)", "passthrough", Decimal("1.2346")),
        ("99999", "string", "decimal(6,4)", "passthrough", None),
    ],
)
def test_mapping_rules(spark, value, kind, target, rule, expected):
    df = spark.createDataFrame([(value,)], f"src {kind}")
    mapping = ColumnMapping(0, "src", "out", target, rule)
    out = transform.apply_mapping(df, [mapping], "demo")
    assert out.dtypes == [("out", "int" if target == "integer" else target)]
    assert out.first()["out"] == expected


def test_strict_mapping_raises(spark):
    df = spark.createDataFrame([("x",)], "src string")
    out = transform.apply_mapping(df, [ColumnMapping(0, "src", "out", "int")], "d", strict=True)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        out.collect()


def test_mappings_see_the_input_and_not_each_other(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    swap = [ColumnMapping(2, "x", "y", "string"), ColumnMapping(1, "y", "x", "string")]
    out = transform.apply_mapping(df, swap, "demo")
    assert out.columns == ["x", "y"]
    assert rows(out) == [("b", "a")]


def test_one_timestamp_for_all_rows(spark):
    df = spark.range(1000).repartition(4)
    out = transform.apply_mapping(
        df, [ColumnMapping(1, "", "at", "timestamp", "current_timestamp()")], "demo"
    )
    assert out.distinct().count() == 1


def test_latest_row_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 9), ("b", 0, 1), (None, 5, 5)],
        "k string, t int, seq int",
    )
    latest = transform.latest_per_key(df, ["k"], ["t"], ["seq"])
    assert rows(latest, "k") == [(None, 5, 5), ("a", 2, 3), ("b", 0, 1)]
    with pytest.raises(ValueError, match="tie-break"):
        transform.latest_per_key(df, ["k"], ["t"], [])


def test_latest_row_of_rows_with_a_map_or_an_odd_name(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, None), ("a", 2, 2, "z"), ("b", 1, 1, "w")],
        ["k", "T", "seq.no", "v"],
    )
    plain = transform.latest_per_key(df, ["K"], ["t"], ["seq.no"])
    assert plain.columns == df.columns
    assert rows(plain, "k") == [("a", 2, 2, "z"), ("b", 1, 1, "w")]
    mapped = df.withColumn("m", F.create_map("k", "v")).withColumnRenamed("seq.no", "seq")
    latest = transform.latest_per_key(mapped, ["k"], ["T"], ["seq"])
    assert rows(latest, "k") == [("a", 2, 2, "z", {"a": "z"}), ("b", 1, 1, "w", {"b": "w"})]


def test_latest_per_status_keeps_both(spark):
    df = spark.createDataFrame(
        [("a", "P", 1, 10), ("a", "S", 2, 20), ("a", "P", 3, 30), ("b", "S", 1, 40)],
        "k string, s string, t int, v int",
    )
    both = transform.latest_per_status(df, ["k"], "s", ["P", "S"], ["t"], ["v"])
    assert rows(both, "k") == [("a", 30, 20), ("b", None, 40)]


def test_composite_key_and_its_parts(spark):
    data = [("1", "2", True), ("1", None, True), ("1", "2", False)]
    df = spark.createDataFrame(data, "a string, b string, ok boolean")
    keyed = df.select(composite_key("P", ["a", "b"], only_if=F.col("ok")).alias("key"))
    assert [r.key for r in keyed.collect()] == ["P^1^2", None, None]
    parts = keyed.limit(1).select(key_part("key", -2).alias("x"), key_part("key", -1).alias("y"))
    assert rows(parts) == [("1", "2")]


# status, newer_only, message day -> ledger (amount, seq, day), shadow (amount, seq, day)
NEW, LEDGER, SHADOW = (5, "n"), (1, "l"), (2, "s")


@pytest.mark.parametrize(
    "status, guard, day, ledger, shadow",
    [
        ("POSTED", False, 9, (*NEW, 9), (*SHADOW, 4)),
        ("SHADOW", False, 9, (*LEDGER, 4), (*NEW, 9)),
        ("OTHER", False, 9, (*LEDGER, 4), (5, "s", 4)),
        (None, False, 9, (*LEDGER, 4), (5, "s", 4)),
        ("POSTED", False, 1, (*NEW, 1), (*SHADOW, 4)),
        ("POSTED", True, 1, (*LEDGER, 4), (*SHADOW, 4)),
        ("POSTED", True, 4, (*LEDGER, 4), (*SHADOW, 4)),
        ("POSTED", True, 9, (*NEW, 9), (*SHADOW, 4)),
        ("SHADOW", True, 9, (*LEDGER, 4), (*NEW, 9)),
        (None, True, 1, (*LEDGER, 4), (*SHADOW, 4)),
    ],
)
def test_routing(spark, status, guard, day, ledger, shadow):
    df = spark.createDataFrame(
        [(status, 5, "n", day, 1, "l", 4, 2, "s", 4)],
        "st string, a int, q string, d int, la int, lq string, ld int, sa int, sq string, sd int",
    )
    new_ledger, new_shadow = route_by_status(
        F.col("st"),
        Balance(F.col("a"), F.col("q"), F.col("d")),
        Balance(F.col("la"), F.col("lq"), F.col("ld")),
        Balance(F.col("sa"), F.col("sq"), F.col("sd")),
        newer_only=guard,
    )
    out = df.select(*(c for b in (new_ledger, new_shadow) for c in (b.amount, b.seq, b.at)))
    assert tuple(out.first()) == (*ledger, *shadow)


def test_unmatched_account_takes_the_message(spark):
    df = spark.createDataFrame(
        [("POSTED", 5, "n", 9)], "st string, a int, q string, d int"
    ).select("*", *(F.lit(None).cast("int").alias(c) for c in ("oa", "oq", "od")))
    old = Balance(F.col("oa"), F.col("oq").cast("string"), F.col("od"))
    new = Balance(F.col("a"), F.col("q"), F.col("d"))
    ledger, shadow = route_by_status(F.col("st"), new, old, old, newer_only=True)
    out = df.select(ledger.amount, shadow.amount).first()
    assert tuple(out) == (5, None)
