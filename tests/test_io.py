"""Options reach the readers and writers unchanged. No server is needed for that."""

from __future__ import annotations

from unittest import mock

import pytest
from pyspark.sql import functions as F

from rulestream.sources import readers, sinks
from rulestream.sources.connector_table import ConnectorTable


def stub():
    """Stands in for a session: every reader call returns the same reader."""
    session = mock.MagicMock()
    for reader in (session.read, session.readStream):
        for name in ("format", "options", "schema"):
            getattr(reader, name).return_value = reader
    return session


def test_topic_options_are_applied_last():
    session = stub()
    readers.read_topic(
        session,
        "host:1",
        "orders",
        '{"orders":{"0":5}}',
        {"maxOffsetsPerTrigger": "1000", "startingOffsets": "latest"},
    )
    session.readStream.format.assert_called_once_with("kafka")
    session.readStream.options.assert_called_once_with(
        **{
            "subscribe": "orders",
            "kafka.bootstrap.servers": "host:1",
            "startingOffsets": "latest",
            "maxOffsetsPerTrigger": "1000",
        }
    )
    session.readStream.load.assert_called_once_with()


def test_topic_starts_where_the_ledger_says():
    session = stub()
    readers.read_topic(session, "host:1", "orders", '{"orders":{"0":5}}')
    options = session.readStream.options.call_args.kwargs
    assert options["startingOffsets"] == '{"orders":{"0":5}}'


def test_table_through_a_connector():
    session = stub()
    readers.read_table(session, "store", {"table": "t", "url": "u"}, ["a", "b"])
    session.read.format.assert_called_once_with("store")
    session.read.options.assert_called_once_with(table="t", url="u")
    session.read.load.return_value.select.assert_called_once_with("a", "b")


def test_jdbc_in_one_and_in_many_parts():
    session = stub()
    readers.read_jdbc(session, "jdbc:x", "(SELECT 1) q", {"driver": "d"})
    session.read.options.assert_called_once_with(url="jdbc:x", dbtable="(SELECT 1) q", driver="d")
    session = stub()
    readers.read_jdbc(session, "jdbc:x", "t", split=("id", 0, 1000, 8))
    session.read.options.assert_called_once_with(
        url="jdbc:x",
        dbtable="t",
        partitionColumn="id",
        lowerBound="0",
        upperBound="1000",
        numPartitions="8",
    )


def written_with(writer):
    frame = mock.MagicMock()
    frame.columns = ["key", "offset", "value"]
    chain = frame.write
    frame.select.return_value = frame
    for name in ("format", "options", "mode"):
        getattr(chain, name).return_value = chain
    writer(frame)
    return frame


def test_append():
    frame = written_with(lambda f: sinks.append(f, "store", {"table": "t"}))
    frame.write.format.assert_called_once_with("store")
    frame.write.options.assert_called_once_with(table="t")
    frame.write.mode.assert_called_once_with("append")
    frame.write.save.assert_called_once_with()
    frame = written_with(lambda f: sinks.append_jdbc(f, "jdbc:x", "t", {"user": "u"}))
    frame.write.format.assert_called_once_with("jdbc")
    frame.write.options.assert_called_once_with(url="jdbc:x", dbtable="t", user="u")
    frame = written_with(lambda f: sinks.ConnectorSink("store", {"table": "t"}).write(f, 3))
    frame.write.mode.assert_called_once_with("append")


def test_topic_write():
    frame = written_with(lambda f: sinks.write_topic(f, "host:1", "dead", {"x": "y"}))
    frame.select.assert_called_once_with("key", "value")
    frame.write.options.assert_called_once_with(
        **{"kafka.bootstrap.servers": "host:1", "topic": "dead", "x": "y"}
    )


def test_appending_files(spark, folder):
    sink = sinks.ConnectorSink("parquet", {"path": f"{folder}/out"})
    for batch in range(2):
        sink.write(spark.range(3), batch)
    assert readers.read_table(spark, "parquet", path=f"{folder}/out").count() == 6


def test_table_behind_a_connector(spark, folder):
    table = ConnectorTable("parquet", ("k",), {"path": f"{folder}/store"})
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    table.merge(rows, 0)
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    assert [tuple(r) for r in table.lookup(keys).collect()] == [(2, "b")]
    assert table.lookup(keys, columns=["v"]).columns == ["v"]
    assert table.current(spark).count() == 3
    plan = table.lookup(keys)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,2)" in plan and "LessThanOrEqual(k,9)" in plan
    assert table.lookup(keys.limit(0)).collect() == []
    with pytest.raises(Exception, match="more than once"):
        table.merge(rows.union(rows), 1)


def test_csv_with_a_header(spark, folder):
    df = spark.createDataFrame([(1, "a,b"), (2, 'c"d')], "id int, t string")
    df.write.option("header", "true").csv(f"{folder}/csv")
    back = readers.read_csv(spark, f"{folder}/csv", df.schema, {"escape": "\\"})
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())


def test_stream_reader(spark, folder):
    spark.range(5).write.parquet(f"{folder}/in")
    stream = readers.read_stream(
        spark, "parquet", {"maxFilesPerTrigger": "1"}, "id bigint", f"{folder}/in"
    )
    assert stream.isStreaming
    assert stream.select(F.col("id")).columns == ["id"]
