"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.llm.common import literal_rows, ranked

#: Places on the ring. Keys and virtual nodes stand on places, virtual nodes of one place by shard.
PLACES = 1 << 16


def ring(spark: SparkSession, shards: int, virtual: int) -> list[tuple[int, int]]:
    """Shard and place of the virtual nodes, clockwise. Their number depends on the parameters alone."""
    nodes = spark.range(shards * virtual).select(
        (F.col("id") / virtual).cast("int").alias("shard"),
        F.pmod(F.xxhash64((F.col("id") / virtual).cast("int"), F.col("id") % virtual), F.lit(PLACES)).alias("place"),
    )
    rows = sorted(nodes.collect(), key=lambda node: (node.place, node.shard))
    return [(node.shard, node.place) for node in rows]


def quotas(rows: int, shards: int, load: float) -> list[int]:
    """The most rows of each shard: equal up to one row, ``load`` times the mean in all."""
    if load < 1:
        raise ValueError("load is below 1: the shards could not hold all rows")
    room = max(rows, int(rows * load))
    return [room // shards + (shard < room % shards) for shard in range(shards)]


def placement(owners: list[int], counts: list[int], room: list[int]) -> list[dict]:
    """Which shard takes which ranks of each arc, and from which slot on.

    Each shard first takes the rows of its own arcs, clockwise, while it has room. What is
    over goes on clockwise past full shards to the next virtual node whose shard has room,
    in the order in which it comes by.
    """
    left, pieces, over = list(room), [], []

    def take(arc: int, start: int, stop: int, shard: int) -> int:
        end = min(stop, start + left[shard])
        if end > start:
            used = room[shard] - left[shard]
            pieces.append({"_arc": arc, "_from": start, "_to": end, "shard": shard, "_slot": used})
            left[shard] -= end - start
        return end

    for arc, shard in enumerate(owners):
        over.append((take(arc, 0, counts[arc], shard), counts[arc]))
    carried: deque[tuple[int, int, int]] = deque()
    for lap in range(2):
        for arc, shard in enumerate(owners):
            while carried and left[shard]:
                origin, start, stop = carried.popleft()
                if (end := take(origin, start, stop, shard)) < stop:
                    carried.appendleft((origin, end, stop))
            if lap == 0 and over[arc][0] < over[arc][1]:
                carried.append((arc, *over[arc]))
    return pieces


def shard_documents(
    docs: DataFrame,
    shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    virtual: int = 64,
    load: float = 1.0,
) -> DataFrame:
    """Every row with its shard and its slot there: key, size, text_crc32, shard, slot.

    A key's home is the next virtual node clockwise of its hash. A shard holds at most
    ``load`` times the mean number of rows; rows that find it full continue clockwise, those
    with the highest hash of key and text first. With ``load`` 1 all shards are full and
    differ by one row at most; a higher load moves fewer rows when shards come or go.

    Size is the text's UTF-8 bytes plus 16 (a null text has none). Rows with a null key share
    one place and are spread like any hot key. Repeated rows are placed one by one. Only
    counts per arc reach the driver: shards times virtual nodes. Other columns are left out.
    """
    spark = docs.sparkSession
    nodes = ring(spark, shards, virtual)
    starts = [-1, *(place for _, place in nodes)]
    arcs = [
        {"_arc": arc, "_low": starts[arc] + 1, "_high": place} for arc, (_, place) in enumerate(nodes) if place > starts[arc]
    ]
    arcs.append({"_arc": 0, "_low": starts[-1] + 1, "_high": PLACES - 1})
    places = literal_rows(spark, arcs, "_arc INT, _low INT, _high INT").where("_low <= _high").select(
        "_arc", F.explode(F.sequence("_low", "_high")).alias("_place")
    )
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(PLACES)).cast("int").alias("_place"),
    ).join(F.broadcast(places), "_place")
    counts = {row["_arc"]: row["n"] for row in rows.groupBy("_arc").agg(F.count("*").alias("n")).collect()}
    room = quotas(sum(counts.values()), shards, load)
    pieces = placement([shard for shard, _ in nodes], [counts.get(arc, 0) for arc in range(len(nodes))], room)
    plan = literal_rows(spark, pieces, "_arc INT, _from BIGINT, _to BIGINT, shard INT, _slot BIGINT")
    tie = F.xxhash64(F.col("_key"), F.col("text_crc32"), F.col("size"), F.lit(1))
    placed = ranked(rows, "_arc", tie, "_rank").join(F.broadcast(plan), "_arc")
    return placed.where("_rank >= _from AND _rank < _to").select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"),
    )
