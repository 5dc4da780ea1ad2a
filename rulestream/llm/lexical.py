"""The best documents for each of a set of queries, by term weights, with buckets of documents of like length of their vectors."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulestream.llm.common import coded_words, free_name, in_parts, kept

#: Documents of a bucket.
BUCKET = 4096
#: Coordinates of a query by which the documents of a bucket are filtered.
FOCUS = 3
#: Share of the documents with the longest vectors, from which the first thresholds come.
HEAD = 0.02
#: Characters of the queries that are answered together. Their vocabulary and weights are broadcast.
BLOCK = 4 << 20
#: Room for rounding in bounds that are computed in doubles.
SLACK = 1e-9

#: Letters and digits of ASCII in lower case, and all that is not ASCII, as they are; the rest as a space.
AS_TERMS = bytes(
    ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)
) + bytes(range(0x80, 0x100))


def coded_terms(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Terms of texts: the distinct ones, the number of each term's, terms per text. A null has none."""
    full = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    offsets = np.frombuffer(full.buffers()[1], dtype=np.int64)[full.offset : full.offset + len(full) + 1]
    raw = full.buffers()[2]
    data = b"" if raw is None else raw.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes().translate(AS_TERMS)
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data)]
    return coded_words(pa.Array.from_buffers(pa.large_string(), len(full), buffers), pc.ascii_split_whitespace)


class Queries:
    """A block of queries: the terms of each with their number, over a vocabulary of the block."""

    def __init__(self, texts: dict[int, str]) -> None:
        self.keys, bodies = list(texts), pa.array(list(texts.values()), type=pa.large_string())
        distinct, codes, counts = coded_terms(bodies)
        self.vocabulary = {term: number for number, term in enumerate(distinct)}
        ends = np.cumsum(counts)
        self.terms = []
        for begin, end in zip(ends - counts, ends, strict=True):
            found = Counter(codes[begin:end].tolist())
            self.terms.append((np.array(list(found), dtype=np.int64), np.array(list(found.values()), dtype=np.int64)))


class Best:
    """The best documents of a query so far, in the order of falling scores, then of keys, nulls last."""

    def __init__(self, many: int, least: int) -> None:
        self.many, self.rows, self.least = many, [], least

    def add(self, scores: np.ndarray, places: np.ndarray, keys: pa.Array) -> None:
        """Scores of documents of which none is below ``least``."""
        if len(scores) > self.many:
            enough = np.partition(scores, len(scores) - self.many)[len(scores) - self.many]
            chosen = scores >= enough
            scores, places = scores[chosen], places[chosen]
        taken = keys.take(pa.array(places)).to_pylist()
        rows = [(-s, k is None, k) for s, k in zip(scores.tolist(), taken, strict=True)]
        self.rows = heapq.nsmallest(self.many, [*self.rows, *rows], key=lambda r: (r[0], r[1], 0 if r[2] is None else r[2]))
        if len(self.rows) == self.many:
            self.least = max(self.least, -self.rows[-1][0])


def _column(term_rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    dense = np.zeros(size)
    dense[term_rows] = values
    return dense


def search_bucket(
    keys: pa.Array, norms: np.ndarray, offsets: np.ndarray, ids: np.ndarray, impacts: np.ndarray, queries: Queries, best: list[Best]
) -> None:
    """Compare a bucket of vectors with all queries.

    A query whose length times that of the longest vector is below its threshold has nothing to find here (Cauchy and Schwarz). For
    the others a vector can reach the threshold only if each of its coordinates, in parts of its length, lies within bounds that the
    query's own gives: with the cosine ``t`` that is needed and ``q`` of the query, within ``q t -+ sqrt((1 - t t) (1 - q q))``. What is
    left is scored exactly, in integers.
    """
    size = len(norms)
    longest = norms.max()
    order = np.argsort(ids, kind="stable")
    bounds = np.searchsorted(ids[order], np.arange(len(queries.vocabulary) + 1))
    rows, values = np.repeat(np.arange(size), np.diff(offsets))[order], impacts[order]
    columns: dict[int, np.ndarray] = {}
    for (terms, counts), own in zip(queries.terms, best, strict=True):
        length = math.sqrt(float((counts * counts).sum()))
        need = max(own.least, 1)
        if length * longest * (1 + SLACK) < need:
            continue
        stays = np.ones(size, dtype=bool)
        cosine = min(1.0, need / (length * longest))
        for place in np.argsort(-counts, kind="stable")[:FOCUS]:
            term, part = int(terms[place]), counts[place] / length
            if term not in columns:
                own_rows = slice(bounds[term], bounds[term + 1])
                columns[term] = _column(rows[own_rows], values[own_rows] / norms[rows[own_rows]], size)
            reach = math.sqrt(max(0.0, (1 - cosine * cosine) * (1 - part * part))) + SLACK
            stays &= columns[term] >= part * cosine - reach
            if part * cosine + reach < 1 and cosine > part:
                stays &= columns[term] <= part * cosine + reach
        if not stays.any():
            continue
        scores = np.zeros(size, dtype=np.int64)
        for term, count in zip(terms.tolist(), counts.tolist(), strict=True):
            scores[rows[bounds[term] : bounds[term + 1]]] += count * values[bounds[term] : bounds[term + 1]]
        found = np.flatnonzero(stays & (scores >= need))
        if len(found):
            own.add(scores[found], found, keys)


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    best: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_key``, ``rank``, ``key`` and ``score`` of the documents with the highest scores for each item; scores of 0 have no rank.

    A document is a vector of term weights times saturated term counts, an item one of term counts, over the vocabulary of the
    items, for other terms add nothing to any product. Vectors are sorted by their length over the whole table; the
    longest ones are searched first and give each item a threshold, with which the tasks of the others begin. Equal scores are ranked by
    key, null ones last, and repeated documents each have a rank. Items that are null, empty or without a document have no row; repeated items have the
    same rows each. Other columns are left out.

    Items are answered in blocks of ``BLOCK`` characters of distinct texts, with a pass over the documents for each. A block, its
    weights and its thresholds are what the driver holds; each task returns ``best`` rows per item.
    """
    lengths = F.length("text")
    texts = items.select(F.col(item_text).alias("text")).where(lengths > 0).distinct()
    texts = kept(texts.withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil((texts.agg(F.sum(lengths)).first()[0] or 0) / BLOCK))
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = None
    for number in range(blocks):
        block_rows = texts.where(block == number).collect()
        answered = kept(_answers(rows, Queries({r["query"]: r["text"] for r in block_rows}), best), "answers")
        found = answered if found is None else found.unionByName(answered)
    told = found.join(texts, "query").select("text", "rank", F.col("key").alias("_key"), "score")
    own = items.select(F.col(item_key).alias("_item"), F.col(item_text).alias("text"))
    return own.join(told, "text").select(F.col("_item").alias(item_key), "rank", F.col("_key").alias(key), "score")


def _answers(rows: DataFrame, queries: Queries, best: int) -> DataFrame:
    """``query``, ``rank``, ``key`` and ``score`` for one block of queries."""
    spark = rows.sparkSession
    kind = rows.schema["key"].dataType.simpleString()
    known = spark.sparkContext.broadcast(queries.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33  # rows of one length are dealt out by these numbers
        for batch in in_parts(batches, "text"):
            distinct, codes, counts = coded_terms(batch.column("text"))
            numbers = np.fromiter((known.value.get(t, -1) for t in distinct), dtype=np.int64, count=len(distinct))[codes]
            row = np.repeat(np.arange(len(counts)), counts)[numbers >= 0]
            pairs, often = np.unique(row * len(known.value) + numbers[numbers >= 0], return_counts=True)
            owner, ids = np.divmod(pairs, max(1, len(known.value)))
            ends = pa.array(np.searchsorted(owner, np.arange(len(batch) + 1)), type=pa.int32())
            columns = [
                batch.column("key"),
                pa.array(base + np.arange(len(batch))),
                pa.array(counts.astype(np.int64)),
                pa.ListArray.from_arrays(ends, pa.array(ids, type=pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(often)),
            ]
            base += len(batch)
            yield pa.RecordBatch.from_arrays(columns, names=["key", "row", "n", "ids", "often"])

    counted = kept(rows.mapInArrow(count, f"key {kind}, row BIGINT, n BIGINT, ids ARRAY<INT>, often ARRAY<BIGINT>"), "terms")
    many, total = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(queries.vocabulary), dtype=np.int64)
    for term, holding in counted.select(F.explode("ids").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = math.floor(1000 * math.log((2 * many + 2) / (2 * holding + 1)))
    weighed = spark.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.diff(lists.offsets.to_numpy())
            ids, often = lists.flatten().to_numpy(), batch.column("often").flatten().to_numpy()
            share = 25 + (75 * batch.column("n").to_numpy() * many) // total
            impacts = weighed.value[ids] * ((1_000_000_000 * often) // (1000 * often + 8 * np.repeat(share, sizes)))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            offsets = pa.array(ends, type=pa.int32())
            # no list is empty
            norms = np.sqrt(np.add.reduceat(impacts.astype(np.float64) ** 2, ends[:-1])) if len(batch) else np.zeros(0)
            columns = [
                batch.column("key"),
                batch.column("row"),
                pa.array(norms),
                pa.ListArray.from_arrays(offsets, pa.array(ids)),
                pa.ListArray.from_arrays(offsets, pa.array(impacts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "row", "norm", "ids", "impacts"])

    schema = f"key {kind}, row BIGINT, norm DOUBLE, ids ARRAY<INT>, impacts ARRAY<BIGINT>"
    vectors = counted.where(F.size("ids") > 0).mapInArrow(weigh, schema).where("norm > 0")
    ordered = vectors.repartitionByRange(F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row")
    vectors = kept(ordered, "vectors")
    asked = spark.sparkContext.broadcast(queries)

    def search(part: DataFrame, least: list[int]) -> DataFrame:
        begin = spark.sparkContext.broadcast(least)

        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [Best(best, floor) for floor in begin.value]
            for batch in batches:
                for at in range(0, len(batch), BUCKET):
                    bucket = batch.slice(at, BUCKET)
                    lists = bucket.column("ids")
                    offsets = lists.offsets.to_numpy()
                    norms = bucket.column("norm").to_numpy()
                    impacts = bucket.column("impacts").flatten().to_numpy()
                    search_bucket(bucket.column("key"), norms, offsets, lists.flatten().to_numpy(), impacts, asked.value, own)
            for query, found in zip(asked.value.keys, own, strict=True):
                if found.rows:
                    scores, _, keys = zip(*found.rows, strict=True)
                    columns = [
                        pa.array([query] * len(keys)),
                        pa.array(keys, type=batch.column("key").type),
                        pa.array([-s for s in scores]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["query", "key", "score"])

        # the rows lie in files by length, and stay in their order within a file
        return part.select("key", "norm", "ids", "impacts").mapInArrow(go, f"query BIGINT, key {kind}, score BIGINT")

    def ranked(found: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key")))
        return found.withColumn("rank", place).where(F.col("rank") <= best)

    cut = vectors.agg(F.percentile_approx("norm", 1 - HEAD)).first()[0] or 0.0
    head = kept(ranked(search(vectors.where(F.col("norm") >= cut), [0] * len(queries.keys))), "head")
    tenth = {r["query"]: r["score"] for r in head.where(F.col("rank") == best).select("query", "score").toLocalIterator()}
    rest = search(vectors.where(F.col("norm") < cut), [tenth.get(k, 0) for k in queries.keys])
    return ranked(head.select("query", "key", "score").unionByName(rest)).select("query", "rank", "key", "score")
