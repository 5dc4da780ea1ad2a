"""Passages of whole words that occur more than once, found by FM-indexes of the shards of a corpus."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import coded_words, free_name, in_parts, kept
from rulestream.llm.fm_index import FMIndex

#: Words whose hash may choose the shard of a window.
GRAM = 8
#: Windows of a stretch at most.
STRETCH = 64
#: Stretches of one shard, on average.
SHARD = 20_000
#: Stretches of a key beyond which its windows are compared one by one.
HOT = 2_000


def ascii_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words between ASCII white space: the distinct ones, the number of each word's, words per text."""
    return coded_words(texts, pc.ascii_split_whitespace)


def windowed_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each value and the ``width - 1`` that follow; fewer at the end."""
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least, np.concatenate([least[span:], least[len(least) - span :]])) if len(least) > span else least
        span *= 2
    rest = width - span
    return np.minimum(least, np.concatenate([least[rest:], least[len(least) - rest :]])) if 0 < rest < len(least) else least


def word_hashes(distinct: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))


def stretches(texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that follow each other and have the same key: text, first window, windows, key, how often the key occurs.

    The key of a window is the smallest hash of the ``GRAM`` words in a row within it, so that equal windows have equal keys, and a run
    has some ten windows. Every window lies in one run. Where two windows of a run are equal, its key occurs at two places.
    """
    distinct, codes, counts = ascii_words(texts)
    ends = np.cumsum(counts)
    begins = ends - counts
    text = np.repeat(np.arange(len(counts)), counts)
    gram = min(GRAM, window)
    with np.errstate(over="ignore"):
        hashes = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
        rolled = np.zeros(len(codes), dtype=np.uint64)
        for step in range(gram):
            inside = max(0, len(codes) - step)
            rolled[:inside] = rolled[:inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[step:]
        rolled ^= rolled >> np.uint64(31)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(29)
    keys = windowed_minimum(rolled, window - gram + 1)
    at = np.flatnonzero(np.arange(len(codes)) + window <= ends[text])
    new = np.ones(len(at), dtype=bool)
    new[1:] = (text[at[1:]] != text[at[:-1]]) | (keys[at[1:]] != keys[at[:-1]])
    place = np.arange(len(at))
    new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % STRETCH == 0
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(at)))
    own = at[first]
    grams = many + window - gram
    upto = np.cumsum(grams)
    places = np.repeat(own - (upto - grams), grams) + np.arange(upto[-1] if len(upto) else 0)
    same = np.concatenate([[0], np.cumsum(rolled[places] == np.repeat(keys[own], grams))])
    return text[own], own - begins[text[own]], many, keys[own].view(np.int64), same[upto] - same[upto - grams]


def digest(text: Column) -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def without_repeats(docs: DataFrame, window: int = 35, *, text: str = "text") -> DataFrame:
    """The frame without its text, with ``n_words``, ``n_removed``, ``kept`` and its digest ``kept_sha256``.

    Words are what stands between ASCII white space, unchanged. A word goes if it lies in ``window`` consecutive words that also start
    anywhere else in any text, the same one included; this is judged on the texts as they come. ``kept`` holds the other words, joined by one
    space. A null or empty text has no words, and equal texts of so many words lose all of them. Columns of these names are replaced; ids
    play no part, so null or repeated ones are borne.

    Equal texts are one text with a number of copies. A window belongs to the shard of its smallest hash of eight words in a row; runs of windows with the
    same one travel together. Only keys that occur more than once travel at all. Each shard has an FM-index of its stretches, and their
    matching statistics against it give the intervals. A key with more than ``HOT`` stretches, such as that of the words with which a
    very common passage begins, has its windows told apart by a digest of 128 bits instead, which Spark counts.
    """
    names = ("n_words", "n_removed", "kept", "kept_sha256")
    rest = [c for c in docs.columns if c.lower() not in {text.lower(), *names}]
    one, two, null = (free_name(docs, n) for n in ("_first", "_second", "_null"))
    made = repeats_removed(docs.select(F.col(text).alias("text")), window).withColumnsRenamed({"first": one, "second": two})
    keyed = docs.select(*rest, *(d.alias(n) for d, n in zip(digest(F.col(text)), (one, two), strict=True)), F.col(text).isNull().alias(null))
    joined = keyed.withColumn(one, F.when(~F.col(null), F.col(one))).join(made, [one, two], "left")
    empty = {"n_words": F.lit(0), "n_removed": F.lit(0), "kept": F.lit(""), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return joined.select(*rest, *(F.coalesce(F.col(n), v).alias(n) for n, v in empty.items()))


def repeats_removed(texts: DataFrame, window: int) -> DataFrame:
    """One row per distinct text: two hashes ``first`` and ``second`` that stand for it, and what is left of it."""
    counted = texts.where("text IS NOT NULL").groupBy("text").agg(F.count("*").alias("copies"))
    own = kept(counted.withColumn("id", F.monotonically_increasing_id()), "texts")
    ranges = repeated_ranges(own, window).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    first, second = digest(F.col("text"))
    rows = own.join(ranges, "id", "left").select("text", first.alias("first"), second.alias("second"), "ranges")
    schema = "first BIGINT, second BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING, kept_sha256 STRING"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            distinct, codes, counts = ascii_words(batch.column("text"))
            begins = np.cumsum(counts) - counts
            ranges = batch.column("ranges")
            owner = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(ranges), 0).to_numpy(zero_copy_only=False))
            flat = ranges.flatten()
            change = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(change, begins[owner] + flat.field("start").to_numpy(), 1)
            np.add.at(change, begins[owner] + flat.field("stop").to_numpy(), -1)
            stays = np.cumsum(change[:-1]) == 0
            words = pa.array(distinct, type=pa.string()).take(pa.array(codes[stays]))
            left = np.concatenate([[0], np.cumsum(stays)])[np.append(begins, len(codes))]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, type=pa.int32()), words), " ")
            sums = [hashlib.sha256(value.encode()).hexdigest() for value in joined.to_pylist()]
            columns = [
                batch.column("first"),
                batch.column("second"),
                pa.array(counts.astype(np.int64)),
                pa.array(counts.astype(np.int64) - np.diff(left)),
                joined,
                pa.array(sums, type=pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["first", "second", "n_words", "n_removed", "kept", "kept_sha256"])

    return rows.mapInArrow(cut, schema)


def repeated_ranges(own: DataFrame, window: int) -> DataFrame:
    """Ranges of words, ``id``, ``start`` and ``stop``, that are covered by windows that occur more than once.

    ``own`` holds distinct texts with an ``id`` and their number of ``copies``, and is read twice.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            text, *found = stretches(batch.column("text"), window)
            columns = [batch.column("id").take(text), batch.column("copies").take(text), *map(pa.array, found)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "copies", "at", "many", "key", "places"])

    long_enough = own.where(F.length("text") >= 2 * window - 1)
    schema = "id BIGINT, copies BIGINT, at BIGINT, many BIGINT, key BIGINT, places BIGINT"
    runs = kept(long_enough.mapInArrow(spread, schema), "stretches")
    keys = runs.groupBy("key").agg(F.count("*").alias("rows"), F.sum(F.col("copies") * F.col("places")).alias("total")).where("total > 1")
    common = runs.join(keys.select("key", (F.col("rows") > HOT).alias("hot")), "key")
    wanted = common.groupBy("id").agg(F.collect_list(F.struct("at", "many", "key", "hot")).alias("runs"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches with their words; the windows of a hot key with a digest of theirs instead."""
        for batch in in_parts(batches, "text"):
            distinct, codes, counts = ascii_words(batch.column("text"))
            begins = np.cumsum(counts) - counts
            runs = batch.column("runs")
            owner = np.repeat(np.arange(len(batch)), np.diff(runs.offsets.to_numpy()))
            flat = runs.flatten()
            at, many, key = (flat.field(n).to_numpy() for n in ("at", "many", "key"))
            hot = flat.field("hot").to_numpy(zero_copy_only=False)
            words = pa.array(distinct, type=pa.string())

            cold = np.flatnonzero(~hot)
            length = many[cold] + window - 1
            joined = _joined(words, codes, begins[owner[cold]] + at[cold], length)
            yield _routed(batch, owner[cold], at[cold], many[cold], key[cold], None, joined)

            warm = np.flatnonzero(hot)
            own_of = np.repeat(warm, many[warm])
            start = at[own_of] + np.arange(len(own_of)) - np.repeat(np.cumsum(many[warm]) - many[warm], many[warm])
            hashes = word_hashes(distinct)[codes] if len(own_of) else np.zeros(0, dtype=np.uint64)
            raw, first = hashes.tobytes(), (begins[owner[own_of]] + start) * 8
            told = [xxhash.xxh3_128_digest(raw[f : f + 8 * window]) for f in first.tolist()]
            both = np.frombuffer(b"".join(told), dtype=np.int64).reshape(-1, 2)
            yield _routed(batch, owner[own_of], start, np.ones(len(start), dtype=np.int64), both[:, 0], both[:, 1], None)

    parts = "id BIGINT, copies BIGINT, at BIGINT, many BIGINT, key BIGINT, more BIGINT, words STRING"
    routed = kept(own.join(wanted, "id").select("id", "copies", "text", "runs").mapInArrow(gather, parts), "routed")
    cold = routed.where("words IS NOT NULL")
    shards = max(1, math.ceil(cold.count() / SHARD))

    def match(rows: pa.Table) -> pa.Table:
        coded = rows["words"].combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        copies = np.bincount(codes, rows["copies"].to_numpy(), len(coded.dictionary)).astype(np.int64)
        _, symbols, lengths = ascii_words(coded.dictionary)
        which, start, stop = FMIndex(symbols.astype(np.int64), lengths, copies).repeated(2, window)
        # the intervals of a distinct stretch, for every row that has it
        order = np.argsort(which, kind="stable")
        bounds = np.searchsorted(which[order], np.arange(len(copies) + 1))
        many = np.diff(bounds)[codes]
        row = np.repeat(np.arange(len(codes)), many)
        own_of = order[np.repeat(bounds[codes], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
        at = rows["at"].to_numpy()[row]
        return pa.table({"id": rows["id"].take(row), "start": at + start[own_of], "stop": at + stop[own_of]})

    by_shard = cold.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard")
    found = by_shard.applyInArrow(match, "id BIGINT, start BIGINT, stop BIGINT")
    warm = routed.where("words IS NULL")
    often = warm.groupBy("key", "more").agg(F.sum("copies").alias("total")).where("total > 1").select("key", "more")
    alike = warm.join(often, ["key", "more"], "left_semi").select("id", F.col("at").alias("start"), (F.col("at") + window).alias("stop"))
    return found.unionByName(alike)


def _joined(words: pa.Array, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> pa.Array:
    """Stretches of words, joined by spaces."""
    ends = np.cumsum(length)
    place = np.repeat(first - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    offsets = pa.array(np.concatenate([[0], ends]), type=pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(codes[place]))), " ")


def _routed(batch: pa.RecordBatch, owner, at, many, key, more, words) -> pa.RecordBatch:
    size = len(owner)
    columns = [
        batch.column("id").take(owner),
        batch.column("copies").take(owner),
        pa.array(at),
        pa.array(many),
        pa.array(key),
        pa.nulls(size, pa.int64()) if more is None else pa.array(more),
        pa.nulls(size, pa.string()) if words is None else words,
    ]
    return pa.RecordBatch.from_arrays(columns, names=["id", "copies", "at", "many", "key", "more", "words"])
