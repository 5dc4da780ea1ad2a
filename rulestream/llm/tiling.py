"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import coded_words

NOT_WORD = re.compile(r"\W+")
BASE = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1
TILES = "array<struct<doc_start: bigint, item_start: bigint, length: bigint>>"


def plain(word: str) -> str:
    """A word without case, punctuation and other marks; may be empty."""
    word = word.lower()
    return word if word.isalnum() else NOT_WORD.sub("", word)


def matches(doc: list[int], item: list[int], size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``size`` tokens: length, place in doc, place in item.

    Windows are compared by a running Karp-Rabin hash, and equal hashes token by token.
    Marked tokens are below zero and equal to none.
    """
    drop = pow(BASE, size, 1 << 64)

    def windows(tokens: list[int]) -> Iterator[tuple[int, int]]:
        value, run = 0, 0
        for at, token in enumerate(tokens):
            if token < 0:
                value, run = 0, 0
                continue
            value, run = (value * BASE + token + 1) & WRAP, run + 1
            if run > size:
                value = (value - (tokens[at - size] + 1) * drop) & WRAP
            if run >= size:
                yield value, at - size + 1

    places: dict[int, list[int]] = {}
    for value, at in windows(item):
        places.setdefault(value, []).append(at)
    found = []
    for value, at in windows(doc):
        for start in places.get(value, ()):
            if at and start and doc[at - 1] == item[start - 1] >= 0:
                continue  # the run began earlier
            length = 0
            while at + length < len(doc) and start + length < len(item) and doc[at + length] == item[start + length] >= 0:
                length += 1
            if length >= size:
                found.append((length, at, start))
    return found


def tiles(doc: list[int], item: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in doc, place in item, length): the longest unmarked match again and again."""
    doc, item, size, out = list(doc), list(item), len(item), []
    while size >= shortest:
        found = matches(doc, item, size)
        if not found:
            if size == shortest:
                break
            size = max(shortest, size // 2)
            continue
        longest = max(found)[0]
        for length, at, start in found:
            if length == longest and min(doc[at : at + length]) >= 0 and min(item[start : start + length]) >= 0:
                out.append((at, start, length))
                doc[at : at + length] = [-1] * length
                item[start : start + length] = [-1] * length
    return out


def seeds_of(items: list[tuple[str, str]], shortest: int) -> list[Seeds]:
    """The seeds of a block of items: windows of ``shortest`` words, and each shorter item as one window."""
    by_size: dict[int, list[tuple[str, list[str]]]] = {}
    for key, text in items:
        words = [word for word in map(plain, text.split()) if word]
        if words:
            by_size.setdefault(min(shortest, len(words)), []).append((key, words))
    return [Seeds(own, size) for size, own in sorted(by_size.items())]


class Seeds:
    """All windows of ``shortest`` tokens of benchmark items, to be found in documents."""

    def __init__(self, items: list[tuple[str, list[str]]], shortest: int) -> None:
        self.shortest, self.ids, self.items = shortest, [], []
        self.vocabulary: dict[str, int] = {}
        hashes, owners, places = [], [], []
        for key, words in items:
            tokens = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
            value = self.hashed(np.array(tokens), np.arange(len(tokens) - shortest + 1))
            hashes.append(value)
            owners.append(np.full(len(value), len(self.items)))
            places.append(np.arange(len(value)))
            self.ids.append(key)
            self.items.append(tokens)
        self.hashes, self.owners, self.places = (
            np.concatenate([np.empty(0, dtype=kind), *part])
            for kind, part in (("u8", hashes), ("i8", owners), ("i8", places))
        )
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owners, self.places = self.hashes[order], self.owners[order], self.places[order]

    def hashed(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), dtype=np.uint64)
        for step in range(self.shortest):
            value = value * np.uint64(BASE) + tokens[at + step].astype(np.uint64) + np.uint64(1)
        return value

    def code(self, word: str) -> int:
        """The token of a word: -1 outside the benchmark's vocabulary, -2 for none at all."""
        word = plain(word)
        return self.vocabulary.get(word, -1) if word else -2

    def search(self, texts: pa.Array, threshold: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """Row, item number and tiles of the pairs whose tiles cover the share of the item."""
        distinct, codes, counts = coded_words(texts)
        tokens = np.fromiter(map(self.code, distinct), dtype=np.int64, count=len(distinct))[codes]
        row = np.repeat(np.arange(len(counts)), counts)[tokens > -2]
        tokens, size = tokens[tokens > -2], self.shortest
        if len(tokens) < size or not len(self.hashes):
            return
        outside = np.r_[0, np.cumsum(tokens < 0)]
        last = len(tokens) - size + 1
        at = np.flatnonzero((row[:last] == row[size - 1 :]) & (outside[size:] == outside[:last]))
        value = self.hashed(tokens, at)
        low, high = np.searchsorted(self.hashes, value), np.searchsorted(self.hashes, value, side="right")
        hits = high - low
        if not hits.any():
            return
        at = np.repeat(at, hits)
        seed = np.arange(len(at)) + np.repeat(low - (np.cumsum(hits) - hits), hits)
        item = self.owners[seed]
        order = np.lexsort((at, item, row[at]))
        at, seed, item = at[order], seed[order], item[order]
        begins = np.flatnonzero(np.r_[True, (row[at][1:] != row[at][:-1]) | (item[1:] != item[:-1])])
        starts = np.r_[0, np.cumsum(np.bincount(row, minlength=len(counts)))]
        for begin, end in zip(begins, [*begins[1:], len(at)], strict=True):
            own = self.items[item[begin]]
            need = threshold * len(own)
            window = np.arange(size)
            if len(np.unique(self.places[seed[begin:end]][:, None] + window)) < need:
                continue  # all matches together cover too little
            shared = np.unique(at[begin:end][:, None] + window)
            gaps = np.flatnonzero(np.diff(shared) > 1) + 1
            doc = np.insert(tokens[shared], gaps, -1)
            where = np.insert(shared, gaps, -1) - starts[row[at[begin]]]
            marked = tiles(doc.tolist(), own, size)
            if sum(length for _, _, length in marked) >= need:
                yield int(row[at[begin]]), int(item[begin]), [(int(where[d]), i, n) for d, i, n in marked]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    shortest: int = 5,
    threshold: float = 0.6,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block: int = 4_000_000,
) -> DataFrame:
    """Documents that hold much of a benchmark item, in whatever order: key, item key, coverage, tiles.

    Words are compared without case and punctuation. Seeds of ``shortest`` words shared with an item
    choose the pairs; greedy string tiling then covers them with non-overlapping common runs of that
    length or more. A pair is returned if its tiles cover ``threshold`` of the item's words.
    A shorter item is found where its words stand together, as a seed of its own length; items without words and null
    texts match nothing. Repeated rows and repeated items give a row each; items of one text are searched once. Every block of
    ``block`` characters of distinct items makes one pass over the documents, so what is broadcast stays bounded however large
    the benchmark is; documents are not shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_key).alias("_item"), F.sha2(F.col(item_text), 256).alias("_digest"))
    distinct = benchmark.select(F.sha2(F.col(item_text), 256).alias("_digest"), F.col(item_text).alias("_text")).dropna().dropDuplicates(["_digest"])
    size = distinct.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _found STRING, item_words BIGINT, coverage DOUBLE, tiles {TILES}"

    def pairs(number: int) -> DataFrame:
        own = distinct.where(F.pmod(F.xxhash64("_digest"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(seeds_of([tuple(x) for x in own], shortest))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, seeds in ((b, s) for b in batches for s in shared.value):
                found = list(seeds.search(batch.column(text), threshold))
                sizes = [len(seeds.items[item]) for _, item, _ in found]
                covered = [sum(n for _, _, n in marked) for _, _, marked in found]
                names = ("doc_start", "item_start", "length")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array([r for r, _, _ in found], type=pa.int64())),
                        pa.array([seeds.ids[item] for _, item, _ in found], type=pa.string()),
                        pa.array(sizes, type=pa.int64()),
                        pa.array([a / b for a, b in zip(covered, sizes, strict=True)], type=pa.float64()),
                        pa.array(
                            [[dict(zip(names, tile, strict=True)) for tile in marked] for _, _, marked in found],
                            type=pa.list_(pa.struct([(name, pa.int64()) for name in names])),
                        ),
                    ],
                    names=["_key", "_found", "item_words", "coverage", "tiles"],
                )

        return docs.select(key, text).mapInArrow(search, schema)

    every = reduce(DataFrame.unionAll, map(pairs, range(blocks)))
    return every.join(items, every["_found"] == items["_digest"]).select(
        F.col("_key").alias(key), F.col("_item").alias(item_key), "item_words", "coverage", "tiles"
    )
