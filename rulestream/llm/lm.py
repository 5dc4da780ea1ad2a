"""Scores of documents by the masked pseudo-likelihood of a small bidirectional network."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import coded_words, kept, literal_rows

#: Words to the left and right from which a word is predicted.
REACH = (-2, -1, 1, 2)
#: Least classes of the output, with as many numbers in each: a number has the chance of its class times that within it.
CLASSES = 32
SIZE = CLASSES * CLASSES
WIDTH = 16
#: Power of the number of distinct words by which the classes grow: a word costs as much as there are classes.
GROWTH = 0.23
#: Words that are scored together.
BATCH = 8192


@dataclass
class Network:
    """Embeddings of the words at each place of the window, one hidden layer, and a two-level output."""

    embed: np.ndarray
    hidden: np.ndarray
    by_class: np.ndarray
    class_bias: np.ndarray
    by_word: np.ndarray
    word_bias: np.ndarray

    @staticmethod
    def shapes(side: int) -> tuple[tuple[int, ...], ...]:
        """Shapes of the parts with so many classes of as many numbers."""
        return (len(REACH), side * side, WIDTH), (WIDTH,), (WIDTH, side), (side,), (side, WIDTH, side), (side, side)

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        a, b = (len(REACH) + 1) * WIDTH + 1, WIDTH + 1  # a * side ** 2 + b * side + WIDTH weights
        side = round((math.sqrt(b * b + 4 * a * (len(flat) - WIDTH)) - b) / (2 * a))
        parts, at = [], 0
        for shape in cls.shapes(side):
            size = int(np.prod(shape))
            parts.append(np.array(flat[at : at + size], dtype=np.float32).reshape(shape))
            at += size
        return cls(*parts)

    @classmethod
    def fresh(cls, seed: int = 7, side: int = CLASSES) -> Network:
        total = sum(int(np.prod(shape)) for shape in cls.shapes(side))
        return cls.of(np.random.default_rng(seed).normal(0, 0.1, total))

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.hidden, self.by_class, self.class_bias, self.by_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts])

    def forward(self, around: np.ndarray) -> np.ndarray:
        total = self.hidden + self.embed[0][around[:, 0]]
        for place in range(1, len(REACH)):
            total += self.embed[place][around[:, place]]
        return np.tanh(total)

    @staticmethod
    def _softmax(logits: np.ndarray, picked: np.ndarray) -> np.ndarray:
        """The log-probability of the picked ones; the logits become probabilities."""
        logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(len(picked)), picked]
        np.exp(logits, out=logits)
        sums = logits.sum(axis=1)
        logits /= sums[:, None]
        return own - np.log(sums)

    def log_chances(self, around: np.ndarray, target: np.ndarray, grads: list[np.ndarray] | None = None) -> np.ndarray:
        """The log-probability of each target; also the summed gradients of their negative, if asked for.

        The targets are sorted by class, so that each class is one product over rows that lie together.
        """
        side = len(self.class_bias)
        size = side * side
        kind, member = np.divmod(target.astype(np.int32), np.int32(side))
        order = np.argsort(kind.astype(np.int16 if side < 2**15 else np.int32), kind="stable")
        kind, member, around = kind[order], member[order], around[order]
        bounds = np.searchsorted(kind, np.arange(side + 1))
        classes = np.flatnonzero(np.diff(bounds)).tolist()
        hidden = self.forward(around)
        chance = hidden @ self.by_class + self.class_bias
        within = np.empty((len(kind), side), dtype=np.float32)
        for c in classes:
            own = slice(bounds[c], bounds[c + 1])
            np.matmul(hidden[own], self.by_word[c], out=within[own])
            within[own] += self.word_bias[c]
        logs = np.empty(len(kind))
        logs[order] = self._softmax(chance, kind).astype(np.float64) + self._softmax(within, member)
        if grads is not None:
            at = np.arange(len(kind))
            chance[at, kind] -= 1
            within[at, member] -= 1
            back = chance @ self.by_class.T
            grads[2] += hidden.T @ chance
            grads[3] += chance.sum(axis=0)
            for c in classes:
                own = slice(bounds[c], bounds[c + 1])
                back[own] += within[own] @ self.by_word[c].T
                grads[4][c] += hidden[own].T @ within[own]
            if classes:
                grads[5][classes] += np.add.reduceat(within, bounds[classes], axis=0)
            back *= 1 - hidden * hidden
            grads[1] += back.sum(axis=0)
            weights, places = back.astype(np.float64).ravel(), np.arange(WIDTH)
            for place in range(len(REACH)):
                spots = (around[:, place].astype(np.int64)[:, None] * WIDTH + places).ravel()
                grads[0][place] += np.bincount(spots, weights, size * WIDTH).reshape(size, WIDTH)
        return logs


def endings_of(size: int) -> int:
    """Numbers of words outside the vocabulary, by the letters they end with. Number 0 is the edge of a text."""
    return size // 8


def room(side: int) -> int:
    """Words that have a number of their own."""
    return side * side - 1 - endings_of(side * side)


def side_for(vocabulary: dict[str, int]) -> int:
    """Classes of the smallest network that has room for the vocabulary."""
    side = CLASSES
    while room(side) < len(vocabulary):
        side += 1
    return side


def number_of(word: str, vocabulary: dict[str, int], size: int = SIZE) -> int:
    found = vocabulary.get(word)
    return size - 1 - zlib.crc32(word[-3:].encode()) % endings_of(size) if found is None else found


def windows(texts: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of whole texts as numbers, those around each word, and the words per text."""
    return coded_windows(*coded_words(texts), vocabulary)[1:]


def coded_windows(
    distinct: list[str], codes: np.ndarray, counts: np.ndarray, vocabulary: dict[str, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of the distinct words, then the windows of the texts that are coded by them."""
    size = side_for(vocabulary) ** 2
    kind = np.int16 if size <= 2**15 else np.int32
    lowered = [w.lower() for w in distinct]
    numbers = np.fromiter((vocabulary.get(w, -1) for w in lowered), dtype=kind, count=len(distinct))
    last, many = size - 1, endings_of(size)
    outside = np.flatnonzero(numbers < 0)
    numbers[outside] = [last - zlib.crc32(lowered[i][-3:].encode()) % many for i in outside.tolist()]
    target = numbers[codes]
    ends = np.cumsum(counts)
    first, last = np.repeat(ends - counts, counts), np.repeat(ends, counts)
    at = np.arange(len(target))
    around = np.zeros((len(target), len(REACH)), dtype=kind)
    for place, step in enumerate(REACH):
        inside = (at + step >= first) & (at + step < last)
        around[inside, place] = target[at[inside] + step]
    return numbers, target, around, counts


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """All distinct words, in lower case, with their counts over all texts: word, n. Written out once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct, codes, _ = coded_words(batch.column(text))
            counts = np.bincount(codes, minlength=len(distinct))
            words = pa.array([word.lower() for word in distinct], type=pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(counts)], names=["word", "n"])

    counted = docs.select(text).mapInArrow(count, "word STRING, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))
    return kept(counted.where("n > 0"), "word-counts")  # the empty word before and after white space counts none


def vocabulary_of(docs: DataFrame, text: str, counted: DataFrame | None = None) -> dict[str, int]:
    """Numbers of the most frequent words, by counts over all texts; the others share numbers by their endings.

    The numbers grow with the distinct words, as the power 2 x ``GROWTH`` of them; the counts that give each word its share of
    its number are those of all words.
    """
    counted = word_counts(docs, text) if counted is None else counted
    side = max(CLASSES, math.ceil(counted.count() ** GROWTH))
    top = counted.orderBy(F.desc("n"), "word").limit(room(side)).collect()
    return {row["word"]: number for number, row in enumerate(top, start=1)}


def trained(
    docs: DataFrame, vocabulary: dict[str, int], *, text: str = "text", rounds: int = 2, rate: float = 0.1, batch_words: int = 4096
) -> Network:
    """The network after one pass over all words of all documents, in ``rounds`` parts.

    In each round every task learns from its documents of that part, from the same start, and what the tasks have learned
    is averaged by words. The sums run in Spark, one row per weight and task; only the averages reach the driver.
    """
    network = Network.fresh(side=side_for(vocabulary))
    names = "at INT, weighted DOUBLE, words BIGINT"
    for number in range(rounds):
        start = docs.sparkSession.sparkContext.broadcast((network.flat(), vocabulary))

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            flat, known = start.value
            own, words = Network.of(flat), 0
            squares = [np.full(part.shape, 1e-6, dtype=np.float32) for part in own.parts]
            for batch in batches:
                target, around, _ = windows(batch.column(text), known)
                words += len(target)
                order = np.random.default_rng(len(target)).permutation(len(target))
                for begin in range(0, len(order), batch_words):
                    drawn = order[begin : begin + batch_words]
                    grads = [np.zeros(part.shape, dtype=np.float32) for part in own.parts]
                    own.log_chances(around[drawn], target[drawn], grads)
                    for part, grad, square in zip(own.parts, grads, squares, strict=True):
                        grad /= len(drawn)
                        square += grad * grad
                        part -= rate * grad / np.sqrt(square)
            if words:
                weighted = own.flat().astype(np.float64) * words
                at, many = np.arange(len(weighted), dtype=np.int32), np.full(len(weighted), words)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weighted), pa.array(many)], names=["at", "weighted", "words"])

        part = docs.where(F.pmod(F.xxhash64(text), F.lit(rounds)) == number)
        sums = part.select(text).mapInArrow(learn, names).groupBy("at").agg(F.sum("weighted").alias("w"), F.sum("words").alias("n"))
        averages = sums.select("at", (F.col("w") / F.col("n")).alias("w")).toArrow()
        if len(averages):
            flat = np.empty(len(averages))
            flat[averages["at"].to_numpy()] = averages["w"].to_numpy()
            network = Network.of(flat)
    return network


def with_shares(words: DataFrame, counted: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Words outside the vocabulary with ``share``, the log-probability of each among the words of its number.

    A word that is not among the counted ones counts as one more of its number.
    """

    def number(word: Column) -> Column:
        return F.crc32(F.right(word, F.lit(3)).cast("binary")) % endings_of(side_for(vocabulary) ** 2)

    known = literal_rows(counted.sparkSession, [{"word": word} for word in vocabulary], "word STRING")
    rest = counted.join(F.broadcast(known), "word", "left_anti")
    totals = rest.groupBy(number(F.col("word")).alias("_number")).agg(F.sum("n").alias("_total"))
    own = words.join(rest, "word", "left").withColumn("_number", number(F.col("word"))).join(F.broadcast(totals), "_number", "left")
    new = F.coalesce("_total", F.lit(0)) + 1
    share = F.when(F.col("n").isNull(), -F.log(new.cast("double"))).otherwise(F.log(F.col("n") / F.col("_total")))
    return own.select(*words.columns, share.alias("share"))


def with_pseudo_likelihood(
    docs: DataFrame,
    network: Network,
    vocabulary: dict[str, int],
    *,
    key: str = "doc_id",
    text: str = "text",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Key, n_words, log_likelihood and mean_log_chance of every whole text.

    Every word is predicted from up to two words on either side; the log-probabilities are summed. That of a word outside
    the vocabulary is that of its number plus that of the word within its number, by the counts of all words (``counted``,
    those of the texts themselves where it is left out). A null or empty text has no words, a log_likelihood of 0 and no
    mean. Other columns are left out.

    The words outside the vocabulary are looked up once per batch of texts: a batch is one ``_part``, its first row holds
    its distinct ones, and every row holds the places of its own among them.
    """
    counted = word_counts(docs, text) if counted is None else counted
    shared = docs.sparkSession.sparkContext.broadcast((network.flat(), vocabulary))
    kind = docs.schema[key].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, known = shared.value
        own = Network.of(flat)
        size = side_for(known) ** 2
        for number, batch in enumerate(batches):
            if not len(batch):
                continue
            distinct, codes, counts = coded_words(batch.column("_text"))
            numbers, target, around, _ = coded_windows(distinct, codes, counts, known)
            logs = [own.log_chances(around[i : i + BATCH], target[i : i + BATCH]) for i in range(0, len(target), BATCH)]
            sums = np.r_[0.0, np.cumsum(np.concatenate(logs))] if logs else np.zeros(1)
            ends = np.cumsum(counts)
            outside = numbers >= size - endings_of(size)
            place = (np.cumsum(outside) - 1).astype(np.int32)
            rare = outside[codes]
            bounds = np.r_[0, np.cumsum(rare)][np.r_[0, ends]].astype(np.int32)
            words = [[distinct[i].lower() for i in np.flatnonzero(outside)], *[None] * (len(batch) - 1)]
            columns = [
                pa.array(np.full(len(batch), TaskContext.get().partitionId() * 2**32 + number)),
                batch.column("_key"),
                pa.array(counts.astype(np.int64)),
                pa.array(sums[ends] - sums[ends - counts]),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[codes[rare]])),
                pa.array(words, type=pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_part", "_key", "n_words", "log_likelihood", "_places", "_words"])

    def add(rows: pa.Table, found: pa.Table) -> pa.Table:
        shares = np.zeros(len(found))
        shares[found["_at"].to_numpy()] = found["share"].to_numpy()
        sums = [np.zeros(0)]
        for chunk in rows["_places"].chunks:
            at = np.r_[0, np.cumsum(np.diff(chunk.offsets.to_numpy()))]
            added = np.r_[0.0, np.cumsum(shares[chunk.flatten().to_numpy()])]
            sums.append(added[at[1:]] - added[at[:-1]])
        counts = rows["n_words"].to_numpy()
        total = rows["log_likelihood"].to_numpy() + np.concatenate(sums)
        mean = pa.array(total / np.maximum(counts, 1), mask=counts == 0)
        return pa.table([rows["_key"], rows["n_words"], pa.array(total), mean], names=[key, "n_words", "log_likelihood", "mean_log_chance"])

    parts = f"_part BIGINT, _key {kind}, n_words BIGINT, log_likelihood DOUBLE, _places ARRAY<INT>, _words ARRAY<STRING>"
    scored = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(score, parts)
    scored = kept(scored, "scored")
    words = scored.where("_words IS NOT NULL").select("_part", F.posexplode("_words").alias("_at", "word"))
    found = with_shares(words, counted, vocabulary).select(F.col("_part").alias("_of"), "_at", "share")
    schema = f"`{key}` {kind}, n_words BIGINT, log_likelihood DOUBLE, mean_log_chance DOUBLE"
    return scored.drop("_words").groupBy("_part").cogroup(found.groupBy("_of")).applyInArrow(add, schema)
