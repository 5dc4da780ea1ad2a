"""Best-fit decreasing packing of tokenised documents into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import kept, literal_rows, ranked
from rulestream.llm.merging import encoder

PIECE = "piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


def cut_pieces(docs: DataFrame, vocabulary: str, limit: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each document: key, piece, start, length, ids_crc32.

    A document is its token ids and a final 0, cut after every ``limit`` ids. A null text is
    empty: its one piece is the final 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            keys = batch.column(key)
            for first, ids, counts in encode.encode(pc.cast(batch.column(text), pa.large_string())):
                lengths = counts + 1
                ends = np.cumsum(lengths)
                all_ids = np.zeros(int(ends[-1]), dtype="<u4")
                inner = np.ones(len(all_ids), dtype=bool)
                inner[ends - 1] = False
                all_ids[inner] = ids
                pieces = -(-lengths // limit)
                owner = np.repeat(np.arange(len(lengths)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * limit
                size = np.minimum(limit, lengths[owner] - start)
                at = ((ends - lengths)[owner] + start) * 4
                raw = memoryview(all_ids).cast("B")
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + size * 4).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(first + owner)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(size),
                        pa.array(crcs, type=pa.int64()),
                    ],
                    names=[key, "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(cut, f"`{key}` {kind}, {PIECE}")


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that tells which capacities occur.

    Bins of one capacity are kept as runs of consecutive numbers (first, how many). The
    tightest capacity that holds a size is found in logarithmic time.
    """

    def __init__(self, limit: int) -> None:
        self.leaves = 1 << limit.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int, there: bool) -> None:
        node = room + self.leaves
        self.any[node] = there
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def add(self, room: int, first: int, bins: int) -> None:
        if room and bins:
            runs = self.runs.setdefault(room, [])
            if not runs:
                self._mark(room, True)
            runs.append((first, bins))

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of an open bin that holds the size."""
        node = size + self.leaves
        if self.any[node]:
            return size
        while node > 1:  # up until a right neighbour has open bins, then down to its leftmost
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.any[2 * node])
                return node - self.leaves
            node //= 2
        return None

    def take(self, room: int) -> tuple[int, int]:
        runs = self.runs[room]
        run = runs.pop()
        if not runs:
            self._mark(room, False)
        return run


def packing_plan(counts: dict[int, int], limit: int) -> list[dict]:
    """Best-fit decreasing over all pieces, given how many there are of each length.

    Pieces of one length are alike, so they are placed in bulk: a bin with the tightest
    capacity takes pieces while it holds another, for it stays the tightest. A row of the
    plan puts the pieces of a length with ranks [_from, _to) into bins from ``_bin`` on, ``_each``
    to a bin, from ``_offset`` on. Rows depend on the lengths, not on the number of pieces.
    """
    bins, plan, opened = OpenBins(limit), [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            room = bins.tightest(length)
            if room is None:
                room, first, n = limit, opened, -(-(total - done) // (limit // length))
                opened += n
            else:
                first, n = bins.take(room)
            each = room // length
            for used, size in ((min(n, (total - done) // each), each), (1, (total - done) % each)):
                used = min(used, n)
                if used and size and done < total:
                    plan.append({"length": length, "_from": done, "_to": done + used * size, "_bin": first, "_each": size, "_offset": limit - room})
                    bins.add(room - size * length, first, used)
                    done, first, n = done + used * size, first + used, n - used
            bins.add(room, first, n)
    return plan


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = 2048, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``limit`` tokens; one row per piece.

    Returns key, piece, start, length, ids_crc32, sequence_id, offset. The packing is
    best-fit decreasing over the whole table: only the number of pieces of each length
    (``limit`` numbers at most) reaches the driver, and pieces find their place by their rank
    among those of the same length. Null and empty texts are pieces of length 1. Repeated
    rows are packed one by one. Other columns are left out; an empty table gives no rows.
    """
    pieces = kept(cut_pieces(docs, vocabulary, limit, key=key, text=text), "pieces")
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = literal_rows(
        docs.sparkSession,
        packing_plan(counts, limit),
        "length BIGINT, _from BIGINT, _to BIGINT, _bin BIGINT, _each BIGINT, _offset BIGINT",
    )
    tie = F.xxhash64(F.col(key), F.col("piece"), F.col("ids_crc32"))
    place = F.col("_rank") - F.col("_from")
    return (
        ranked(pieces, "length", tie, "_rank")
        .join(F.broadcast(plan), "length")
        .where("_rank >= _from AND _rank < _to")
        .select(
            key,
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_bin") + F.floor(place / F.col("_each"))).alias("sequence_id"),
            (F.col("_offset") + place % F.col("_each") * F.col("length")).alias("offset"),
        )
    )
