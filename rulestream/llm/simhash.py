"""SimHash near-duplicates: fingerprints, and their links through a segment-popcount embedding."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import kept
from rulestream.llm.components import components

SEED = 42
#: Shingles of a text that are counted together, which bounds the memory for long texts.
BLOCK = 1 << 16
#: A cell up to this size is compared pair by pair; a larger one gives a spanning forest.
SMALL = 8
#: The bits of even numbers, one for each segment of two bits.
EVEN = 0x5555555555555555
#: Equal groups that a cell asks for. More give more cells of fewer fingerprints.
EQUAL = range(4, 9)
#: Comparisons in numpy that cost as much as sending one fingerprint to one cell.
CHEAP = 100


def fingerprint(text: str | None, words: int) -> int:
    """The unsigned SimHash of the shingles of a text; zero without words."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: max(1, len(parts) - words + 1)], ends[min(words, len(parts)) - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), BLOCK):
        cuts = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.fromiter(map(xxh64_intdigest, [joined[a:b] for a, b in cuts], repeat(SEED)), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, *, key: str, text: str) -> DataFrame:
    """The key and the SimHash, as a signed long, of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(text)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found.view(np.int64))], names=[key, "_fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(compute, f"`{key}` {kind}, _fp BIGINT")


def embedded(fp: np.ndarray) -> np.ndarray:
    """The popcounts of the 32 segments of two bits, each as a number of two bits in its place."""
    return fp - ((fp >> np.uint64(1)) & np.uint64(EVEN))


def unary(counts: np.ndarray) -> np.ndarray:
    """Popcounts as 00, 01, 11: the Manhattan distance of two is the number of bits that differ."""
    return counts | ((counts >> np.uint64(1)) & np.uint64(EVEN))


class Grid:
    """Cells of the embedding that any two fingerprints within a distance share.

    The 32 popcounts stand in ``distance + equal`` groups. Within a Manhattan distance of ``distance``
    at least ``equal`` groups are the same, so a fingerprint lies in one cell for every choice of
    that many groups. Each bit that differs changes one popcount by one at most, so the Manhattan distance
    never exceeds the number of differing bits and no link is lost.
    """

    def __init__(self, distance: int, equal: int = EQUAL[0]) -> None:
        groups = distance + equal
        if not 0 <= distance <= 32 - equal:
            raise ValueError(f"distance is not between 0 and {32 - equal}")
        self.distance, self.equal = distance, equal
        bounds = [64 * i // (2 * groups) * 2 for i in range(groups + 1)]
        self.groups = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:], strict=False)]
        self.choices = list(combinations(range(groups), equal))
        self.masks = [sum(self.groups[i] for i in choice) for choice in self.choices]

    @classmethod
    def of_size(cls, distance: int, fingerprints: int) -> Grid:
        """The grid with the least work for so many distinct fingerprints; the links are the same with each.

        A fingerprint is sent to every cell it lies in and compared with the others there. Two random ones
        have the same popcount of two bits in 3 of 8 cases, which gives the size of a cell.
        """

        def work(equal: int) -> float:
            groups = distance + equal
            return comb(groups, equal) * (1 + fingerprints * 0.375 ** (32 * equal / groups) / CHEAP)

        return cls(distance, min((e for e in EQUAL if distance + e <= 32), key=work, default=EQUAL[0]))

    def linked(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether fingerprints differ in few bits: by the lower bound, and where that holds exactly."""
        near = np.bitwise_count(unary(embedded(one)) ^ unary(embedded(other))) <= self.distance
        near[near] = np.bitwise_count((one ^ other)[near] if one.shape == other.shape else (other[near] ^ one)) <= self.distance
        return near

    def first(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The number of the first cell that holds both."""
        differ = embedded(one) ^ embedded(other)
        equal = np.stack([(differ & np.uint64(g)) == 0 for g in self.groups])
        taken = np.cumsum(equal, axis=0)
        code = np.zeros(len(one), dtype=np.int64)
        for i in range(len(self.groups)):
            code |= (equal[i] & (taken[i] <= self.equal)).astype(np.int64) << i
        codes = np.array([sum(1 << i for i in choice) for choice in self.choices])
        order = np.argsort(codes)
        return order[np.searchsorted(codes[order], code)]

    def forest(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links that join the members of a large cell as all its links would."""
        left, ones, others = members, [members[:0]], [members[:0]]
        queue: list[np.ndarray] = []
        while len(left):
            if not queue:
                queue, left = [left[:1]], left[1:]
            node = queue.pop()
            near = self.linked(node, left)
            found, left = left[near], left[~near]
            ones.append(np.repeat(node, len(found)))
            others.append(found)
            queue.extend(np.split(found, len(found)) if len(found) else [])
        return np.concatenate(ones), np.concatenate(others)

    def links(self, choice: np.ndarray, cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links within whole cells, sorted by choice and cell. A link is kept in the first cell of both."""
        begins = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (cell[1:] != cell[:-1])])
        sizes = np.diff(np.r_[begins, len(cell)])
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        last = np.repeat(begins + sizes, sizes)
        ones, others, at = [], [], []
        for step in range(1, SMALL):
            i = np.flatnonzero(small & (np.arange(len(cell)) + step < last))
            i = i[self.linked(fp[i], fp[i + step])]
            ones.append(fp[i])
            others.append(fp[i + step])
            at.append(choice[i])
        for run in np.flatnonzero(sizes > SMALL):
            a, b = self.forest(fp[begins[run] : begins[run] + sizes[run]])
            ones.append(a)
            others.append(b)
            at.append(np.full(len(a), choice[begins[run]]))
        a, b, c = np.concatenate(ones), np.concatenate(others), np.concatenate(at)
        own = self.first(a, b) == c
        return a[own], b[own]

    def edges(self, distinct: DataFrame) -> DataFrame:
        """Links (a, b) that join the fingerprints of ``_fp`` as all links within the distance would.

        Fingerprints are distinct, and those of a cell agree in the popcounts of at least half of
        their segments, which bounds a cell.
        """

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [np.empty(0, dtype=t) for t in (np.int32, np.int64, np.uint64)]

            def found(columns: list[np.ndarray]) -> pa.RecordBatch:
                a, b = self.links(*columns)
                return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

            for batch in batches:
                new = [batch.column(i).to_numpy() for i in range(3)]
                new[2] = new[2].view(np.uint64)
                if not len(new[0]):
                    continue
                changed = np.flatnonzero((new[0] != new[0][-1]) | (new[1] != new[1][-1]))
                whole = changed[-1] + 1 if len(changed) else 0  # the last cell may go on in the next batch
                joined = [np.concatenate([h, n[:whole]]) for h, n in zip(held, new, strict=True)]
                same = len(held[0]) and not whole and (held[0][-1], held[1][-1]) == (new[0][0], new[1][0])
                if whole or (len(held[0]) and not same):
                    yield found(joined)
                    held = [n[whole:] for n in new]
                else:
                    held = [np.concatenate([h, n]) for h, n in zip(held, new, strict=True)]
            if len(held[0]):
                yield found(held)

        signed = [m - (1 << 64) if m >> 63 else m for m in self.masks]
        fp = F.col("_fp")
        low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
        counts = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
        cells = distinct.select(
            F.posexplode(F.array(*[counts.bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "cell"), "_fp"
        )
        together = cells.repartition("choice", "cell").sortWithinPartitions("choice", "cell")
        return together.select("choice", "cell", "_fp").mapInArrow(search, "a BIGINT, b BIGINT")


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its fingerprint and component: key, fingerprint, component_id.

    Shingles are of ``words`` words, lower-cased in A-Z; a shorter text is one shingle, and texts
    without words (null and empty ones too) have fingerprint zero. Fingerprints that differ in
    ``distance`` bits or fewer are linked; component_id is the smallest key that links reach, the
    row's own included (null only where all keys of the component are). Equal fingerprints are
    compared once. Repeated rows stay; other columns are left out.
    """
    rows = kept(fingerprints(docs, words, key=key, text=text), "fingerprints")
    distinct = kept(rows.groupBy("_fp").agg(F.min(key).alias("_first")), "distinct")
    grid = Grid.of_size(distance, distinct.count())
    labels = components(kept(grid.edges(distinct.select("_fp")), "links"))
    classes = distinct.join(labels.withColumnRenamed("node", "_fp"), "_fp", "left").withColumn(
        "_root", F.coalesce("label", "_fp")
    )
    smallest = classes.groupBy("_root").agg(F.min("_first").alias("component_id"))
    found = classes.join(smallest, "_root").select("_fp", "component_id")
    return rows.join(found, "_fp").select(key, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
