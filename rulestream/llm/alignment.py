"""Two tokenizations of the same texts, aligned by bytes, with corpus-wide counts of the pairs of tokens that overlap."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import in_parts, kept

#: Bytes of text whose records are sorted together.
CHUNK = 1 << 20
#: Bytes of text per radix partition: some millions of pairs of its chunks.
RADIX = 48 << 20
#: Parts of the pairs of one B token, which may lie in different partitions.
SPLIT = 64
#: Pairs of a block, the unit that is compressed and merged.
BLOCK = 8192
#: Pairs that are merged together.
BATCH = 32 * BLOCK

MARK = "▁".encode()
#: Letters below this one are Latin.
LATIN = "\u0250"
# Fixed value: the pattern by which byte-level files of this kind cut a text.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: those that print stand for themselves, others for 256 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The bytes of all tokens."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], Vocabulary]:
    """The encoder of a byte-level file, which takes special strings as plain text, and the bytes of its tokens.

    Where the numbers of the tokens follow the order of the merges, tiktoken finds the same tokens by them, several times
    faster. It gets the texts of Latin letters; for others the two libraries may know letters of different versions of Unicode.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    special = {t["content"] for t in given["added_tokens"]}
    entries = given["model"]["vocab"]
    numbers = {bytes(letters[c] for c in e): n for e, n in entries.items() if e not in special and all(c in letters for c in e)}
    tokens = [b""] * (max(entries.values()) + 1)
    for token, number in numbers.items():
        tokens[number] = token
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in given["model"]["merges"]]
    places = [entries[m] for m in merges]
    fast = None
    if places == sorted(places) and len(numbers) == 256 + len(merges):
        fast = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=numbers, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [
            fast.encode_ordinary(text)
            if fast and (text.isascii() or max(text) < LATIN)
            else tokenizer.encode(text, add_special_tokens=False).ids
            for text in texts
        ]

    return encode, Vocabulary(tokens)


@lru_cache(maxsize=1)
def pieces(path: str) -> tuple[Callable[[list[str]], list[list[int]]], Vocabulary]:
    """The encoder of a file of pieces, which puts a space before a text, and the bytes of its pieces."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            tokens.append(bytes([int(piece[3:5], 16)]))
        else:
            tokens.append(piece.encode().replace(MARK, b" "))

    return lambda texts: processor.encode(texts, num_threads=1), Vocabulary(tokens)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(counts.sum())), counts


class Aligned:
    """The texts of a chunk in both tokenizations; those whose bytes differ from the text have no tokens."""

    def __init__(self, texts: list[str | None], byte_path: str, piece_path: str) -> None:
        encode_a, bytes_a = byte_level(byte_path)
        encode_b, bytes_b = pieces(piece_path)
        size = len(texts)
        given = [" " + t if t else "" for t in texts]
        raw = [t.encode() for t in given]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=size)
        lists_a, lists_b = encode_a(given), encode_b([t[1:] for t in given])
        sides = zip(raw, lists_a, lists_b, strict=True)
        alike = np.array([len(t) > 0 and bytes_a.joined(x) == t == bytes_b.joined(y) for t, x, y in sides], dtype=bool)
        self.a, self.n_a, ends_a = self.kept(lists_a, alike, bytes_a)
        self.b, self.n_b, ends_b = self.kept(lists_b, alike, bytes_b)
        # each stretch between ends of either side is one link
        upto = np.cumsum(np.where(alike, sizes, 0))
        marks = np.zeros((2, (int(upto[-1]) if size else 0) + 1), dtype=bool)
        marks[0, ends_a] = marks[1, ends_b] = True
        before = np.cumsum(marks, axis=1, dtype=np.int32) - marks
        ends, both = np.flatnonzero(marks[0] | marks[1]), np.flatnonzero(marks[0] & marks[1])
        self.link_a, self.link_b = before[0, ends].astype(np.int64), before[1, ends].astype(np.int64)
        self.link_doc = np.searchsorted(upto, ends)
        self.n_links = np.bincount(self.link_doc, minlength=size)
        self.n_groups = np.bincount(np.searchsorted(upto, both), minlength=size)
        self.group_a, self.group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)

    @staticmethod
    def kept(lists: list[list[int]], alike: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of the texts that stay, their number per text, and where each ends among the bytes of these texts."""
        ids, counts = flat([own if stays else [] for own, stays in zip(lists, alike.tolist(), strict=True)])
        return ids, counts, np.cumsum(vocabulary.lengths[ids])

    def digests(self) -> list[str]:
        """The digest of each text's groups as numbers: those of a group by commas, sides by a bar, groups by semicolons."""
        total = len(self.a) + len(self.b)
        if not total:
            return [""] * len(self.n_a)
        b_before = np.concatenate([[0], np.cumsum(np.bincount(self.group_b))])
        a_upto = np.cumsum(np.bincount(self.group_a))
        place_a = np.arange(len(self.a)) + b_before[self.group_a]
        place_b = np.arange(len(self.b)) + a_upto[self.group_b]
        ids = np.empty(total, dtype=np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        after = np.full(total, ord(","), dtype=np.uint8)
        after[place_a[a_upto - 1]] = ord("|")
        after[place_b[b_before[1:] - 1]] = ord(";")
        digits = 1 + sum((ids >= 10**p).astype(np.int64) for p in range(1, 10))
        width = int(digits.max())
        shown = np.empty((total, width + 1), dtype=np.uint8)
        for column in range(width):
            shown[:, width - 1 - column] = ord("0") + ids // 10**column % 10
        shown[:, width] = after
        text = shown[np.arange(width + 1) >= (width - digits)[:, None]].tobytes()
        upto = np.concatenate([[0], np.cumsum(digits + 1)])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(upto, upto[1:], strict=False)]


def radix_of(b: np.ndarray, a: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a pair: the pairs of a B token lie in some of them, dealt by the A token."""
    mixed = (b * SPLIT + a % SPLIT).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def packed(*columns: np.ndarray) -> bytes:
    """Arrays as one compressed block, each with its length."""
    lengths = np.array([len(c) for c in columns], dtype=np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([lengths.tobytes(), *(c.tobytes() for c in columns)]))


def unpacked(block: bytes, *kinds: type) -> list[np.ndarray]:
    """The arrays of a block, of the types given."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    lengths = np.frombuffer(raw, dtype=np.int64, count=len(kinds)).tolist()
    at, found = 8 * len(kinds), []
    for kind, length in zip(kinds, lengths, strict=True):
        found.append(np.frombuffer(raw, dtype=kind, count=length, offset=at))
        at += found[-1].nbytes
    return found


@dataclass
class Run:
    """The records of a chunk in one partition, sorted by B, then A, then document.

    ``blocks`` hold the pairs with their number of links, and begin with ``first_keys``. ``records`` has the
    documents of each pair, and how often each has it.
    """

    radix: int
    blocks: list[bytes]
    first_keys: list[int]
    records: bytes


def runs_of(aligned: Aligned, parts: int) -> Iterator[Run]:
    a, b = aligned.a[aligned.link_a], aligned.b[aligned.link_b]
    kinds, number = np.unique((b << 32) | a, return_inverse=True)
    radix = radix_of(kinds >> 32, kinds & 0xFFFFFFFF, parts)
    order = np.argsort(radix, kind="stable")  # pairs stay sorted within a partition
    place = np.empty(len(kinds), dtype=np.int64)
    place[order] = np.arange(len(kinds))
    # a chunk has fewer than 65,536 documents
    records, often = np.unique((place[number] << 16) | aligned.link_doc, return_counts=True)
    kinds, docs = kinds[order], (records & 0xFFFF).astype(np.uint16)
    first = np.searchsorted(records >> 16, np.arange(len(kinds) + 1))
    bounds = np.searchsorted(radix[order], np.arange(parts + 1))
    links = np.concatenate([[0], np.cumsum(often)])[first]
    for part in np.flatnonzero(np.diff(bounds)).tolist():
        low, high = bounds[part], bounds[part + 1]
        blocks, keys = [], []
        for begin in range(low, high, BLOCK):
            end = min(begin + BLOCK, high)
            blocks.append(packed(np.diff(kinds[begin:end], prepend=0), np.diff(links[begin : end + 1])))
            keys.append(int(kinds[begin]))
        own = slice(first[low], first[high])
        per_pair = np.diff(first[low : high + 1]).astype(np.uint16)
        yield Run(part, blocks, keys, packed(per_pair, docs[own], often[own].astype(np.uint32)))


def merged(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of all runs in their order: key, run and links, in batches that have no pair in common.

    A heap holds the next block of each run by its first key. What lies below the first keys of all blocks still to come is complete.
    """
    heap = [(keys[0], run, 0) for run, (keys, _) in enumerate(runs)]
    heapq.heapify(heap)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while heap or held:
        size, least = sum(len(h[0]) for h in held), min((int(h[0].min()) for h in held), default=None)
        while heap and (size < BATCH or heap[0][0] <= least):
            first, run, block = heapq.heappop(heap)
            keys, blocks = runs[run]
            if block + 1 < len(blocks):
                heapq.heappush(heap, (keys[block + 1], run, block + 1))
            gaps, links = unpacked(blocks[block], np.int64, np.int64)
            held.append((np.cumsum(gaps), np.full(len(gaps), run, dtype=np.int32), links))
            size, least = size + len(gaps), first if least is None else min(least, first)
        key, run, links = (np.concatenate(part) for part in zip(*held, strict=True))
        done = key < heap[0][0] if heap else np.ones(len(key), dtype=bool)
        order = np.argsort(key[done], kind="stable")
        yield key[done][order], run[done][order], links[done][order]
        held = [] if done.all() else [(key[~done], run[~done], links[~done])]


def pair_counts(key: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, their counts, and the place of each entry's pair among them; the entries are sorted by pair."""
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)
    return key[first], np.add.reduceat(links, first), np.cumsum(new) - 1


def aligned_tokens(docs: DataFrame, byte_path: str, piece_path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every text.

    A are the tokens of a space and the text by a byte-level file, B those of the text by a file of pieces that adds the space itself. Byte
    offsets where both end cut them into groups; an A and a B token that share bytes are a link. ``count_sum`` adds up over the links
    how many links of the corpus have the same pair of ids, ``n_best`` counts those whose pair is the most frequent of its B id, ties included.
    A text that is null, empty, or whose tokens have other bytes than itself, has no tokens, zeros, and '' as its digest. Rows are
    independent of each other but for the counts: repeated ones count each. Other columns are left out. Both files have to be at the
    same place on every machine.

    Each chunk of texts is tokenized once. Its records of pairs and documents are dealt by radix into compressed runs, sorted by B, then A.
    The pairs of the runs, with the links of the chunk, meet by partition, where a heap merges them and counts each pair; in that order
    the maximum of each B token comes by. The pairs of a B token lie in up to ``SPLIT`` partitions, so that a frequent one is no single task's;
    its maxima, of which there are as many as B has tokens, are put together and broadcast. A second merge streams the count of each pair back to
    the runs, in their order, and a chunk adds them up for its documents, which have stayed with it: what is sent does not grow
    with the number of partitions, and no count is looked up in a table of all pairs.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(8, math.ceil(size / RADIX))
    fields = {
        "chunk": pa.int64(),
        "key": None,
        "n_a": pa.int64(),
        "n_b": pa.int64(),
        "n_groups": pa.int64(),
        "n_links": pa.int64(),
        "groups_sha256": pa.string(),
        "place": pa.int32(),
        "radix": pa.int32(),
        "blocks": pa.list_(pa.binary()),
        "first_keys": pa.list_(pa.int64()),
        "records": pa.binary(),
    }
    schema = (
        f"chunk BIGINT, key {kind}, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING, "
        "place INT, radix INT, blocks ARRAY<BINARY>, first_keys ARRAY<BIGINT>, records BINARY"
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in in_parts(batches, "text", CHUNK):
            for begin in range(0, len(batch), 1 << 15):
                part = batch.slice(begin, 1 << 15)
                aligned = Aligned(part.column("text").to_pylist(), byte_path, piece_path)
                runs = list(runs_of(aligned, parts))
                for given in (
                    {
                        "key": part.column("key"),
                        **{n: getattr(aligned, n) for n in ("n_a", "n_b", "n_groups", "n_links")},
                        "groups_sha256": aligned.digests(),
                        "place": np.arange(len(part)),
                    },
                    {n: [getattr(r, n) for r in runs] for n in ("radix", "blocks", "first_keys", "records")},
                ):
                    many = len(next(iter(given.values())))
                    types = fields | {"key": part.column("key").type}
                    given = {n: pa.array(v, type=types[n]) if n != "key" else v for n, v in given.items()}
                    given["chunk"] = pa.array(np.full(many, chunk))
                    columns = [given.get(n, pa.nulls(many, t)) for n, t in types.items()]
                    yield pa.RecordBatch.from_arrays(columns, names=list(fields))
                chunk += 1

    written = kept(rows.mapInArrow(align, schema), "aligned")
    runs = written.where("radix IS NOT NULL").select("radix", "chunk", "blocks", "first_keys")

    def opened(table: pa.Table) -> list[tuple[list[int], list[bytes]]]:
        return list(zip(table["first_keys"].to_pylist(), table["blocks"].to_pylist(), strict=True))

    def maxima(table: pa.Table) -> pa.Table:
        most: dict[int, int] = {}
        for pairs, _, links in merged(opened(table)):
            kinds, counts, _ = pair_counts(pairs, links)
            b = kinds >> 32
            first = np.flatnonzero(np.diff(b, prepend=-1))
            for token, count in zip(b[first].tolist(), np.maximum.reduceat(counts, first).tolist(), strict=True):
                most[token] = max(most.get(token, 0), count)
        return pa.table({"b": pa.array(list(most), type=pa.int64()), "most": pa.array(list(most.values()), type=pa.int64())})

    per_part = runs.groupBy("radix").applyInArrow(maxima, "b BIGINT, most BIGINT")
    found = per_part.groupBy("b").agg(F.max("most").alias("most")).toArrow()  # a row per token of B
    top = np.zeros(int(pc.max(found["b"]).as_py() or 0) + 1, dtype=np.int64)
    top[found["b"].to_numpy()] = found["most"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(top)

    def contributions(table: pa.Table) -> pa.Table:
        """Twice the count of each pair of a run, and one more where it is the highest of its B token."""
        owners, values = [], []
        for pairs, run, links in merged(opened(table)):
            kinds, counts, place = pair_counts(pairs, links)
            owners.append(run)
            values.append((2 * counts + (counts == shared.value[kinds >> 32]))[place])
        owner, value = np.concatenate(owners), np.concatenate(values)
        order = np.argsort(owner, kind="stable")  # pairs stay sorted within a run
        bounds = np.searchsorted(owner[order], np.arange(len(table) + 1))
        value = value[order]
        blobs = [packed(value[x:y]) for x, y in zip(bounds, bounds[1:], strict=False)]
        return pa.table({"chunk": table["chunk"], "radix": table["radix"], "counts": pa.array(blobs, type=pa.binary())})

    back = runs.groupBy("radix").applyInArrow(contributions, "chunk BIGINT, radix INT, counts BINARY")

    def add(table: pa.Table, returned: pa.Table) -> pa.Table:
        own = table.filter(pc.is_null(table["radix"]))
        best, sums = np.zeros((2, len(own)), dtype=np.int64)
        counts = dict(zip(returned["radix"].to_pylist(), returned["counts"].to_pylist(), strict=True))
        runs = table.filter(pc.is_valid(table["radix"]))
        for radix, records in zip(runs["radix"].to_pylist(), runs["records"].to_pylist(), strict=True):
            (value,) = unpacked(counts[radix], np.int64)
            per_pair, docs, often = unpacked(records, np.uint16, np.uint16, np.uint32)
            value, often = np.repeat(value, per_pair), often.astype(np.int64)
            np.add.at(best, docs, often * (value & 1))
            np.add.at(sums, docs, often * (value >> 1))
        place = own["place"].to_numpy()
        columns = [own[n] for n in ("key", "n_a", "n_b", "n_groups", "n_links")]
        columns += [pa.array(best[place]), pa.array(sums[place]), own["groups_sha256"]]
        return pa.table(columns, names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    result = f"`{key}` {kind}, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"
    by_chunk = written.select("chunk", "place", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "records")
    return by_chunk.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(add, result)
