"""Byte-pair encoding by rank-synchronous merging of ragged numpy arrays.

All pre-tokens of a batch lie in one flat array of symbols. In each round every pre-token
merges its lowest-rank pair, all pre-tokens at once, until no pair of any is left. A pair's
rank is above that of every merge that makes one of its parts, so merging all occurrences of
the lowest pair together gives what merging them one after the other gives.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: No merge for this pair.
NONE = np.int32(2**30)

# They belong to the format of the vocabulary file. Its split pattern, written
# for the characters of SIMPLE, and the bytes that are shown as themselves.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[^\W_]|(?:[^\s\w]|_)+| ")
PRINTABLE = (*range(33, 127), *range(161, 173), *range(174, 256))

#: Chunks of other characters are normalised and split by the library itself.
SIMPLE = re.compile("[\x00-\x1b\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]*")


class PairTable:
    """Ranks of symbol pairs in two hash tables: pairs that collide in the first are in the second."""

    BITS = 19

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        keys = self._key(left, right)
        self.tables = []
        todo = np.arange(len(keys), dtype=np.int32)
        rng = np.random.default_rng(1)
        while len(todo):
            factor = np.uint64(rng.integers(1, 2**63) | 1)
            slots = self._slot(keys[todo], factor)
            _, first = np.unique(slots, return_index=True)
            if self.tables and len(first) < len(todo):
                continue  # another factor: the second table holds all that is left
            held = np.full(1 << self.BITS, -1, dtype=np.int64)
            rank = np.full(1 << self.BITS, NONE, dtype=np.int32)
            held[slots[first]] = keys[todo[first]]
            rank[slots[first]] = todo[first]
            self.tables.append((factor, held, rank))
            todo = np.delete(todo, first)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (keys.astype(np.uint64) * factor) >> np.uint64(64 - self.BITS)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        out = np.full(len(keys), NONE, dtype=np.int32)
        for factor, held, rank in self.tables:
            slots = self._slot(keys, factor)
            hit = held[slots] == keys
            out[hit] = rank[slots[hit]]
        return out


class Chunks(dict):
    """The number of each chunk; a chunk that is looked up first gets the next number."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Encoder:
    """Token ids of texts under a byte-level BPE file with word ends (``word_bpe_49k.json``).

    Texts split at ASCII white space into chunks, which the vocabulary never joins. The ids of
    chunks are kept between batches; once there are more than ``kept`` the store starts anew.
    """

    def __init__(self, path: str, kept: int = 500_000) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocab, suffix = model["model"]["vocab"], model["model"]["end_of_word_suffix"]
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["model"]["merges"]]
        self.special = {token["content"]: token["id"] for token in model["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.table = PairTable(
            np.array([vocab[a] for a, _ in merges], dtype=np.int32),
            np.array([vocab[b] for _, b in merges], dtype=np.int32),
        )
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        others = (byte for byte in range(256) if byte not in PRINTABLE)
        shown = {byte: chr(byte) for byte in PRINTABLE} | {byte: chr(256 + i) for i, byte in enumerate(others)}
        self.inner = np.array([vocab[shown[byte]] for byte in range(256)], dtype=np.int32)
        self.final = np.array([vocab[shown[byte] + suffix] for byte in range(256)], dtype=np.int32)
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.byte_of = {mark: byte for byte, mark in shown.items()}
        self.kept = kept
        self.clear()

    def clear(self) -> None:
        """A new store: special tokens and the empty chunk only."""
        self.chunks = Chunks((name, i) for i, name in enumerate([*self.special, ""]))
        self.ids = np.array(list(self.special.values()), dtype=np.uint32)
        self.starts = np.array([*range(len(self.special) + 1), len(self.special)], dtype=np.int64)

    def merge(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, given their bytes and their sizes above zero; and how many each has."""
        ids = self.inner[raw]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.final[raw[ends]]
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        done_ids, done_words = [ids[:0]], [word[:0]]
        while len(ids):
            inside = word[1:] == word[:-1]
            rank = np.full(len(ids), NONE, dtype=np.int32)
            left = np.flatnonzero(inside)
            rank[left] = self.table.ranks(ids[left], ids[left + 1])
            starts = np.flatnonzero(np.r_[True, ~inside])
            counts = np.diff(np.r_[starts, len(ids)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), counts)
            over = lowest == NONE
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                going = ~over
                ids, word, rank, lowest = ids[going], word[going], rank[going], lowest[going]
                if not len(ids):
                    break
            at = rank == lowest
            if (at[1:] & at[:-1]).any():  # a run such as "aaa": every other pair from its left
                places = np.arange(len(at))
                begun = np.maximum.accumulate(np.where(at & ~np.r_[False, at[:-1]], places, 0))
                at &= (places - begun) % 2 == 0
            ids[at] = self.made[rank[at]]
            stay = np.r_[True, ~at[:-1]]
            ids, word = ids[stay], word[stay]
        flat, owner = np.concatenate(done_ids), np.concatenate(done_words)
        return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))

    def pieces(self, chunk: str) -> list[bytes]:
        """The pre-tokens of a chunk of any characters, in UTF-8."""
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in self.split(self.normalise(chunk))]

    def learn(self, chunks: list[str]) -> None:
        """Append the ids of new chunks to the store, in the order of their numbers."""
        together = " ".join(chunks)
        if SIMPLE.fullmatch(together):
            pieces = PIECES.findall(together.lower() + " ")
            raw = "".join(pieces).encode()
            sizes = np.fromiter(map(len, map(str.encode, pieces)), dtype=np.int64, count=len(pieces))
        else:
            pieces = [x for c in chunks for x in ([*map(str.encode, PIECES.findall(c.lower()))] if SIMPLE.fullmatch(c) else self.pieces(c)) + [b" "]]
            raw = b"".join(pieces)
            sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        raw = np.frombuffer(raw, dtype=np.uint8)
        ends = np.cumsum(sizes)
        gap = raw[ends - 1] == 32  # a piece never holds a space
        owner = (np.cumsum(gap) - gap)[~gap]
        ids, counts = self.merge(raw[raw != 32], sizes[~gap])
        of_chunk = np.bincount(owner, weights=counts, minlength=len(chunks)).astype(np.int64)
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(of_chunk)])

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the chunks of all texts in one array, and how many each text has."""
        if len(self.chunks) > self.kept:
            self.clear()
        texts = pc.fill_null(texts, "")
        marked = np.zeros(len(texts), dtype=bool)
        for name in self.special:
            marked |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        if marked.any():  # set special tokens apart; their text holds no white space
            texts = pc.if_else(pa.array(marked), pa.array(self.at_special.sub(r" \1 ", t) if m else "" for t, m in zip(texts.to_pylist(), marked.tolist(), strict=True)), texts)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.chunks.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        known = len(self.starts) - 1
        if len(self.chunks) > known:
            self.learn(list(islice(self.chunks, known, None)))
        return numbers[coded.indices.to_numpy()], np.diff(split.offsets.to_numpy())

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of every whole text; a null text has none."""
        flat, counts = self.numbers(texts)
        sums = np.r_[0, np.cumsum(np.diff(self.starts)[flat])]
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]

    def encode(self, texts: pa.Array, rows: int = 1_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For ``rows`` whole texts after the other: the first, the ids of all in one array, and how many each has."""
        flat, counts = self.numbers(texts)
        sizes = np.diff(self.starts)
        last = np.cumsum(counts)
        for first in range(0, len(counts), rows):
            own = counts[first : first + rows]
            begin = last[first] - counts[first]
            chunks = flat[begin : begin + own.sum()]
            ends = np.cumsum(sizes[chunks])
            total = int(ends[-1]) if len(ends) else 0
            shift = np.repeat(self.starts[chunks] - (ends - sizes[chunks]), sizes[chunks])
            sums, stops = np.r_[0, ends], np.cumsum(own)
            yield first, self.ids[shift + np.arange(total)], sums[stops] - sums[stops - own]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
