from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rulestream.llm.merging import Encoder
from rulestream.llm.packing import OpenBins, pack_documents, packing_plan
from rulestream.llm.tokens import count_tokens
from tests.llm.cases import ODD, frame, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def encoded(encoder, rows):
    out, texts = [], pa.array(rows, type=pa.large_string())
    for first, ids, counts in encoder.encode(texts, rows=7):
        assert first == len(out)
        ends = np.cumsum(counts)
        out += [ids[b - n : b].tolist() for b, n in zip(ends, counts, strict=True)]
    assert encoder.count(texts).tolist() == list(map(len, out))
    return out


def test_ids_of_odd_texts_and_of_every_character(encoder, library):
    rows = [t or "" for _, t in ODD] + texts(1, 200)
    rows += ["It's DON'T we'll x'S", "½ ² ³ ª º µ ß ĳ ǆ", "é ́x ậ", "ΣΑΣ İ ſ K", "12345 ١٢٣", "À̖́", "12 34 5"]
    rows += [chr(i) + "a" + chr(i) + chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    rows += [" ".join(map(chr, range(i, i + 64))) for i in range(0x3100, 0xD7C0, 64)]
    expected = [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]
    assert encoded(encoder, rows) == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbBeE nN\n'ts.-_1é<|>́ Σ\x1c")), max_size=5))
def test_ids_of_any_text(encoder, library, rows):
    assert encoded(encoder, rows) == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]


def test_a_store_that_is_full_starts_anew(library):
    small, rows = Encoder(PATH, kept=50), texts(2, 60)
    for i in range(0, 60, 10):
        part = rows[i : i + 10]
        assert encoded(small, part) == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_counts_row_by_row(spark, library):
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts(3, 50))]
    found = count_tokens(frame(spark, rows), PATH).collect()
    expected = Counter((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    assert Counter((r.doc_id, r.n_tokens) for r in found) == expected
    assert count_tokens(frame(spark, []), PATH).count() == 0


def best_fit(lengths, limit):
    """What the bins of best-fit decreasing hold, one piece after the other. Ties of bins make no difference to it."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in bins if sum(b) + length <= limit]
        if fitting:
            max(fitting, key=sum).append(length)
        else:
            bins.append([length])
    return Counter(map(sum, bins))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_the_plan_is_best_fit_decreasing(lengths):
    bins = defaultdict(list)
    for step in packing_plan(Counter(lengths), 30):
        n = step["_to"] - step["_from"]
        for i in range(n):
            offset = step["_offset"] + i % step["_each"] * step["length"]
            assert offset == sum(bins[step["_bin"] + i // step["_each"]])
            bins[step["_bin"] + i // step["_each"]].append(step["length"])
    assert Counter(map(sum, bins.values())) == best_fit(lengths, 30)
    assert sorted(bins) == list(range(len(bins)))


def test_the_tree_finds_the_tightest_bin():
    bins = OpenBins(100)
    for room in (5, 17, 64, 99, 100):
        bins.add(room, room, 2)
    assert [bins.tightest(s) for s in (1, 5, 6, 18, 65, 100)] == [5, 5, 17, 64, 99, 100]
    assert bins.take(64) == (64, 2)
    assert bins.tightest(18) == 99


def test_every_piece_has_its_place(spark, library):
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts(4, 300, 300))]
    found = pack_documents(frame(spark, rows), PATH, 256).collect()
    expected, lengths = Counter(), []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            lengths.append(len(part))
            expected[key, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        ends = 0
        for offset, length in sorted(content):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert len(bins) == sum(best_fit(lengths, 256).values())


def test_no_documents(spark):
    assert pack_documents(frame(spark, []), PATH, 256).collect() == []
