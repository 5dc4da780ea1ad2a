"""Two tokenizations against plain Python."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rulestream.llm import alignment
from rulestream.llm.alignment import Aligned, aligned_tokens, merged, packed, pair_counts, unpacked
from tests.llm.cases import ODD, frame, texts

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def both():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    entry = {i: bytes(letters[c] for c in e) for e, i in json.load(open(A))["model"]["vocab"].items() if all(c in letters for c in e)}
    processor = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        own = processor.id_to_piece(i)
        return bytes([int(own[3:5], 16)]) if processor.is_byte(i) else own.replace("▁", " ").encode()

    def encode(text):
        """(id, bytes) of the tokens of either side."""
        a = [(i, entry[i]) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
        return a, [(i, piece(i)) for i in processor.encode(text)]

    return encode


def plain(docs, encode):
    links, rows = Counter(), []
    for key, text in docs:
        a, b = encode(text) if text else ([], [])
        if any(b"".join(t for _, t in side) != (" " + (text or "")).encode() for side in (a, b)):
            a, b = [], []
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(i, e - len(t), e) for (i, t), e in zip(side, ends, strict=True)])
        own, at = Counter(), 0
        for i, x, y in spans[0]:
            while spans[1][at][2] <= x:
                at += 1
            k = at
            while k < len(spans[1]) and spans[1][k][1] < y:
                own[i, spans[1][k][0]] += 1
                k += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, low = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, _, e in side if low < e <= end) for side in spans))
            low = end
        told = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        links.update(own)
        rows.append((key, len(a), len(b), len(common), own, told))
    most = Counter()
    for (_, j), n in links.items():
        most[j] = max(most[j], n)
    return Counter(
        (key, n_a, n_b, n, sum(own.values()), sum(c for p, c in own.items() if links[p] == most[p[1]]), sum(c * links[p] for p, c in own.items()), told)
        for key, n_a, n_b, n, own, told in rows
    )


def rows_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.columns == names
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(("chunk", "block", "batch"), [(4 << 20, 8192, 1 << 18), (500, 3, 5)])
def test_like_plain_python(spark, monkeypatch, both, chunk, block, batch):
    """Also with many small chunks, whose runs have several blocks."""
    for name, value in (("CHUNK", chunk), ("BLOCK", block), ("BATCH", batch)):
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(2)
    docs = list(enumerate(texts(4, 60) + ["Größe naïve 日本 \U0001f44d! " * rng.randint(1, 4) for _ in range(5)]))
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    assert rows_of(aligned_tokens(df, A, B)) == plain(docs, both)


def test_odd_documents(spark, both):
    docs = [*ODD, (20, "▁ is the mark"), (21, " <s>x</s><unk> <0x0A>"), (22, "\n\n  a b﻿"), (23, "ｆｕｌｌ ① ́")]
    assert rows_of(aligned_tokens(frame(spark, docs), A, B)) == plain(docs, both)
    assert rows_of(aligned_tokens(frame(spark, docs).limit(0), A, B)) == Counter()
    nothing = [(1, None), (2, "")]
    assert rows_of(aligned_tokens(frame(spark, nothing), A, B)) == plain(nothing, both)


def test_digests_name_the_groups(both):
    aligned = Aligned(["", "hello wörld", None, "tokenization"], A, B)
    expected = {r[0]: r[-1] for r in plain(enumerate(["", "hello wörld", None, "tokenization"]), both)}
    assert aligned.digests() == [expected[i] for i in range(4)]


@pytest.mark.parametrize("seed", range(10))
def test_merged_runs_are_in_order_and_whole(seed, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH", 7)
    rng = np.random.default_rng(seed)
    runs, expected = [], Counter()
    for _ in range(rng.integers(1, 9)):
        keys = np.unique(rng.integers(0, 30, rng.integers(1, 20)))
        links = rng.integers(1, 9, len(keys))
        cuts = range(0, len(keys), 3)
        runs.append(([int(keys[c]) for c in cuts], [packed(np.diff(keys[c : c + 3], prepend=0), links[c : c + 3]) for c in cuts]))
        expected.update(dict(zip(keys.tolist(), links.tolist(), strict=True)))
    found, last = {}, -1
    for key, run, links in merged(runs):
        kinds, counts, place = pair_counts(key, links)
        assert kinds[0] > last and (kinds[place] == key).all() and len(run) == len(key)
        last = kinds[-1]
        found |= dict(zip(kinds.tolist(), counts.tolist(), strict=True))
    assert found == dict(expected)


def test_blocks_come_back():
    given = np.array([5, 2**40]), np.array([1, 2, 3], dtype=np.uint16), np.zeros(0, dtype=np.uint32)
    assert [c.tolist() for c in unpacked(packed(*given), np.int64, np.uint16, np.uint32)] == [c.tolist() for c in given]
