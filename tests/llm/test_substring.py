"""Repeated passages against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rulestream.llm import substring
from rulestream.llm.fm_index import FMIndex, suffix_order
from rulestream.llm.substring import stretches, without_repeats
from tests.llm.cases import ODD, frame

SPACE = re.compile("[ \t-\r]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def plain(texts, window):
    """(words, words removed, digest of the rest) per text."""
    words = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for own in words:
        gone = {j for i in range(len(own) - window + 1) if seen[tuple(own[i : i + window])] > 1 for j in range(i, i + window)}
        rest = " ".join(w for j, w in enumerate(own) if j not in gone)
        out.append((len(own), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def corpus(seed, many=40):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)]
    passages = [draw(rng.randint(5, 40)) for _ in range(4)]
    texts = []
    for _ in range(many):
        parts = [draw(rng.randint(0, 30)), rng.choice(passages), draw(rng.randint(0, 30))]
        rng.shuffle(parts)
        texts.append(rng.choice([" ", "\n", "\t "]).join(w for part in parts[: rng.randint(0, 3)] for w in part))
    return texts + texts[:3] + ["x " * 300, "x y " * 90, "one  two", "\x1c a \x85 b"]


@pytest.mark.parametrize("seed", range(30))
def test_index_finds_what_occurs_twice(seed):
    rng = random.Random(seed)
    window = rng.randint(1, 5)
    sequences = [[rng.randrange(rng.choice([1, 2, 6])) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(0, 7))]
    weights = [rng.choice([1, 1, 2]) for _ in sequences]
    symbols = np.array([s for q in sequences for s in q], dtype=np.int64)
    lengths = np.array([len(q) for q in sequences], dtype=np.int64)
    found = [set() for _ in sequences]
    if sequences:
        index = FMIndex(symbols, lengths, np.array(weights))
        for which, start, stop in zip(*index.repeated(2, window), strict=True):
            found[which] |= set(range(start, stop))
    seen = Counter()
    for q, weight in zip(sequences, weights, strict=True):
        for i in range(len(q) - window + 1):
            seen[tuple(q[i : i + window])] += weight
    expected = [
        {j for i in range(len(q) - window + 1) if seen[tuple(q[i : i + window])] > 1 for j in range(i, i + window)} for q in sequences
    ]
    assert found == expected


def test_order_of_suffixes():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 3, 200), 0)
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_every_window_lies_in_one_stretch_and_equal_ones_share_a_key():
    texts = corpus(1)
    text, at, many, key, places = stretches(pa.array(texts), 9)
    keys, windows = {}, Counter()
    for t, first, n, k, p in zip(text, at, many, key, places, strict=True):
        own = [tuple(words_of(texts[t])[i : i + 9]) for i in range(first, first + n)]
        windows.update((t, i) for i in range(first, first + n))
        assert all(keys.setdefault(w, k) == k and len(w) == 9 for w in own)
        assert p > 1 or len(set(own)) == len(own)
    assert set(windows.values()) == {1}
    assert len(windows) == sum(max(0, len(words_of(t)) - 8) for t in texts)


@pytest.mark.parametrize("hot", [2_000, 3, 0])
def test_like_plain_python(spark, monkeypatch, hot):
    """Also where keys are hot, and with several shards."""
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD", 50)
    texts = corpus(7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    rows = without_repeats(docs, 9).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == plain(texts, 9)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in rows)
    assert 0 < sum(r.n_removed for r in rows) < sum(r.n_words for r in rows)


def test_odd_documents(spark):
    rows = without_repeats(frame(spark, [*ODD, *ODD])).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    texts = [t for _, t in [*ODD, *ODD]]
    expected = Counter((k, *r) for (k, _), r in zip([*ODD, *ODD], plain(texts, 35), strict=True))
    assert Counter(map(tuple, rows)) == expected


def test_no_documents_and_names_that_clash(spark):
    schema = "doc_id int, text string, _first string, kept string, n_words string, _null string"
    assert without_repeats(spark.createDataFrame([], schema)).collect() == []
    row = without_repeats(spark.createDataFrame([(1, None, "a", "b", "c", "d")], schema)).first()
    assert (row.doc_id, row["_first"], row["_null"], row.kept, row.n_words) == (1, "a", "d", "", 0)
