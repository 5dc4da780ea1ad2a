"""Ranked search against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rulestream.llm import lexical
from rulestream.llm.lexical import Best, Queries, coded_terms, search_bucket, top_documents
from tests.llm.cases import ODD, frame

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, best=10):
    """Rows of (item, rank, document, score)."""
    held = [(key, Counter(terms_of(text))) for key, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    many, total = sum(n > 0 for n in sizes), sum(sizes)
    holding = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (key, tf), n in zip(held, sizes, strict=True):
            score = 0
            for term, often in Counter(terms_of(text)).items():
                if tf[term]:
                    weight = math.floor(1000 * math.log((2 * many + 2) / (2 * holding[term] + 1)))
                    score += often * weight * ((1000000000 * tf[term]) // (1000 * tf[term] + 8 * (25 + 75 * n * many // total)))
            if score:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:best], start=1)]
    return out


def corpus(seed, many):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé日Z7", k=rng.randint(1, 3))) for _ in range(120)]
    weights = [1 / (i + 1) for i in range(len(words))]
    draw = lambda n: ", ".join(rng.choices(words, weights, k=n))
    docs = [(i, draw(rng.randint(0, 60))) for i in range(many)]
    docs += [(many + i, docs[i][1]) for i in range(20)]
    items = [(f"i{i}", draw(rng.randint(1, 12))) for i in range(25)] + [(f"j{i}", docs[i][1]) for i in range(4)]
    return docs, items


def test_terms_of_odd_texts():
    texts = ["Ab-Cd_ef ÀB9\x7fx", None, "", " a\x85b", "日本語 K"]
    distinct, codes, counts = coded_terms(pa.array(texts).slice(0, 5))
    assert [[distinct[c] for c in part] for part in np.split(codes, np.cumsum(counts)[:-1])] == [terms_of(t) for t in texts]
    distinct, codes, counts = coded_terms(pa.array(texts).slice(3, 2))
    assert [distinct[c] for c in codes] == [t for text in texts[3:] for t in terms_of(text)]


@pytest.mark.parametrize(("bucket", "block"), [(4096, 4 << 20), (7, 150)])
def test_like_plain_python(spark, monkeypatch, bucket, block):
    """Also with small buckets, which are pruned, and with items in several blocks."""
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "BLOCK", block)
    docs, items = corpus(5, 400)
    found = top_documents(
        spark.createDataFrame(docs, "doc_id int, text string").repartition(4), spark.createDataFrame(items, "item_id string, text string")
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(plain(docs, items))


@pytest.mark.parametrize("seed", range(5))
def test_bounds_leave_out_nothing(seed, monkeypatch):
    """The best of one bucket after another, sorted by length, are those of all vectors."""
    rng = np.random.default_rng(seed)
    queries = Queries({i: " ".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for i in range(20)})
    dense = rng.integers(0, 50, (300, len(queries.vocabulary))) * (rng.random((300, len(queries.vocabulary))) < 0.4)
    dense = dense[dense.any(axis=1)]
    norms = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-norms)
    best = [Best(5, 0) for _ in queries.terms]
    for begin in range(0, len(order), 20):
        rows = order[begin : begin + 20]
        where = [np.flatnonzero(dense[r]) for r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in where])])
        ids = np.concatenate(where)
        impacts = np.concatenate([dense[r][w] for r, w in zip(rows, where, strict=True)])
        search_bucket(pa.array(rows), norms[rows], offsets, ids, impacts, queries, best)
    for (terms, counts), own in zip(queries.terms, best, strict=True):
        scores = (dense[:, terms] * counts).sum(axis=1)
        expected = sorted((-s, r) for r, s in enumerate(scores.tolist()) if s > 0)[:5]
        assert [(s, k) for s, _, k in own.rows] == expected


def test_odd_documents_and_items(spark):
    docs = [*ODD, (20, "ONE one smile"), (21, "one, one; smile"), (None, "one smile")]
    items = [("a", "one"), ("a", "one"), (None, "SMILE word"), ("n", None), ("e", ""), ("x", "nowhere"), ("c", "café one")]
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, rank int")
    found = top_documents(frame(spark, docs), asked, best=3).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain(docs, items, 3), key=str)


def test_no_documents_or_no_items(spark):
    docs, items = "doc_id int, text string", "item_id int, text string"
    some_docs, some_items = spark.createDataFrame([(1, "a b")], docs), spark.createDataFrame([(1, "a")], items)
    assert top_documents(spark.createDataFrame([], docs), some_items).collect() == []
    assert top_documents(some_docs, spark.createDataFrame([], items)).collect() == []
    assert top_documents(some_docs, some_items).count() == 1
