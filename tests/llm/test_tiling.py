from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulestream.llm.tiling import contaminated, matches, plain, tiles
from tests.llm.cases import ODD, frame, texts


def plain_tiles(doc, item, shortest):
    """Greedy tiling by trying all runs: the covered number of item tokens."""
    doc, item, covered = list(doc), list(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] >= 0:
                    n += 1
                best = max(best, (n, -a, -b))
        n, a, b = best[0], -best[1], -best[2]
        if n < shortest:
            return covered
        covered += n
        doc[a : a + n], item[b : b + n] = [-1] * n, [-2] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=15))
def test_matches_are_all_maximal_common_runs(doc, item):
    found = {(n, a, b) for n, a, b in matches(doc, item, 3)}
    for n, a, b in found:
        assert doc[a : a + n] == item[b : b + n]
    for a in range(len(doc) - 2):
        for b in range(len(item) - 2):
            if doc[a : a + 3] == item[b : b + 3]:
                assert any(x <= a and a + 3 <= x + n and a - x == b - y for n, x, y in found)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32))
def test_tiles_are_the_longest_first_and_never_overlap(seed):
    rng = random.Random(seed)
    item = [rng.randrange(60) for _ in range(30)]
    cut = sorted(rng.sample(range(1, 30), 2))
    parts = [item[: cut[0]], item[cut[0] : cut[1]], item[cut[1] :]]
    rng.shuffle(parts)
    doc = [x for p in parts for x in [*p, 99, 98]]
    marked = tiles(doc, item, 3)
    for a, b, n in marked:
        assert doc[a : a + n] == item[b : b + n]
    for side in (0, 1):
        places = [x for m in marked for x in range(m[side], m[side] + m[2])]
        assert len(places) == len(set(places))
    assert [n for _, _, n in marked] == sorted((n for _, _, n in marked), reverse=True)
    if len(set(item)) == len(item):
        assert sum(n for _, _, n in marked) == plain_tiles(doc, item, 3)


@pytest.fixture(scope="module")
def items():
    return texts(11, 30, 40)


def test_planted_items_are_found_in_any_order_and_clean_texts_are_not(spark, items):
    rng, rows, expected = random.Random(3), list(ODD), set()
    clean = texts(12, 120, 200)
    for i, text in enumerate(clean):
        rows.append((100 + i, text))
    for k, item in enumerate(items):
        words = item.split()
        if len(words) < 15:
            continue
        third = len(words) // 3
        parts = [words[:third], words[third : 2 * third], words[2 * third :]]
        rng.shuffle(parts)
        body = clean[k].split()
        at = rng.randrange(len(body) + 1)
        moved = [w.upper() + "," for p in parts for w in p]
        rows.append((1000 + k, " ".join([*body[:at], *moved, *body[at:]])))
        expected.add((1000 + k, k))
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, ""), (97, "of the and")], "item_id BIGINT, text STRING")
    found = contaminated(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    token = {k: [w for w in map(plain, t.split()) if w] for k, t in enumerate(items)}
    body = {d: [w for w in map(plain, (t or "").split()) if w] for d, t in rows}
    for r in found:
        assert r.coverage == sum(t.length for t in r.tiles) / r.item_words >= 0.6
        for t in r.tiles:
            own = body[r.doc_id][t.doc_start : t.doc_start + t.length]
            assert own == token[r.item_id][t.item_start : t.item_start + t.length]
    blocks = contaminated(frame(spark, rows), bench, block=300).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == expected


def test_little_coverage_repeats_and_empty_tables(spark, items):
    item = next(t for t in items if len(t.split()) >= 30)
    bench = spark.createDataFrame([(1, item), (1, item)], "item_id BIGINT, text STRING")
    half = " ".join(item.split()[: len(item.split()) // 3])
    rows = [(1, half + " and more"), (2, item), (2, item), (None, f"{item} {item}")]
    found = contaminated(frame(spark, rows), bench).collect()
    assert sorted((r.doc_id or 0, r.coverage) for r in found) == [(0, 1.0), (0, 1.0), *[(2, 1.0)] * 4]
    assert contaminated(frame(spark, []), bench).collect() == []
    assert contaminated(frame(spark, rows), bench.limit(0)).collect() == []


def test_short_items_are_found_whole_and_items_of_one_text_once_each(spark):
    bench = [(1, "one"), (2, "Key AT, all"), (3, "!?"), (4, "key no at all"), (5, "one"), (None, "key at all"), (6, "key at all\x20")]
    found = contaminated(frame(spark, ODD), spark.createDataFrame(bench, "item_id BIGINT, text STRING")).collect()
    pairs = sorted((r.doc_id or 0, r.item_id or 0, r.item_words, r.coverage) for r in found)
    assert pairs == sorted(
        [(0, i, 3, 1.0) for i in (0, 2, 6)] + [(d, i, 1, 1.0) for d in (3, 4, 4) for i in (1, 5)]
    )
