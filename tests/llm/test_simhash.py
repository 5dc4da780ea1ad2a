from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from rulestream.llm.components import components
from rulestream.llm.simhash import BLOCK, Grid, fingerprint, near_duplicates
from tests.llm.cases import ODD, changed, frame, texts


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    up = {v: v for v in values}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= distance:
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


def near(rng, value, most):
    for bit in rng.sample(range(64), rng.randint(0, most)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize(("distance", "equal"), [(0, 4), (2, 4), (4, 4), (4, 5), (4, 6)])
def test_grid_loses_no_link(spark, distance, equal):
    rng = random.Random(distance)
    seeds = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    values = sorted({near(rng, s, 6) for s in seeds for _ in range(rng.choice((1, 2, 5, 60)))})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = Grid(distance, equal).edges(spark.createDataFrame([(v,) for v in signed], "_fp BIGINT"))
    found = {r.a % 2**64: r.b % 2**64 for r in edges.collect()}
    links = [(r.a % 2**64, r.b % 2**64) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in links)
    up = {v: v for v in values}
    for _ in range(len(values)):
        before = dict(up)
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
        if before == up:
            break
    expected = plain_components(values, distance)
    smallest = {v: min(w for w in values if expected[w] == expected[v]) for v in values}
    assert up == smallest and (found or distance == 0)


def test_cells_get_finer_with_more_fingerprints():
    sizes = [Grid.of_size(4, 10**n).equal for n in range(13)]
    assert sizes[:8] == [4] * 8 and sizes == sorted(sizes) and sizes[11] > sizes[8]
    assert Grid.of_size(28, 10**12).equal == 4


def test_a_large_cell_gives_a_spanning_forest():
    rng = random.Random(5)
    center = rng.getrandbits(64)
    members = np.array(sorted({near(rng, center, 2) for _ in range(800)}), dtype=np.uint64)
    a, b = Grid(4).forest(members)
    assert len(a) == len(members) - 1 == len(set(a.tolist()) | set(b.tolist())) - 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    random.Random(1).shuffle(chain)
    found = components(spark.createDataFrame(chain + star, "a BIGINT, b BIGINT")).collect()
    assert {r.node: r.label for r in found} == {i: 100 for i in range(100, 161)} | {i: 5 for i in (5, *range(200, 260))}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []


def test_rows_like_brute_force(spark):
    rng, rows = random.Random(2), list(ODD)
    for i, text in enumerate(texts(6, 60, 120)):
        rows += [(100 + 10 * i + k, changed(text, rng, k)) for k in range(rng.choice((1, 3, 6)))]
    rows += [(2000 + i, rows[20][1]) for i in range(40)]
    found = near_duplicates(frame(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in found) == Counter(
        (d, f"{p:016x}") for (d, _), p in zip(rows, prints, strict=True)
    )
    root = plain_components(sorted(set(prints)))
    smallest = {}
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            smallest[root[p]] = min(smallest.get(root[p], d), d)
    expected = Counter((d, smallest.get(root[p])) for (d, _), p in zip(rows, prints, strict=True))
    assert Counter((r.doc_id, r.component_id) for r in found) == expected
    assert near_duplicates(frame(spark, [])).collect() == []


def test_long_texts_are_counted_in_blocks():
    text = " ".join(texts(7, 1, 40)[0].split() * 4000)
    assert len(text.split()) > BLOCK // 8
    assert fingerprint(text, 4) == plain_fingerprint(text)
