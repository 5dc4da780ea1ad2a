"""The registered queries over whole tables, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from rulestream.llm.queries import ORACLES, QUERIES, SEQUENCE, VOCABULARY, table
from tests.llm.test_secrets import looks_live, plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_sketch import expected as plain_sketch


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.001", "documents").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def ids(docs):
    library = Tokenizer.from_file(VOCABULARY)
    return {d.doc_id: e.ids for d, e in zip(docs, library.encode_batch([d.text or "" for d in docs], add_special_tokens=False), strict=True)}


def rows_of(spark, sf, name, columns):
    found = QUERIES[name](spark, sf)
    assert found.columns[: len(columns.split())] == columns.split()
    return found.collect()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)


def test_op1(spark, sf, docs):
    rows = rows_of(spark, sf, "op1_sharding", "doc_id size text_crc32 law shard slot grown_shard")
    raw = {d.doc_id: (d.text or "").encode() for d in docs}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(k, len(t) + 16, zlib.crc32(t)) for k, t in raw.items()}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_op2(spark, sf, docs, ids):
    rows = rows_of(spark, sf, "op2_token_counts", "doc_id n_bytes n_tokens over_limit")
    expected = {(d.doc_id, len((d.text or "").encode()), len(ids[d.doc_id]), len(ids[d.doc_id]) > SEQUENCE) for d in docs}
    assert set(map(tuple, rows)) == expected and len(rows) == len(docs)


def test_op3(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").collect()
    rows = rows_of(spark, sf, "op3_secret_scans", "doc_id n_assign n_access n_hex base_sha256 spans")
    found = {r.doc_id: r for r in rows}
    owners = defaultdict(set)
    for d in docs:
        for span in plain_spans(d.text):
            owners[span[4]].add(d.source)
    for d in docs:
        spans, r = plain_spans(d.text), found[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        base = [f"{k}:{a}:{b}" for a, _, k, b, *_ in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        parts = [p for p in r.spans.split(",") if p]
        assert [p for p in parts if not p.startswith(("owned", "copied"))] == base
        added = {(v, a, b) for *_, v, a, b in spans if len(owners[v]) >= 3 or looks_live(v)}
        assert len(parts) == len(base) + len({(a, b) for _, a, b in added})
    assert len(rows) == len(docs) and any(r.spans for r in rows)


def test_op4(spark, sf):
    rows = rows_of(spark, sf, "op4_warc", "page_id payload_bytes payload_digest record_type refers_to")
    first, expected = {}, Counter()
    for page in table(spark, sf, "pages").orderBy("page_id").collect():
        raw = (page.html or "").encode()
        to = first.setdefault(raw, page.page_id)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = ("response", None) if to == page.page_id else ("revisit", to)
        expected[page.page_id, len(raw), digest, *kind] += 1
    assert Counter(map(tuple, rows)) == expected


def test_op5(spark, sf, docs):
    rows = rows_of(spark, sf, "op5_benchmark_decontamination", "doc_id item_id item_words coverage")
    items = {r.item_id: r.text.split() for r in table(spark, sf, "benchmark").collect()}
    text = {d.doc_id: " ".join((d.text or "").split()) for d in docs}
    planted = {(d, i) for d, t in text.items() for i, words in items.items() if " ".join(words) in t}
    assert planted <= {(r.doc_id, r.item_id) for r in rows}
    assert len({r.doc_id for r in rows}) <= 0.1 * len(docs)
    assert all(0.6 <= r.coverage <= 1 for r in rows)


def test_op6(spark, sf, docs):
    rows = rows_of(spark, sf, "op6_simhash_near_dedup", "doc_id fingerprint component_id")
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    root, smallest = plain_components(sorted(set(prints.values()))), {}
    for key, value in prints.items():
        smallest[root[value]] = min(smallest.get(root[value], key), key)
    assert set(map(tuple, rows)) == {(k, f"{v:016x}", smallest[root[v]]) for k, v in prints.items()}


def test_op7(spark, sf, docs):
    rows = rows_of(
        spark, sf, "op7_document_fingerprints", "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"
    )
    found = Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)
    assert found == plain_sketch([(d.doc_id, d.text) for d in docs])
    assert np.mean([r.near_edited for r in rows]) > 0.2 > 0.05 > np.mean([r.near_next for r in rows])


def test_op8(spark, sf, docs):
    rows = rows_of(spark, sf, "op8_lm_scoring", "doc_id n_words log_likelihood mean_log_chance")
    assert {(r.doc_id, r.n_words) for r in rows} == {(d.doc_id, len((d.text or "").split())) for d in docs}
    assert all(r.log_likelihood <= 0 for r in rows)


def test_op9(spark, docs):
    sf = "/root/testdata/sf0.01"
    rows = rows_of(spark, sf, "op9_toxicity", "doc_id held_out score predicted")
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in own) >= 0.95 * len(own) > 50


def test_op10(spark, sf, docs, ids):
    rows = rows_of(spark, sf, "op10_best_fit_packing", "doc_id piece start length ids_crc32 sequence_id offset")
    expected, bins = set(), defaultdict(list)
    for d in docs:
        own = [*ids[d.doc_id], 0]
        for piece, start in enumerate(range(0, len(own), SEQUENCE)):
            part = own[start : start + SEQUENCE]
            expected.add((d.doc_id, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        content.sort()
        assert [o for o, _ in content] == [sum(n for _, n in content[:i]) for i in range(len(content))]
        assert sum(n for _, n in content) <= SEQUENCE
    total = sum(r.length for r in rows)
    assert len(bins) <= 1.02 * total / SEQUENCE + 1
