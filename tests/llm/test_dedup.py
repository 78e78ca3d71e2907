"""Exact and SimHash deduplication, and graph components, against plain versions."""

import numpy as np
import pytest
from helpers import SF, ascii_lower, awkward, documents, empty, grouped, linked, simhash
from pyspark.sql import functions as F

from pollpipe.llm import QUERIES, common, exact, simhash as operator
from pollpipe.llm.components import components


@pytest.mark.parametrize("bits", [24, 6])
def test_exact_groups(spark, bits):
    docs = awkward(spark)
    rows = exact.exact_groups(docs, bits=bits).collect()
    assert len(rows) == docs.count()
    texts = grouped(docs.collect(), lambda r: ascii_lower(r.text))
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(texts)
    sizes = {max((r.doc_id for r in g if r.doc_id is not None), default=None): len(g) for g in texts.values()}
    for r in rows:
        if r.keep_id is not None:
            assert r.group_size == sizes[r.keep_id]
        assert not r.kept or r.doc_id == r.keep_id


def test_exact_carry_and_empty(spark):
    assert exact.exact_groups(empty(spark)).count() == 0
    row = exact.exact_groups(awkward(spark), carry={"what": F.upper("text")}).where("doc_id = 9").first()
    assert row.what == "X"


def test_exact_same_prefix_and_length(spark):
    head = "a" * exact.PREFIX
    docs = spark.createDataFrame([(1, head + "b"), (2, head + "c"), (3, head.upper() + "C"), (4, "é" + head[2:]), (5, "É" + head[2:])], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_groups(docs).collect()}
    assert got == {1: (1, 1), 2: (3, 2), 3: (3, 2), 4: (4, 1), 5: (5, 1)}


def test_filter_flags_every_key_and_few_others(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    rows = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    for bits, most in ((24, 10), (6, 2000)):
        places = common.places_of(keys, "test-places", bits)
        assert places.count() <= max(1, 2**bits // 64)
        got = {r.a for r in common.flagged(rows, ("a", "b"), places, "hit", bits).where("hit").collect()}
        assert got >= set(range(0, 3000, 3))
        assert len(got) - 1000 <= most
    none = common.places_of(keys.limit(0), "test-places")
    assert common.flagged(rows, ("a", "b"), none, "hit").where("hit").count() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    pairs += [(2000, 2001 + i) for i in range(200)]
    links = spark.createDataFrame([*pairs, (None, 5), (5, None)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    joined = {frozenset(p) for p in pairs}
    values = {v for p in pairs for v in p}
    expected = linked(values, lambda a, b: frozenset((a, b)) in joined)
    assert got == {k: expected[k] for k in got}
    assert set(got) == values
    assert components(links.limit(0)).count() == 0


def test_fingerprint_equals_plain_version(spark):
    for _, text in documents()[:150]:
        assert operator.fingerprint_of(text) == simhash(text)
    for text in (None, "", " \t\n\x0b\x0c\r", "One", "one two", "a\x85b c\x1cd é", "A b c D e f"):
        assert operator.fingerprint_of(text) == simhash(text)
    hashed = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert operator.fingerprint_of("One  two\nthree") == hashed % 2**64


@pytest.mark.parametrize("seed", range(4))
def test_close_pairs(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (40, 12)).astype(np.uint64))
    a = np.unique(np.r_[base, near.ravel(), near.ravel() ^ np.uint64(5)])
    b = np.unique(rng.permutation(a)[:200] ^ np.uint64(1 << 33))
    for left, right in ((a, a), (a, b)):
        got = sorted((int(i), int(j)) for x, y in operator.close_pairs(left, right, 64, 2) for i, j in zip(x, y, strict=True))
        all_pairs = [(i, j) for i in range(len(left)) for j in range(len(right)) if (int(left[i]) ^ int(right[j])).bit_count() <= 2]
        expected = [(i, j) for i, j in all_pairs if left is not right or i < j]
        assert sorted((min(p), max(p)) if left is right else p for p in got) == expected


@pytest.mark.parametrize("limit", [2_000_000, 40])
def test_near_links_reach_all_components(spark, limit):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    values = {int(x) for x in base} | {0, 2**64 - 1, 2**64 - 2}
    for b in base[:6]:  # dense clusters, in one node far down the trie
        values |= {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for i, j in rng.integers(0, 64, (40, 2))}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "f long")
    links = operator.near_links(frame, 2, limit).collect()
    expected = linked(signed, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {v: got.get(v, v) for v in signed} == expected


def test_simhash_query(spark):
    docs = documents()
    prints = {i: simhash(t) for i, t in docs}
    roots = linked(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for i, f in sorted(prints.items()):
        smallest.setdefault(roots[f], i)
    rows = QUERIES["op8_simhash_groups"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{f:016x}", smallest[roots[f]]) for i, f in prints.items()}


@pytest.mark.parametrize("bits", [24, 6])
def test_simhash_awkward(spark, bits):
    docs = awkward(spark)
    rows = operator.simhash_groups(docs, keep=("text", "key"), bits=bits).collect()
    assert len(rows) == docs.count()
    groups = grouped(rows, lambda r: r.component_id)
    assert all(sum(r.first for r in g) == 1 for k, g in groups.items() if k is not None)
    assert {r.fingerprint for r in rows if not (r.text or "").strip()} == {0}
    assert operator.simhash_groups(empty(spark)).count() == 0
