import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from odsflow.llm import simhash
from odsflow.llm.components import components
from odsflow.llm.simhash import fingerprint, hex_print, keep_one, near_duplicates, near_links

from .conftest import bag


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def brute_groups(rows, radius=3):
    prints = [brute_print(t) for _, t, *_ in rows]
    roots = brute_roots(set(prints), radius)
    least = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(roots[p])) for (doc_id, *_), p in zip(rows, prints)]


def test_fingerprints(rows):
    for _, text, *_ in rows:
        assert fingerprint((text or "").encode()) == brute_print(text)


def test_fingerprints_of_many_shingles(monkeypatch, rows):
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert all(fingerprint((t or "").encode()) == brute_print(t) for _, t, *_ in rows[:12])


def test_near_duplicates_match_all_pairs(docs, rows):
    found = near_duplicates(docs).select("doc_id", hex_print(F.col("print")), "component_id")
    assert bag(found.collect()) == bag(brute_groups(rows))


def test_near_duplicates_of_nothing(no_docs):
    assert near_duplicates(no_docs).collect() == []
    assert keep_one(no_docs).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(docs, rows):
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    groups = brute_groups(rows)
    expected = {c for _, _, c in groups if c is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == len({p for i, p, c in groups if c is None})


def near_family(n, seed):
    rng = random.Random(seed)
    base, found = rng.getrandbits(64), set()
    while len(found) < n:
        p = base
        for _ in range(rng.randint(0, 4)):
            p ^= 1 << rng.randrange(64)
        found.add(p)
    return found


@pytest.mark.parametrize("part,radius", [(4096, 3), (8, 3), (8, 1), (16, 4)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, part, radius):
    """Large slots, cut into pairs of parts, lose no link."""
    monkeypatch.setattr(simhash, "SLOT_PART", part)
    prints = near_family(90, 1) | near_family(30, 2) | {random.Random(3).getrandbits(64) for _ in range(40)} | {0, 7, (1 << 64) - 1}
    longs = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    stars = components(near_links(spark.createDataFrame(longs, "print long"), radius))
    roots = {r["node"]: r["root"] for r in stars.collect()}
    mask = (1 << 64) - 1
    groups, expected = {}, {}
    for (p,) in longs:
        groups.setdefault(roots.get(p, p), set()).add(p & mask)
    for p, r in brute_roots(prints, radius).items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_radius_zero_and_too_large(spark):
    prints = spark.createDataFrame([(1,), (2,)], "print long")
    assert near_links(prints, 0).collect() == []
    with pytest.raises(ValueError):
        near_links(prints, 16)


def test_components_of_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(40, 1), (100, 100), (200, 201), (201, 200), (-7, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "node long, root long")).collect()}
    assert found == {**{i: 1 for i in range(2, 41)}, 200: -7, 201: -7}
    assert components(spark.createDataFrame([], "node long, root long")).collect() == []
