from __future__ import annotations

import numpy as np
import pytest
import xxhash
from samples import AWKWARD, awkward, clashing, empty, given, pairs

from tallyhouse.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    """Smallest index reachable over pairs of fingerprints at most four bits apart."""
    bits = np.array(prints, dtype=np.uint64)
    root = np.arange(len(bits))
    links = [
        (i, j)
        for i in range(len(bits))
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 4) + i + 1
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(root[i], root[j])
            changed |= root[i] != low or root[j] != low
            root[i] = root[j] = low
    return root.tolist()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clusters(seed=3):
    rng = np.random.default_rng(seed)
    prints = {0, 1, 2**63, 2**64 - 1, 31, 992}
    for _ in range(25):
        x = int(rng.integers(0, 2**63))
        for _ in range(20):
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(b)
            prints.add(x)
    return sorted(prints)


@pytest.mark.parametrize("node_rows", [1_000_000, 3])
def test_trie_join_finds_all_links(spark, node_rows):
    prints = clusters()
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    root = {r.fp: r.root for r in simhash.classes(df, node_rows).collect()}
    expected = brute_roots(prints)
    groups = {}
    for p, r in zip(prints, expected):
        groups.setdefault(r, set()).add(root[signed(p)])
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_every_single_budget_of_bits(spark):
    """Pairs exactly 4 and 5 bits apart, the bits spread over the fifths in every way."""
    rng = np.random.default_rng(5)
    for width, linked in ((4, True), (5, False)):
        for _ in range(40):
            a = int(rng.integers(0, 2**63))
            b = a
            for bit in rng.choice(64, width, replace=False):
                b ^= 1 << int(bit)
            bits = np.array(sorted([a, b]), dtype=np.uint64)
            found = False
            for first, depth in simhash.FIFTHS:
                turned = np.sort((bits << np.uint64(first)) | (bits >> np.uint64(64 - first))) if first else bits
                if turned[0] >> np.uint64(64 - depth) == turned[1] >> np.uint64(64 - depth):
                    label = simhash.traverse(turned, np.array([[0, 2, 0, 2]]), depth)
                    found |= label[1] == 0
            assert found == linked


def test_given_documents(spark):
    docs = given().head(400)
    prints = [plain(t) for t in docs.text]
    ids = docs.doc_id.tolist()
    expected = [(i, f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, brute_roots(prints))]
    found = simhash.near_copies(spark.createDataFrame(docs[["doc_id", "text"]]))
    assert pairs(found, "doc_id", "fingerprint", "component_id") == sorted(expected, key=str)


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        found = simhash.near_copies(docs).collect()
        assert len(found) == len(AWKWARD)
        expected = {row[0]: f"{plain(row[1]):016x}" for row in AWKWARD if row[0] is not None}
        assert all(r.fingerprint == expected[r.doc_id] for r in found if r.doc_id is not None)
        component = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
        assert component[9] == 1 and component[3] == component[5] == component[2] == 2
    assert simhash.near_copies(empty(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    for docs in (awkward(spark), clashing(spark)):
        kept = simhash.drop_near_copies(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 6, 7, 8, 10, 2**62]
    assert simhash.drop_near_copies(empty(spark)).count() == 0
    same = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "a b")], "doc_id long, text string")
    assert pairs(simhash.drop_near_copies(same), "doc_id", "text") == [(4, "a b")]
