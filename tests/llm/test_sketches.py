from __future__ import annotations

import hashlib

import numpy as np
import pytest
from samples import AWKWARD, awkward, clashing, empty, given

from tallyhouse.llm import sketches


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_strings_round_trip():
    for text in [*given().text[:50], "", "one"]:
        own = sketches.sketch(text)
        assert np.array_equal(sketches.from_text(sketches.to_text(own)), own)
        assert len(sketches.to_text(own)) == 8 * min(len(shingles(text)), sketches.K)


def test_small_sketches_are_exact_and_large_ones_close():
    texts = given().text[:300].tolist()
    errors = []
    for a, b in zip(texts, texts[1:]):
        half = a[: len(a) // 2] + b
        x, y = shingles(a), shingles(half)
        own, other = sketches.sketch(a), sketches.sketch(half)
        error = sketches.resemblance(own, other) - jaccard(x, y)
        assert len(x | y) > sketches.K or error == pytest.approx(0)
        errors += [error, sketches.distinct(own) / len(x) - 1]
        # A text much shorter than the other leaves too few common hashes to say more.
        if len(y) < 2 * len(x):
            assert abs(sketches.containment(own, other) - len(x & y) / len(x)) < 0.25
    assert np.abs(errors).max() < 0.25 and np.abs(errors).mean() < 0.04


def test_parts_merge_in_any_order():
    words = [f"w{i % 700}" for i in range(3000)]
    parts = [" ".join(words[at : at + 604]) for at in range(0, 3000, 600)]
    whole = sketches.sketch(" ".join(words))
    own = [sketches.sketch(p) for p in parts]
    assert np.array_equal(sketches.merged(*own), whole)
    assert np.array_equal(sketches.merged(own[3], sketches.merged(*own[:3]), own[4]), whole)


def test_merging_by_key(spark, monkeypatch):
    monkeypatch.setattr(sketches, "KEYS_HELD", 2)
    texts = given().text[:200].tolist()
    rows = [(None if i % 5 == 4 else i % 5, sketches.to_text(sketches.sketch(t))) for i, t in enumerate(texts)]
    found = sketches.merge_sketches(spark.createDataFrame(rows, "k long, sketch string"), "k").collect()
    assert len(found) == 5
    for r in found:
        own = [sketches.sketch(t) for i, t in enumerate(texts) if (None if i % 5 == 4 else str(i % 5)) == r.key]
        assert r.sketch == sketches.to_text(sketches.merged(*own))


def expected(docs):
    """docs: (doc_id, text) in the order of their successors."""
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        yield doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("range_bytes", [1 << 30, 20_000])
def test_next_documents(spark, monkeypatch, range_bytes):
    docs = given().head(300)
    original = sketches.in_order
    monkeypatch.setattr(sketches, "in_order", lambda d, i, t: original(d, i, t, range_bytes))
    shuffled = docs.sample(frac=1, random_state=2)[["doc_id", "text"]]
    found = sketches.compare_edited(spark.createDataFrame(shuffled)).collect()
    rows = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found)
    assert rows == sorted(expected(list(zip(docs.doc_id.tolist(), docs.text.tolist()))))
    own = {r.doc_id: r for r in found}
    text = dict(zip(docs.doc_id, docs.text))
    assert all(own[i].fingerprint == sketches.to_text(sketches.sketch(text[i])) for i in own)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        found = sketches.compare_edited(docs).collect()
        assert len(found) == len(AWKWARD)
        plain = order([(i, t or "") for i, t, *_ in AWKWARD if i not in (None, 3)])
        known = {r[0]: r for r in expected(plain)}
        for r in found:
            if r.doc_id in (5, 6, 7, 8, 9, 10):
                assert (r.doc_id, r.n_chars, r.edited_sha256) == known[r.doc_id]
    assert sketches.compare_edited(empty(spark)).count() == 0
    assert sketches.sketch_documents(empty(spark)).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    (row,) = sketches.compare_edited(one).collect()
    assert row.near_next == 1.0 and row.n_distinct == 3.0
