from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from samples import AWKWARD, SF_DIR, awkward, clashing, empty, given

from tallyhouse.llm import periodic
from tallyhouse.llm.queries import QUERIES


def plain_runs(words, least_length=6, least_exponent=4):
    """Every period in turn: stretches of words equal to the word a period before."""
    found, codes = [], {word: i for i, word in enumerate(set(words))}
    own = np.array([codes[word] for word in words], dtype=int)
    for q in range(1, len(own) // least_exponent + 1):
        same = np.concatenate([[0], own[q:] == own[:-q], [0]]).astype(int)
        turns = np.flatnonzero(np.diff(same))
        for start, end in zip(turns[::2], turns[1::2]):
            length = end - start + q
            part = own[start : start + length]
            if length >= max(least_length, least_exponent * q):
                if not any((part[r:] == part[:-r]).all() for r in range(1, q)):
                    found.append((int(start), int(length), q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [word for i, word in enumerate(words) if i not in gone]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("least", [(6, 4), (6, 3), (2, 2), (10, 5), (8, 4)])
def test_all_runs_of_random_sequences(least):
    rng = random.Random(least[0])
    for _ in range(600):
        n, letters = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 4, 10])
        words = [b"%d" % rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            start, q = rng.randrange(n), rng.randint(1, 6)
            for i in range(start, min(n, start + rng.randint(1, 30))):
                words[i] = words[start + (i - start) % q]
        runs = periodic.word_runs(words, *least)
        assert runs == plain_runs(words, *least)
        assert periodic.collapse(words, runs) == plain_kept(words, runs)


def test_long_texts_take_no_quadratic_time():
    fib, next_ = "a", "ab"
    while len(next_) < 60_000:
        fib, next_ = next_, next_ + fib
    start = time.perf_counter()
    assert periodic.word_runs([b"a"] * 60_000) == [(0, 60_000, 1)]
    assert periodic.word_runs([b"%d" % (i % 700) for i in range(60_000)]) == [(0, 60_000, 700)]
    # No word of this sequence has four periods.
    assert periodic.word_runs([c.encode() for c in next_[:60_000]]) == []
    assert time.perf_counter() - start < 30


def test_passages_repeated_far_apart_are_no_runs(monkeypatch):
    monkeypatch.setattr(periodic, "automaton", None)
    passage = [b"p%d" % i for i in range(60)]
    assert periodic.word_runs(passage + [b"w%d" % i for i in range(300)] + passage) == []


def contract_row(doc_id, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    digest = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        digest("".join("%d,%d,%d\n" % run for run in runs)),
        digest(" ".join(plain_kept(words, runs))),
    )


def test_query_against_brute_force(spark):
    found = {row.doc_id: tuple(row) for row in QUERIES["op12_suffix_runs"](spark, SF_DIR).collect()}
    expected = {row.doc_id: contract_row(row.doc_id, row.text) for row in given().itertuples()}
    assert found == expected
    assert sum(row[1] > 0 for row in found.values()) > 30


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        found = periodic.find_runs(docs, runs_col="runs", collapsed_col="Collapsed")
        assert found.columns == [*(c for c in docs.columns if c != "runs"), "runs", "Collapsed"]
        rows = found.collect()
        assert len(rows) == len(AWKWARD)
        for row in rows:
            words = words_of(row.text)
            if len(words) < 1000:
                assert [tuple(run) for run in row.runs] == plain_runs(words)
                assert row.Collapsed == " ".join(plain_kept(words, plain_runs(words)))
            else:
                assert row.runs == [] and row.Collapsed == " ".join(words)
    assert periodic.find_runs(empty(spark)).count() == 0


def test_one_period_means_no_run(spark):
    with pytest.raises(ValueError):
        periodic.find_runs(awkward(spark), least_exponent=1)
