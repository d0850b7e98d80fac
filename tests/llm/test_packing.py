from __future__ import annotations

import zlib
from functools import lru_cache
from math import ceil

import numpy as np
import public_tokenizers
import pytest
from samples import AWKWARD, awkward, clashing, empty, given
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.tokens import document_ids, word_ids


@lru_cache
def whole_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain_ids(text):
    return [*whole_tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


ODD = [
    "it's 'start don'T 's't \x85a\xa0b \x1cq Σς ﬁ é é İ 𝔘 日本 \xad- Ⅷ ²³ ½¾ ¿¡«» ÄÖÜ ß µ ª x×y",
    "<|endoftext|> a<|b <|startoftext|>x",
    "a" * 3000,
]


def test_ids_are_the_tokenizers_own():
    known = word_ids()
    for text in [*given().text[:200], *ODD, None, ""]:
        assert np.frombuffer(document_ids(text, known), "<u4").tolist() == plain_ids(text)


def check(rows, capacity=4096):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        rows = packing.pack_documents(docs).collect()
        check(rows)
        expected = []
        for doc_id, text, *_ in AWKWARD:
            ids = np.array(plain_ids(text), "<u4")
            for piece, start in enumerate(range(0, len(ids), 4096)):
                part = ids[start : start + 4096]
                expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
        found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
        assert sorted(found, key=str) == sorted(expected, key=str)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame(given()[["doc_id", "text"]].head(120))
    packed = packing.pack_documents(docs, capacity=512)
    rows = packed.collect()
    check(rows, 512)
    ids = {r.sequence_id: bytes(r.ids) for r in packing.sequences(docs, packed, capacity=512).collect()}
    for r in rows:
        part = ids[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(part) == r.ids_crc32


@pytest.mark.parametrize("low,high,n", [(1, 4097, 3000), (1000, 2500, 1500), (1300, 1500, 900)])
def test_search_never_loses_to_best_fit(low, high, n):
    lengths = np.random.default_rng(n).integers(low, high, n)
    start = packing.best_fit(lengths, 4096)
    bins = packing.pack(lengths)
    assert sorted(i for b in bins for i in b) == list(range(n))
    assert all(lengths[b].sum() <= 4096 for b in bins)
    assert ceil(lengths.sum() / 4096) <= len(bins) <= len(start)


def test_search_empties_a_bin_that_best_fit_leaves():
    """Two exchanges among the fuller bins make room for the piece of the emptiest."""
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = packing.improve([[0, 5], [1, 3], [2, 4], [6]], lengths, 10)
    assert len(bins) == 3
    assert sorted(i for b in bins for i in b) == list(range(7))


def test_groups_are_bounded(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('a b ', int(id % 40)) AS text")
    rows = packing.pack_documents(docs, capacity=64, group=50).collect()
    few = check(packing.pack_documents(docs, capacity=64).collect(), 64)
    assert few <= check(rows, 64) <= few + 12
