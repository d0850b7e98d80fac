from __future__ import annotations

from collections import Counter, defaultdict
from math import log

import pytest
from samples import AWKWARD, SCHEMA, awkward, clashing, empty

from tallyhouse.llm import mixing
from tallyhouse.llm.mixing import Mix, Target
from tallyhouse.llm.rows import ROW, with_row

SHARES = [0.5, 0.25, 0.15, 0.1]


def weights(exponent):
    powers = [p**exponent for p in SHARES]
    return [p / sum(powers) for p in powers]


def entropy(w):
    return -sum(x * log(x) for x in w)


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.9, 1.0])
def test_exponent_meets_the_entropy(spark, fraction):
    sources = spark.createDataFrame([(p,) for p in SHARES], "share double")
    exponent = mixing.fit_exponent(sources, Target(fraction, None))
    wanted = entropy(SHARES) + fraction * (log(4) - entropy(SHARES))
    assert entropy(weights(exponent)) == pytest.approx(wanted, abs=1e-5)


@pytest.mark.parametrize("limit,expected", [(5.0, 0.0), (100.0, 0.0), (1.0, 1.0), (2.0, 1 - log(2) / log(5))])
def test_exponent_meets_the_repetition_limit(spark, limit, expected):
    sources = spark.createDataFrame([(p,) for p in SHARES], "share double")
    assert mixing.fit_exponent(sources, Target(None, limit)) == pytest.approx(expected, abs=1e-6)


def documents(spark, n=3000):
    """One source with a third of all rows, others smaller, some null."""
    source = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 31 = 1 THEN NULL ELSE concat('s', id % 5) END"
    return spark.range(n).selectExpr(
        "id AS doc_id", "repeat('the ', int(id % 23)) AS text", "NULL AS lang", f"{source} AS source", "0L AS n_chars"
    )


def test_mix_has_the_weights_and_every_document(spark):
    docs = documents(spark)
    mix = Mix(block_tokens=2000)
    rows = mixing.mix_plan(docs, mix).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    tokens, mixed = Counter(), Counter()
    for i, s in source.items():
        tokens[s] += i % 23 + 1
    for r in rows:
        assert r.n_tokens == r.doc_id % 23 + 1 and source[r.doc_id] == r.source
        mixed[r.source] += r.n_tokens
    assert {r.doc_id for r in rows} == set(source)
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}
    low, high = min(share.values()), max(share.values())
    exponent = max(0.0, 1 - log(2) / log(high / low))
    power = {s: p**exponent for s, p in share.items()}
    budget = sum(tokens.values()) * max(share[s] * sum(power.values()) / power[s] for s in share)
    for s in share:
        assert abs(mixed[s] - power[s] / sum(power.values()) * budget) <= 23
    copies = Counter((r.doc_id, r.epoch) for r in rows)
    assert set(copies.values()) == {1}
    places = defaultdict(list)
    for r in rows:
        places[r.block].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    for block, own in places.items():
        size = Counter()
        for r in rows:
            if r.block == block:
                size[r.source] += r.n_tokens
        for s in share:
            assert abs(size[s] - power[s] / sum(power.values()) * budget / len(places)) <= 46


def test_buckets_do_not_change_the_budget(spark, monkeypatch):
    docs = documents(spark, 900)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rows = mixing.mix_plan(docs, Mix(budget=3000, block_tokens=500)).collect()
    assert abs(sum(r.n_tokens for r in rows) - 3000) <= 23 * 7
    again = mixing.mix_plan(docs, Mix(budget=3000, block_tokens=500)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        rows = mixing.mix_plan(docs).collect()
        assert Counter(r.doc_id for r in rows if r.epoch == 0) == Counter(row[0] for row in AWKWARD)
        mixed = mixing.mixed(docs, prefix="_mix_").select(docs.columns)
        assert {r.doc_id for r in mixed.collect()} == {row[0] for row in AWKWARD}
        assert mixed.count() >= len(AWKWARD)
    assert mixing.mix_plan(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0


def test_rows_that_differ_in_the_null_column_differ(spark):
    rows = [(1, "x", None, "a", 1), (1, None, "x", "a", 1), (1, "x", "a", None, 1), (1, "x", None, "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = with_row(docs).dropDuplicates(ROW)
    assert sorted(map(str, found.select(docs.columns).collect())) == sorted(
        map(str, docs.distinct().collect())
    )
