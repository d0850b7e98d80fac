"""Language and quality: held-out accuracy, and awkward rows."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from samples import AWKWARD, SF_DIR, awkward, clashing, empty, given

import __spark_entry__ as contract
from tallyhouse.llm import gam, langid


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_languages_of_held_out_documents(spark):
    found = contract.queries()["op8_ngram_bayes"](spark, SF_DIR).toPandas()
    assert (found.held_out == [remainder(i, 4) == 2 for i in found.doc_id]).all()
    both = found.merge(given(), on="doc_id")
    own = both[both.held_out]
    assert len(found) == 1000 and (own.lang == own.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all()


def test_quality_of_held_out_documents(spark):
    found = contract.queries()["op2_pairwise_gam"](spark, SF_DIR).toPandas()
    assert (found.held_out == [remainder(i, 3) == 1 for i in found.doc_id]).all()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    both = found.merge(pd.read_parquet(f"{SF_DIR}/labels.parquet"), on="doc_id")
    own = both[both.held_out]
    assert len(found) == 1000 and (own.quality == own.predicted).mean() > 0.97


def test_language_of_awkward_rows(spark):
    model = langid.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    for docs in (awkward(spark), clashing(spark)):
        rows = langid.predict(docs, model).collect()
        assert len(rows) == len(AWKWARD)
        assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 5, 10)} == {"und"}
        assert {r.lang_pred for r in rows if r.doc_id == 2**62} == {"en"}
        assert langid.fit(docs).languages == ["de", "en", "fr"]
    assert langid.predict(empty(spark), model).count() == 0
    assert langid.fit(empty(spark)).languages == []


def test_long_texts_count_every_character(monkeypatch):
    text = "abc déf ghi " * 50
    whole = np.concatenate(list(langid.buckets_of(text)))
    monkeypatch.setattr(langid, "PIECE", 37)
    assert sorted(np.concatenate(list(langid.buckets_of(text)))) == sorted(whole)
    assert len(whole) == sum(len(text) - n + 1 for n in langid.ORDERS)


def test_long_text_of_a_rare_language_outweighs_the_prior():
    """Each n-gram tells little, all of them together much."""
    matrix = np.tile(np.array([0.0, 0.05], np.float32), (langid.BUCKETS, 1))
    model = langid.Model(["often", "rare"], matrix, np.log([100 / 101, 1 / 101]))
    assert langid.classify("ab " * 1000, model)[0] == "rare"
    assert langid.classify("ab", model)[0] == "often"


def test_eighty_languages_are_learnt_in_blocks_and_predicted(spark):
    letters = [chr(0x4E00 + 3 * i) + chr(0x4E00 + 3 * i + 1) for i in range(80)]
    rows = [(n, f"{pair} {pair * 3}", f"l{i:02d}") for i, pair in enumerate(letters) for n in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.languages) == 80 > langid.LANGUAGES_AT_ONCE
    found = langid.predict(docs, model).collect()
    assert [r.lang_pred for r in found] == [lang for *_, lang in rows]


def test_against_plain_counting(spark, monkeypatch):
    """Counts, log probabilities, verdict and score from dictionaries, text by text."""
    monkeypatch.setattr(langid, "GATHERED", 20_000)
    rows = [r for r in given().itertuples() if r.lang is not None and r.text][:120]
    learn, judge = rows[:80], [*(r.text for r in rows[60:]), None, "", "12 34", "é", "x" * 5000]
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in learn], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    grams = lambda text: Counter(b for part in langid.buckets_of(text) for b in part.tolist())
    counts = defaultdict(Counter)
    for r in learn:
        counts[r.lang].update(grams(r.text))
    assert model.languages == sorted(counts)
    found = langid.classify_all(judge, model)
    for text, (lang, score) in zip(judge, found):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        own, totals, priors = grams(text), {}, {}
        for name, seen in counts.items():
            whole = sum(seen.values()) + langid.SMOOTHING * langid.BUCKETS
            totals[name] = sum(n * math.log((seen[b] + langid.SMOOTHING) / whole) for b, n in own.items())
            priors[name] = math.log(sum(r.lang == name for r in learn) / len(learn))
        best = max(totals, key=lambda name: totals[name] + priors[name])
        n = sum(own.values())
        margin = {name: totals[name] * min(n, langid.EVIDENCE) / n + priors[name] for name in totals}
        assert lang == best
        assert score == pytest.approx(1 / sum(math.exp(m - margin[best]) for m in margin.values()), abs=1e-4)


def test_copies_of_a_text_are_thinned_like_other_rows(spark):
    """A third of a language is one text: about a third of the sample is."""
    rows = [(i, "abc" if i % 3 == 0 else f"word{i}", "en") for i in range(3000)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows_per_language=300)
    whole = np.exp(model.matrix[:, 0].astype(float))
    (bucket,) = [b for part in langid.buckets_of("abc") for b in part.tolist()][-1:]
    # One trigram a copy among some 8 n-grams a row: a few per cent, neither none nor most.
    assert 0.001 < whole[bucket] < 0.1


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (9, 1), (3, 0), (3, 1), (6, 0), (None, 1), (99, 0), (8, None), (10, 5)], "doc_id long, quality int"
    )
    for docs in (awkward(spark), clashing(spark)):
        model = gam.fit(docs, labels)
        rows = gam.score(docs, model).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert gam.score(empty(spark), model).count() == 0
    nothing = gam.fit(empty(spark), labels)
    assert {r.score for r in gam.score(awkward(spark), nothing).collect()} == {0.5}


def test_additive_model_needs_its_pairs():
    """Labels that only two features together explain."""
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)) * 1.0
    model = gam.fit_arrays(x, y)
    assert (0, 2) in model.pairs
    assert ((model.scores(x) > 0.5) == (y == 1)).mean() > 0.95
    alone = gam.Model(model.intercept, model.edges, model.tables, model.coarse)
    assert ((alone.scores(x) > 0.5) == (y == 1)).mean() < 0.7


def test_additive_model_follows_one_feature():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = (np.abs(x[:, 1] - 0.5) < 0.2) * 1.0
    assert ((gam.fit_arrays(x, y).scores(x) > 0.5) == (y == 1)).mean() > 0.97
