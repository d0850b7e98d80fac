"""Queries with SQL against it, and the pipeline against its stages done plainly."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle_check import connect, differences
from samples import SF_DIR, awkward, clashing, empty
from test_packing import check, plain_ids
from test_pii import redacted
from test_rules import plain
from test_simhash import brute_roots
from test_simhash import plain as plain_print

import __spark_entry__ as contract
import corpus_pipeline
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.queries import QUERIES


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def keeps(text):
    n, chars, symbols, lines, dup, repeated, stutters, *_ = plain(text)
    return not (
        n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or 2 * dup > lines
        or chars < 3 * n or chars > 10 * n or 3 * stutters > n
    )


def test_stages_against_plain_forms(spark, tmp_path):
    small = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, columns = small, small.columns
    rows = [r.asDict() for r in docs.collect()]
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        found = [r.asDict() for r in docs.collect()]
        assert name == "pack" or docs.columns == columns
        if name == "quality_rules":
            rows = [r for r in rows if keeps(r["text"])]
        elif name == "near_dedup":
            rows.sort(key=lambda r: r["doc_id"])
            root = brute_roots([plain_print(r["text"]) for r in rows])
            rows = [r for i, r in enumerate(rows) if root[i] == i]
        elif name == "personal_data":
            for r in rows:
                r["text"] = redacted(r["text"])
                r["n_chars"] = len(r["text"])
        elif name == "mix_sources":
            copies = Counter(r["doc_id"] for r in found)
            assert set(copies) == {r["doc_id"] for r in rows} and max(copies.values()) <= 2
            own = {r["doc_id"]: r for r in rows}
            assert all(r == own[r["doc_id"]] for r in found)
            rows = found
        else:
            expected = Counter()
            for r in rows:
                ids = np.array(plain_ids(r["text"]), "<u4")
                for piece, start in enumerate(range(0, len(ids), 4096)):
                    part = ids[start : start + 4096]
                    expected[r["doc_id"], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
            assert expected == Counter(
                (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found
            )
            check(docs.collect())
            continue
        key = lambda r: (r["doc_id"], r["text"])
        assert sorted(found, key=key) == sorted(rows, key=key)


@pytest.mark.parametrize("make", [awkward, clashing, empty])
def test_every_stage_takes_awkward_rows(spark, make, tmp_path):
    docs = make(spark)
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF_DIR)
        if name != "pack":
            assert out.columns == docs.columns
            assert [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        assert (out.count() == 0) == (make is empty)
