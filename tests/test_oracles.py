"""Every registered query against the same SQL in an independent engine."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from tallyhouse.catalogue.oracles import ORACLES
from tallyhouse.catalogue.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_contract_without_the_training_data_package(tmp_path):
    """The other queries stay when the package and the pipeline are absent."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tallyhouse", tmp_path / "tallyhouse", ignore=shutil.ignore_patterns("llm"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = [sys.executable, "-c", code]
    found = subprocess.run(run, cwd=tmp_path, capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, tables, name):
    assert differences(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "region",
        "min_address",
        "min_square",
        "max_address",
        "max_square",
        "square_difference",
    ]
    assert result.count() == 20
