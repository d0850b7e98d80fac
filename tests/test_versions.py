from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.sinks import versions
from tallyhouse.sinks.versions import commit, latest, load_version, read_version


@pytest.fixture
def root(tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "GRACE", 0.0)
    return str(tmp_path / "table")


def batch(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("k"), F.concat(F.lit("row "), "id").alias("t"))


def keys(spark, root):
    return sorted(r.k for r in read_version(spark, root, batch(spark, 0, 1).schema).collect())


def test_a_batch_goes_in_once(spark, root):
    assert keys(spark, root) == []
    assert load_version(batch(spark, 0, 10), root, "monday", "k") == 10
    assert load_version(batch(spark, 5, 15), root, "tuesday / 2", "k") == 5
    assert load_version(batch(spark, 5, 15), root, "tuesday / 2", "k") == 0
    assert load_version(batch(spark, 0, 15), root, "again", "k") == 0
    assert keys(spark, root) == list(range(15))
    assert [name for name, _ in latest(spark, root).batches] == ["monday", "tuesday / 2", "again"]


def test_repeats_inside_a_batch_stay_and_null_keys_do_not(spark, root):
    twice = batch(spark, 0, 3).union(batch(spark, 0, 3)).union(spark.sql("SELECT CAST(NULL AS bigint), 'x'"))
    assert load_version(twice, root, "a", "k") == 6
    assert load_version(twice, root, "b", "k") == 0


def test_two_loads_at_once_leave_each_key_once(spark, root, monkeypatch):
    load_version(batch(spark, 0, 4), root, "first", "k")
    own_commit, raced = versions.commit, []

    def late(*args):
        if not raced:
            raced.append(True)
            assert load_version(batch(spark, 2, 8), root, "other", "k") == 4
        return own_commit(*args)

    monkeypatch.setattr(versions, "commit", late)
    assert load_version(batch(spark, 0, 10), root, "slow", "k") == 2
    assert keys(spark, root) == list(range(10))
    assert latest(spark, root).number == 3


def test_the_same_batch_twice_at_once(spark, root, monkeypatch):
    own_commit, raced = versions.commit, []

    def late(*args):
        if not raced:
            raced.append(True)
            assert load_version(batch(spark, 0, 5), root, "same", "k") == 5
        return own_commit(*args)

    monkeypatch.setattr(versions, "commit", late)
    assert load_version(batch(spark, 0, 5), root, "same", "k") == 0
    assert keys(spark, root) == list(range(5))


def test_a_load_killed_before_or_inside_its_commit_leaves_nothing(spark, root, monkeypatch, tmp_path):
    load_version(batch(spark, 0, 3), root, "a", "k")

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            load_version(batch(spark, 3, 6), root, "b", "k")
    assert keys(spark, root) == [0, 1, 2]
    # A version file whose writer died half-way.
    (tmp_path / "table" / "versions" / "2").write_text("a\tnowhere\nb")
    assert keys(spark, root) == [0, 1, 2]
    assert load_version(batch(spark, 3, 6), root, "b", "k") == 3
    assert keys(spark, root) == list(range(6))
    assert not commit(spark, root, 2, ())


def test_an_older_version_stays_readable(spark, root):
    load_version(batch(spark, 0, 3), root, "a", "k")
    old = latest(spark, root)
    load_version(batch(spark, 3, 6), root, "b", "k")
    assert len(rows(read_version(spark, root, batch(spark, 0, 1).schema, old))) == 3
