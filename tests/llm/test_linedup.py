from __future__ import annotations

import re
from collections import defaultdict

import pytest
from conftest import plan_of
from samples import AWKWARD, SCHEMA, awkward, clashing, empty, given

from tallyhouse.llm import linedup

LINE = "a line that is Long enough to count, surely"


def key_of(line):
    key = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), key)


def plain(rows, least_docs=5, least_chars=40):
    """(id, lines, dropped, kept text) of each (id, text); null sorts first."""
    order = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        kept, dropped = [], 0
        for line in (text or "").split("\n"):
            key = key_of(line)
            held = holders[key]
            if len(key) >= least_chars and len(held) >= least_docs and order(doc_id) < max(map(order, held)):
                dropped += 1
            else:
                kept.append(line)
        out.append((doc_id, len((text or "").split("\n")), dropped, "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("batches,fanout", [(1, 4), (5, 2)])
def test_every_number_of_batches_gives_the_plain_result(spark, monkeypatch, batches, fanout):
    monkeypatch.setattr(linedup.LineRuns.__init__, "__defaults__", (linedup.LEAST_DOCS, fanout))
    rows = list(zip(given().doc_id.tolist(), given().text.tolist()))
    rows += [(20_000 + i, f"{LINE}\n \t{LINE.upper()}\x0b\nnew {i}\n") for i in range(9)]
    rows += [(30_000 + i, "\n".join(f"shared line number {j % 4} of those with forty characters" for j in range(i))) for i in range(9)]
    result = linedup.dedup_lines(table(spark, rows), batches=batches)
    assert found(result) == plain(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_five_documents_not_five_lines_or_rows(spark):
    rows = [(i, LINE) for i in range(4)] + [(3, LINE), (3, f"{LINE}\n{LINE}")]
    assert all(r[2] == 0 for r in found(linedup.dedup_lines(table(spark, rows), batches=2)))
    rows.append((None, LINE))
    result = found(linedup.dedup_lines(table(spark, rows), batches=2))
    assert result == plain(rows)
    assert sum(r[2] for r in result) == 4


def test_keys(spark):
    short, exact = "x" * 39, "É" + "x" * 39
    texts = [short, exact, exact.lower(), f"\r\n{exact.upper()}\x0c", f"\x1c{exact}", f"{exact}\x85"]
    rows = [(i, text) for i in range(6) for text in ["\n".join(texts)]]
    result = found(linedup.dedup_lines(table(spark, rows), batches=2))
    assert result == plain(rows)
    assert {r[2] for r in result} == {0, 5}


def test_runs_are_levelled_and_settled_keys_are_not_added(spark):
    store = linedup.LineRuns(spark, least_docs=5, fanout=3)
    schema = "h1 long, h2 long, n long, last long"
    for batch in range(7):
        rows = [(1, 1, 6, 70 - batch), (2, 2, 1, 70 - batch), (100 + batch, 0, 1, 70 - batch)]
        store.add(spark.createDataFrame(rows, schema))
    assert [len(level) for level in store.levels] == [1, 2]
    counts = {r.h1: (r.n, r.last) for r in store.merged(store.runs()).collect()}
    # The first key was settled by its first record; no run yet counts the second in five documents.
    assert counts[1] == (6, 70) and counts[2] == (7, 70)
    assert sorted(tuple(r) for r in store.frequent().collect()) == [(1, 1, 70), (2, 2, 70)]
    # An id above the stored one is news.
    later = spark.createDataFrame([(1, 1, 1, 71), (2, 2, 1, 60)], schema)
    assert 1 in [r.h1 for r in store.unsettled(later).collect()]
    plan = plan_of(store.unsettled(spark.createDataFrame([(1, 1, 1, 1)], schema)))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    store.close()


def test_a_run_is_not_shuffled_by_the_join(spark):
    store = linedup.LineRuns(spark)
    own = spark.range(1000).selectExpr("id AS h1", "id AS h2", "1L AS n", "id AS last")
    store.add(own.groupBy("h1", "h2").agg({"n": "sum", "last": "max"}).toDF("h1", "h2", "n", "last"))
    batch = spark.range(50).selectExpr("id AS h1", "id AS h2", "id AS last").groupBy("h1", "h2").max("last")
    plan = plan_of(store.unsettled(batch.toDF("h1", "h2", "last")))
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    store.close()


def test_awkward_rows(spark):
    many = [(100 + i, f"{LINE}\n{i}", "en", "a", 1) for i in range(6)]
    many += [(None, f"{LINE}\nno id", "en", "a", 1)] * 40
    for docs in (awkward(spark), clashing(spark)):
        more = spark.createDataFrame(many, SCHEMA)
        extra = [c for c in docs.columns if c not in more.columns]
        docs = docs.union(more.selectExpr("*", *(f"'clash' AS `{c}`" for c in extra)))
        result = linedup.dedup_lines(docs, batches=2)
        assert result.columns == [*docs.columns, "n_lines", "n_dropped"]
        assert found(result) == plain([(r[0], r[1]) for r in AWKWARD + many])
        assert result.filter("text IS NULL").count() == 2
    assert linedup.dedup_lines(empty(spark), batches=2).count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"doc-{i}", LINE) for i in range(7)], "doc_id string, text string")
    kept = linedup.dedup_lines(docs).filter("n_dropped = 0").collect()
    assert [(r.doc_id, r.text) for r in kept] == [("doc-6", LINE)]


def test_no_python_on_the_executors_and_hot_lines_are_split(spark, settings):
    docs = table(spark, [(i, f"{LINE}\n{i}") for i in range(50)])
    plan = plan_of(linedup.dedup_lines(docs))
    assert "Python" not in plan and "Arrow" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_many_lines_in_one_text_take_linear_time(spark):
    text = "\n".join(f"line {i} of a very long text of forty chars" for i in range(100_000))
    rows = [(i, text) for i in range(5)]
    result = found(linedup.dedup_lines(table(spark, rows), batches=2))
    assert [r[2] for r in result] == [100_000] * 4 + [0]
