from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest
from conftest import plan_of
from samples import AWKWARD, SF_DIR, awkward, clashing, empty, given

from tallyhouse.llm import pii

# The contract's forms, as plain patterns.
FORMS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for place, character in enumerate(reversed(digits)):
        digit = int(character) * (1 + place % 2)
        total += digit - 9 * (digit > 9)
    return total % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in found.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain_spans(text):
    spans = []
    for order, (kind, form) in enumerate(FORMS):
        for match in re.finditer(form, text or ""):
            if valid(kind, match[0]):
                spans.append((match.start(), order, match.end()))
    return sorted(spans)


TRICKY = [
    "a.b@c.d_x@e.f.g@h.i",
    "foo@bar baz@qux.org.",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0000255.1.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "4111  1111 1111 1111 5500 0000 0000 0004 ",
    "+44 20 7946 0958 +1 (509) 555-6973. +12 +1 2345678 +1+44 20 7946 0958 +1 ((((",
    "😀+44 20 7946 0958é a@b.cd𝔘",
    "x@y.zz" * 50,
    "1" * 50_000,
    "1 " * 50_000,
    "a@b" + ".c" * 20_000,
    "+1" + "2 " * 30_000,
    "1.1.1.1." * 10_000,
    "%" * 50_000 + "@",
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_base_spans_are_those_of_the_plain_forms(spark, model):
    texts = [*given().text, *TRICKY, *(row[1] for row in AWKWARD)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_spans(docs, model).collect():
        base = [(s.start, s.kind, s.end) for s in row.spans if s.base]
        assert base == plain_spans(row.text), row.doc_id


def test_query_columns(spark):
    import __spark_entry__ as contract

    texts = dict(zip(given().doc_id, given().text))
    for row in contract.queries()["op10_boosted_pii"](spark, SF_DIR).collect():
        spans = plain_spans(texts[row.doc_id])
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[1] == k for s in spans) for k in range(4)
        ]
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))


def test_trees_add_loose_forms_that_look_like_the_base(spark):
    """Phone numbers after 'call' are learnt with a plus; without one they are added, dates are not."""
    rows = []
    for i in range(400):
        rows.append(f"please call +1 (555) 010-{1000 + i} today")
        rows.append(f"lot 20{i % 90:02d} 11 2{i % 10} {1000 + i} of the list")
    learn = spark.createDataFrame([(t,) for t in rows], "text string")
    model = pii.fit(learn)
    assert pii.PHONE in model.thresholds
    tests = ["please call (555) 010-4321 today", "lot 2011 11 23 4321 of the list", "call +1 (555) 010-4321"]
    found = pii.find_spans(spark.createDataFrame([(t,) for t in tests], "text string"), model).collect()
    spans = {r.text: [(r.text[s.start : s.end], s.base) for s in r.spans] for r in found}
    assert spans[tests[0]] == [("(555) 010-4321", False)]
    assert spans[tests[1]] == []
    assert spans[tests[2]] == [("+1 (555) 010-4321", True)]


def learnt_emails(spark, strict, loose, word):
    """Text of the loose e-mails added in a table of that many strict and loose ones, a word before each."""
    rows = [f"{word} user{i % 10}.n@host.org soon, no {'x' * i}" for i in range(strict)]
    rows += [f"{word} user{i % 10} [at] host [dot] org soon, no {'x' * i}" for i in range(loose)]
    docs = spark.createDataFrame([(t,) for t in rows], "text string")
    found = pii.find_spans(docs, pii.fit(docs)).collect()
    return [r.text[s.start : s.end] for r in found for s in r.spans if not s.base]


@pytest.mark.parametrize("strict,loose", [(400, 10), (10, 400)])
def test_loose_forms_are_judged_by_key_words_not_by_their_share(spark, strict, loose):
    added = learnt_emails(spark, strict, loose, "mail")
    assert len(added) == loose and all(" [at] host [dot] org" in a for a in added)
    assert learnt_emails(spark, strict, loose, "see") == []


def test_few_candidates_can_reach_a_threshold():
    """Ten right ones, two held out, beside wrong ones of another form: no minimum count stands in the way."""
    codes = np.array([[pii.EMAIL, 1, 1, 4, 7, 0, 0]] * 2 + [[pii.EMAIL, 1, 9, 0, 0, 0, 0]] * 2)
    right, wrong = np.array([2.0, 8, 0, 0]), np.array([0.0, 0, 10, 40])
    held_out, sure = np.array([True, False] * 2), np.array([0.0, 1000, 0, 0])
    model = pii.fit_cells(codes, right, wrong, held_out, sure)
    chosen = 1 / (1 + np.exp(-model.margins(codes))) >= model.thresholds[pii.EMAIL]
    assert chosen.tolist() == [True, True, False, False]


def test_no_threshold_without_held_out_evidence():
    codes = np.array([[pii.EMAIL, 1, 1, 4, 7, 0, 0], [pii.EMAIL, 1, 9, 0, 0, 0, 0]])
    right, wrong, sure = np.array([50.0, 0]), np.array([0.0, 50]), np.array([1000.0, 0])
    assert pii.fit_cells(codes, right, wrong, np.array([False, False]), sure).thresholds == {}


def test_of_overlapping_candidates_the_first_is_added(spark):
    model = pii.Model(prior=5.0, thresholds={kind: 0.5 for kind in range(4)})
    text = "ring (555) 010-4321 1111 2222 3333 or a@b.cd (555) 010-4321 1.2.3.4"
    found = pii.find_spans(spark.createDataFrame([(text,)], "text string"), model).collect()[0].spans
    spans = [(text[s.start : s.end], s.base) for s in found]
    assert ("a@b.cd", True) in spans and ("1.2.3.4", True) in spans
    open_ = sorted((s.start, s.end) for s in found if not s.base)
    assert open_ and all(a[1] <= b[0] for a, b in zip(open_, open_[1:]))
    assert not any(s.start < e and b < s.end for s in found if s.base for b, e in open_)


def test_many_spans_take_linear_time(spark, tmp_path):
    text = " ".join(f"call +1 555 010 {i % 9000 + 1000} or a.b{i}@mail.example.com" for i in range(20_000))
    spark.createDataFrame([(text,)], "text string").write.parquet(str(tmp_path / "long"))
    docs = spark.read.parquet(str(tmp_path / "long"))
    start = time.perf_counter()
    (row,) = pii.redact(pii.find_spans(docs, pii.fit(docs))).collect()
    assert time.perf_counter() - start < 60
    assert row.text == redacted(text) and len(row.spans) == 40_000


def redacted(text):
    out, at = [], 0
    for start, kind, end in plain_spans(text):
        if start >= at:
            out += [text[at:start], f"[{('EMAIL', 'IP', 'CARD', 'PHONE')[kind]}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_clashing_work_columns_stay(spark):
    docs = spark.createDataFrame([("a@b.cd", 1, 2)], "text string, _found0 long, _candidates long")
    (row,) = pii.find_spans(docs, pii.Model()).collect()
    assert (row["_found0"], row["_candidates"], len(row.spans)) == (1, 2, 1)


def test_copies_of_a_text_count_once_and_other_kinds_are_left_out(spark, monkeypatch):
    seen = []
    fit_cells = pii.fit_cells
    monkeypatch.setattr(pii, "fit_cells", lambda *a: seen.append(a) or fit_cells(*a))
    rows = ["host 10.20.30.40 is up"] * 7 + ["lot 2011 11 43 21"] * 5 + ["call (555) 010-4321"] * 3
    pii.fit(spark.createDataFrame([(t,) for t in rows], "text string"))
    codes, right, wrong, held_out, sure = seen[0]
    phones = codes[:, 0] == pii.PHONE
    assert [right[phones].sum(), wrong[phones].sum(), sure[phones].sum()] == [1, 1, 0]
    assert [right[~phones].sum(), wrong[~phones].sum(), sure[~phones].sum()] == [0, 0, 1]


def test_redaction_leaves_the_rest(spark, model):
    texts = ["", None, "no data", "mail a@b.cd now", "a@b.cd", "n: 4111 1111 1111 1111 and 10.0.0.1é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    redacted = pii.redact(pii.find_spans(docs, model))
    assert [r.text for r in redacted.orderBy("doc_id").collect()] == [
        "", None, "no data", "mail [EMAIL] now", "[EMAIL]", "n: [CARD] and [IP]é"
    ]


def test_awkward_rows(spark, model):
    for docs in (awkward(spark), clashing(spark)):
        found = pii.find_spans(docs, pii.fit(docs), spans_col="_spans")
        assert found.select(docs.columns).schema == docs.schema
        rows = found.select("doc_id", "text", "_spans").collect()
        assert len(rows) == len(AWKWARD)
        for row in rows:
            spans = [(s.start, s.kind, s.end) for s in row["_spans"] if s.base]
            assert spans == plain_spans(row.text)
    assert pii.find_spans(empty(spark), pii.fit(empty(spark))).count() == 0


def test_no_python_on_the_executors(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(pii.redact(pii.find_spans(docs, model)))
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_boosting_separates_and_calibrates():
    rng = np.random.default_rng(0)
    codes = np.column_stack([rng.integers(0, n, 4000) for n in pii.FEATURES.values()])
    right = (codes[:, 2] > 10) & (codes[:, 5] == 1)
    model = pii.fit_cells(codes, right * 1.0, ~right * 1.0, np.arange(4000) % 5 == 0)
    score = 1 / (1 + np.exp(-model.margins(codes)))
    assert ((score > 0.5) == right).mean() > 0.99
    for kind, threshold in model.thresholds.items():
        chosen = (codes[:, 0] == kind) & (score >= threshold)
        assert right[chosen].mean() >= 0.97
