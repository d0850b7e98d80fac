from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import revisits

SCHEMA = "record_id long, type string, status int, url string, ts long, payload string, headers map<string,string>"


def records(seed=4, n=600):
    """Few URLs, one with a third of all records, many equal times and validators."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        url = "http://www.hot.org/" if draw.random() < 0.34 else f"https://Site{draw.randrange(20)}.org/p?b=1&a={draw.randrange(2)}"
        kind = draw.random()
        headers = {"ETag": f'"{draw.randrange(3)}"', "Last-Modified": f"d{draw.randrange(2)}", "Vary": f"v{i}", "Content-Type": f"t{i}"}
        for name in ("ETag", "Last-Modified", "Vary"):
            if draw.random() < 0.3:
                del headers[name]
        if kind < 0.4:
            rows.append((i, "response", 200, url, draw.randrange(200), f"body {i}", headers))
        elif kind < 0.9:
            if "ETag" in headers and draw.random() < 0.5:
                headers["etag"] = "W/" + headers.pop("ETag")
            rows.append((i, "revisit", 304, url.replace("http:", "HTTPS:") + "#x", draw.randrange(200), None, headers))
        else:
            rows.append((i, draw.choice(["request", "response"]), 404, url, draw.randrange(200), "no", headers))
    return rows


def plain(rows):
    def key(url):
        return url.split("#")[0].split("://")[1].lower()

    found = {}
    for i, kind, status, url, ts, _, headers in rows:
        if (kind, status) != ("revisit", 304):
            continue
        earlier = [r for r in rows if (r[1], r[2]) == ("response", 200) and key(r[3]) == key(url) and r[4] < ts]
        own = {k.lower(): v for k, v in headers.items()}
        if not earlier:
            found[i] = ("no_response", None, None, None)
            continue
        last = max(earlier, key=lambda r: (r[4], r[0]))
        stored = {k.lower(): v for k, v in last[6].items()}
        if "etag" in own:
            same = own["etag"].removeprefix("W/") == stored.get("etag")
        elif "last-modified" in own:
            same = own["last-modified"] == stored.get("last-modified")
        else:
            found[i] = ("no_validator", None, None, None)
            continue
        if not same:
            found[i] = ("mismatch", None, None, None)
            continue
        merged = stored | {k: v for k, v in own.items() if k in revisits.PERMITTED}
        found[i] = ("resolved", last[0], last[5], merged)
    return found


@pytest.mark.parametrize("range_rows", [50_000, 40])
def test_agrees_with_plain_search(spark, monkeypatch, range_rows):
    monkeypatch.setattr(revisits, "RANGE_ROWS", range_rows)
    rows = records()
    found = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.record_id: (r.outcome, r.response_id, r.payload, r.headers) for r in found} == plain(rows)
    assert {o[0] for o in plain(rows).values()} == {"resolved", "mismatch", "no_validator", "no_response"}


def test_a_response_of_many_revisits_is_shared_out(spark, monkeypatch):
    """A third of all records, equal rows among them, stand for one response."""
    monkeypatch.setattr(revisits, "SHARE_ROWS", 40)
    rows = records(seed=9, n=400)
    rows.append((9_000, "response", 200, "http://one.org/", 1, "the one", {"ETag": '"h"', "Vary": "a"}))
    rows += [(9_001 + i, "revisit", 304, "http://one.org/", 5 + i % 7, None, {"ETag": '"h"'}) for i in range(300)]
    equal = [(9_500, "revisit", 304, "http://one.org/", 6, None, {"ETag": '"h"', "Vary": "b"})] * 200
    df = spark.createDataFrame(rows + equal, SCHEMA).repartition(6)
    found = revisits.resolve(df).collect()
    assert {r.record_id: (r.outcome, r.response_id, r.payload, r.headers) for r in found} == plain(rows + equal[:1])
    assert sum(r.record_id == 9_500 for r in found) == 200
    written = revisits.stage(revisits.resolutions(df), "resolutions")
    dealt, hot = revisits.shared_out(written.filter("response_id IS NOT NULL"))
    assert (9_000, 13) in [tuple(r) for r in hot.collect()]
    sizes = [r["count"] for r in dealt.filter("response_id = 9000").groupBy("share").count().collect()]
    assert len(sizes) == 13 and max(sizes) <= 2 * 500 / 13


def test_repeated_response_resolves_a_revisit_once(spark):
    stored = (1, "response", 200, "http://a.b/", 5, "x", {"ETag": '"1"'})
    earlier = (1, "response", 200, "http://a.b/", 4, "old", {"ETag": '"1"'})
    asked = (2, "revisit", 304, "http://a.b/", 9, None, {"ETag": '"1"'})
    rows = [stored] * 3 + [earlier] + [asked] * 2
    found = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.record_id, r.response_id, r.payload) for r in found] == [(2, 1, "x")] * 2


def test_canonical_urls(spark):
    same = [
        "http://www.Example.org:80/a/b/?x=1&b=2#frag",
        "https://example.org/a/b?b=2&x=1",
        " HTTPS://EXAMPLE.ORG:443/a/b/?b=2&utm_source=z&x=1& ",
    ]
    other = ["http://example.org/A/b?b=2&x=1", "http://example.org/", "http://example.org", "not a url#x", None, ""]
    df = spark.createDataFrame([(u,) for u in same + other], "u string")
    found = [r.c for r in df.select(revisits.canonical(F.col("u")).alias("c")).collect()]
    assert found == ["example.org/a/b?b=2&x=1"] * 3 + [
        "example.org/A/b?b=2&x=1", "example.org/", "example.org/", "not a url", None, ""
    ]


def test_awkward_records(spark):
    rows = [
        (1, "response", 200, None, 5, "x", {"ETag": '"1"'}),
        (2, "revisit", 304, None, 9, None, {"ETag": '"1"'}),
        (3, "revisit", 304, "http://a.b/", None, None, None),
        (None, "revisit", 304, "http://a.b/", 9, None, None),
        (4, "revisit", 304, "http://a.b/", 9, None, None),
        (5, "response", 200, "http://a.b/", 8, None, None),
        (6, "revisit", 304, "http://a.b/", 8, None, {"etag": None}),
        (6, "revisit", 304, "http://a.b/", 8, None, {"etag": None}),
        (7, None, None, "http://a.b/", 9, None, None),
        (8, "revisit", 304, "http://a.b/", 9, None, {"ETag": '"2"', "etag": '"1"'}),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("range", F.lit("clash")).withColumn("key", F.lit(1))
    found = sorted((r.record_id, r.outcome) for r in revisits.resolve(df).collect())
    assert found == [(2, "no_response"), (4, "no_validator"), (6, "no_response"), (6, "no_response"), (8, "mismatch")]
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
