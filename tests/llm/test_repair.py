from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pandas as pd
import pytest
from samples import SF_DIR

from tallyhouse.llm import repair
from tallyhouse.llm.queries import QUERIES, damaged

SCHEMA = "conv_id long, turn long, role string, text string"
OTHER = {"u": "user", "a": "assistant"}


def faults(rows):
    """Fault of each (role, text) in order."""
    seen, found = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """Least (cost, audit, lines) by Dijkstra over whole edit strings: states of the grammar read from its pattern."""
    # 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant.
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    found = faults(rows)
    best = {(0, 0): (0, "", ())}

    def settle(i):
        # Insertions cost, so a few rounds settle them.
        for _ in range(4):
            for state in range(4):
                if (i, state) in best:
                    cost, audit, lines = best[i, state]
                    for role in "ua":
                        if (state, role) in step:
                            offer((i, step[state, role]), (cost + 3, audit + "I", (*lines, f"{OTHER[role]}:")))

    def offer(key, value):
        if key not in best or value[:2] < best[key][:2]:
            best[key] = value

    for i, (role, text) in enumerate(rows):
        settle(i)
        for state in range(4):
            if (i, state) not in best:
                continue
            cost, audit, lines = best[i, state]
            offer((i + 1, state), (cost + 4, audit + "D", lines))
            if found[i] in ("blank", "duplicate"):
                continue
            cut = 3 * (found[i] == "truncated")
            if (state, role[:1]) in step:
                offer((i + 1, step[state, role[:1]]), (cost + cut, audit + "K", (*lines, f"{role}:{text}")))
            for other, name in OTHER.items():
                if (state, other) in step:
                    offer((i + 1, step[state, other]), (cost + cut + 3, audit + "R", (*lines, f"{name}:{text}")))
    settle(len(rows))
    return min(best[len(rows), state] for state in (0, 3) if (len(rows), state) in best)


def all_edits(rows):
    """Least (cost, audit) over every edit string with up to two insertions between rows, by enumeration."""
    found, results = faults(rows), []

    def go(i, cost, audit, roles):
        if len(audit) > 2 * len(rows) + 2 or cost > 4 * len(rows):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            results.append((cost, audit))
        if not audit.endswith("II"):
            for role in "ua":
                go(i, cost + 3, audit + "I", roles + role)
        if i < len(rows):
            go(i + 1, cost + 4, audit + "D", roles)
            if found[i] not in ("blank", "duplicate"):
                cut = 3 * (found[i] == "truncated")
                go(i + 1, cost + cut, audit + "K", roles + (rows[i][0][:1] or "?"))
                for role in "ua":
                    go(i + 1, cost + cut + 3, audit + "R", roles + role)

    go(0, 0, "", "")
    return min(results)


def expected(rows):
    """Contract row of one conversation from its (turn, role, text)."""
    key = [(role, text) for _, role, text in rows]
    found = faults(key)
    turns = [turn for turn, *_ in rows if turn is not None]
    initials = [role[:1] for role, _ in key]
    cost, audit, lines = cheapest(key)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def harmed(rows):
    """The contract's damage, on (conv_id, turn, role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            out[conv]
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out[conv] += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return out


def whole(spark, rows):
    """conv -> (gaps .. cost, audit, sha256) from the operator."""
    repaired = repair.repair(rows)
    sums = {r.conv: r.repaired_sha256 for r in repair.digests(repaired.turns).collect()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv: (*(r[n] for n in names), sums.get(r.conv, empty)) for r in repaired.report.collect()}


def invented(rng, n, texts):
    roles = rng.choice([("user", "assistant"), ("system", "user", "assistant"), ("user", "assistant", "tool", " ", "")])
    rows = [(turn, rng.choice(roles), rng.choice(texts)) for turn in sorted(rng.choices(range(2 * n), k=n))]
    # Distinct turns, as the order inside a turn is by hash.
    return [(None if i == 0 and rng.random() < 0.3 else 2 * i + (turn % 2), role, text) for i, (turn, role, text) in enumerate(rows)]


TEXTS = ["", " \t", "x.", "y!", "z", "w ", "v?\n", "q. \x1c", "é", "..."] + [f"text {i}." for i in range(30)]


def test_plain_search_is_the_least_of_all_edits():
    rng = random.Random(3)
    for _ in range(150):
        rows = [(role, text) for _, role, text in invented(rng, rng.randint(0, 4), TEXTS)]
        assert cheapest(rows)[:2] == all_edits(rows)


@pytest.mark.parametrize("partitions", [1, 40])
def test_invented_conversations(spark, settings, partitions):
    """Also with parts that cut conversations everywhere."""
    settings(**{"spark__sql__shuffle__partitions": str(partitions), "spark__sql__adaptive__enabled": "false"})
    rng = random.Random(partitions)
    sizes = [rng.randint(1, 12) for _ in range(40)] + [200, 500]
    rows = {conv if conv else None: invented(rng, n, TEXTS) for conv, n in enumerate(sizes)}
    table = [(conv, *row) for conv, own in rows.items() for row in own]
    rng.shuffle(table)
    assert whole(spark, spark.createDataFrame(table, SCHEMA)) == {conv: expected(own) for conv, own in rows.items()}


def test_query_against_brute_force(spark):
    given = pd.read_parquet(f"{SF_DIR}/conversations.parquet")
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_glr_repair"](spark, SF_DIR).collect()}
    rows = harmed(given.itertuples(index=False, name=None))
    assert found == {conv: expected(own) for conv, own in rows.items()}
    assert len(found) == given.conv_id.nunique()


def test_awkward_rows(spark, tmp_path):
    long = "word " * 200_000
    table = [
        (1, None, None, None),
        (1, 0, "user", "hello."),
        (1, 0, "user", "hello."),
        (1, 1, "assistant", None),
        (None, 3, "assistant", long),
        (None, 1, "user", "no id here"),
        (2, 5, "", ""),
        (3, None, "user", "a."),
        (3, None, "user", "a."),
        (4, 2**62, "user", "x."),
        (4, -3, "assistant", "x."),
    ]
    docs = spark.createDataFrame([(*row, 1, 2) for row in table], SCHEMA + ", part long, copies long")
    rows = defaultdict(list)
    for conv, turn, role, text in sorted(table, key=lambda r: (r[1] is not None, r[1] or 0)):
        rows[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert whole(spark, docs) == {conv: expected(own) for conv, own in rows.items()}
    (tmp_path / "in").mkdir()
    docs.write.parquet(str(tmp_path / "in/conversations.parquet"))
    query = QUERIES["op11_glr_repair"](spark, str(tmp_path / "in"))
    assert {r.conv_id: tuple(r)[1:] for r in query.collect()} == {c: expected(o) for c, o in harmed(table).items()}


def test_no_rows(spark, tmp_path):
    assert whole(spark, spark.createDataFrame([], SCHEMA)) == {}
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert QUERIES["op11_glr_repair"](spark, str(tmp_path)).count() == 0


def test_a_conversation_that_loses_all_rows(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    (row,) = QUERIES["op11_glr_repair"](spark, str(tmp_path)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_equal_rows_of_a_hot_conversation_are_one_record(spark):
    rows = spark.range(30_000).selectExpr("7L AS conv_id", "0L AS turn", "'user' AS role", "'again.' AS text")
    found = whole(spark, rows.union(spark.createDataFrame([(7, 1, "assistant", "yes.")], SCHEMA)))
    assert found[7][:6] == (0, 0, 29_999, 0, 29_999, 4 * 29_999) and found[7][6] == "K" + "D" * 29_999 + "K"


def test_damage_keeps_columns(spark):
    rows = damaged(spark.createDataFrame([(1, 0, "user", "x.")], SCHEMA))
    assert rows.columns == ["conv_id", "turn", "role", "text"]
