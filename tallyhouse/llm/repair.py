"""Conversations repaired to a role grammar by generalised LR parsing with weighted edits.

Roles count by their first letter and must spell `(s?(ua)+)?`: an optional system turn, then pairs of a user
and an assistant turn, or nothing. Every turn is kept, deleted or given another role, and empty user or
assistant turns are inserted. The parser follows all edits at once: the tops of its graph-structured stack are the stacks the
LR automaton can be in after a row, each linked to the top it came from. Tops that are equal merge into
the one of least (cost, audit); the audit spells the edits.

Audits are never compared as strings. After equally many rows no audit of one stack begins another's, since each ends
with the letter of its last row, so their order is that of the tops they came from, then of the letters added. A top carries a
cost and the rank of its audit. Deletions go before insertions (D sorts before I), so insertions
belong to the row they precede.

A conversation may hold any part of the table. Equal rows are one record with a count, combined before the shuffle; whether
a text was seen before is its smallest turn, again combined first. Records are range-partitioned by
(conversation, turn, role, hash), which cuts inside a conversation. What a part of a conversation does is a table from the stack
before it to (cost, rank) of each stack after it; these small tables are folded over the parts of a conversation, and every
part is then parsed again between the stacks that the fold chose. Only `digests` reads a whole conversation in one
task, as a hash of its text has to: it streams, holding one batch.

Faults of a row, the first that holds: blank (no character beside white space), duplicate (role and text stood
earlier in the conversation), truncated (last such character none of `.!?`).

Defined results: a null role or text counts as one space. Null turns come first and are left out of gaps. A null conversation is a
conversation of its own. Rows of one turn are ordered by role, then by a hash of role and text. Repeated rows are
duplicates of the first. Only the four columns named are read. An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.llm.words import WHITE_SPACE
from tallyhouse.session import stage

REROLE = 3
DELETE = 4
INSERT = 3
TRUNCATED = 3
#: Insertions before one row: two lead back to where they began.
MOST_INSERTS = 2

# The LR automaton of the role grammar:
#   conversation: (nothing) | pairs | s pairs      pairs: pair | pairs pair      pair: u a
SHIFT = {(0, "s"): 3, (0, "u"): 5, (2, "u"): 5, (3, "u"): 5, (6, "u"): 5, (5, "a"): 8}
REDUCE = {8: ("pair", 2), 4: ("pairs", 1), 7: ("pairs", 2)}
GOTO = {(0, "pair"): 4, (0, "pairs"): 2, (2, "pair"): 7, (3, "pair"): 4, (3, "pairs"): 6, (6, "pair"): 7}
ACCEPT = {0, 2, 6}

ROLES = {"u": "user", "a": "assistant"}
#: Pairs of neighbouring initials that the grammar allows.
LEGAL = {"su", "ua", "au"}
SYMBOLS = "sua?"
#: Class of a row that has to go.
GONE = -1

Stack = tuple[int, ...]


def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and all reductions it completes."""
    to = SHIFT.get((stack[-1], symbol))
    if to is None:
        return None
    stack = (*stack, to)
    while stack[-1] in REDUCE:
        name, size = REDUCE[stack[-1]]
        stack = stack[:-size]
        stack = (*stack, GOTO[stack[-1], name])
    return stack


def reachable() -> list[Stack]:
    stacks: list[Stack] = [(0,)]
    for stack in stacks:
        for symbol in "sua":
            after = shifted(stack, symbol)
            if after and after not in stacks:
                stacks.append(after)
    return stacks


STACKS = reachable()


def inserted(stack: Stack) -> list[tuple[Stack, str]]:
    """Stacks that insertions lead to, with the roles inserted."""
    found = [(stack, "")]
    for at, roles in found:
        if len(roles) < MOST_INSERTS:
            found += [(after, roles + role) for role in ROLES if (after := shifted(at, role))]
    return found


def moves(stack: Stack, symbol: str, truncated: bool) -> list[tuple[int, int, str, str]]:
    """(stack after, cost, letters, roles inserted and then given) of the edits of one row, the least for each stack."""
    least = {STACKS.index(stack): (DELETE, "D", "")}
    extra = TRUNCATED if truncated else 0
    for at, roles in inserted(stack):
        cost, letters = INSERT * len(roles) + extra, "I" * len(roles)
        options = [(shifted(at, symbol), cost, letters + "K", roles)]
        options += [(shifted(at, role), cost + REROLE, letters + "R", roles + role) for role in ROLES]
        for after, *edit in options:
            if after:
                place = STACKS.index(after)
                least[place] = min(least.get(place, tuple(edit)), tuple(edit))
    return [(place, *edit) for place, edit in sorted(least.items())]


#: By class of a row (symbol and truncation) and stack.
MOVES = [[moves(stack, symbol, cut) for stack in STACKS] for symbol in SYMBOLS for cut in (False, True)]


def closing(stack: Stack) -> tuple[int, str]:
    """Cost and roles of the insertions that complete a conversation."""
    return min((INSERT * len(roles), roles) for at, roles in inserted(stack) if at[-1] in ACCEPT)


CLOSING = [closing(stack) for stack in STACKS]


def class_of(initial: str, truncated: bool) -> int:
    place = SYMBOLS.find(initial) if initial in ("s", "u", "a") else len(SYMBOLS) - 1
    return 2 * place + truncated


@dataclass
class Tops:
    """Tops of the stack graph after some rows, for one stack before them: (cost, rank of audit) by stack."""

    by_stack: dict[int, tuple[int, int]]
    #: Cost of deletions that every top shares.
    shared: int = 0
    #: By row the (stack before, letters, roles) of each top, if kept; None for a row that has to go.
    trail: list | None = None

    def row(self, kind: int, copies: int) -> None:
        """Read `copies` equal rows; all but the first have to go."""
        if kind == GONE:
            self.shared += DELETE * copies
            if self.trail is not None:
                self.trail.append(None)
            return
        self.shared += DELETE * (copies - 1)
        options, best = MOVES[kind], {}
        for stack, (cost, rank) in self.by_stack.items():
            for after, more, letters, roles in options[stack]:
                edit = (cost + more, rank, letters, stack, roles)
                if after not in best or edit < best[after]:
                    best[after] = edit
        order = sorted(best, key=lambda after: best[after][1:3])
        self.by_stack = {after: (best[after][0], rank) for rank, after in enumerate(order)}
        if self.trail is not None:
            self.trail.append({after: (edit[3], edit[2], edit[4]) for after, edit in best.items()})


@dataclass
class Summary:
    """What the rows of one part of a conversation hold, and what they do to each stack before them."""

    entries: list[int]
    tops: list[Tops] = field(default_factory=list)
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: int = 0
    least: int | None = None
    most: int | None = None

    def __post_init__(self):
        self.tops = [Tops({entry: (0, 0)}) for entry in self.entries]

    def row(self, turn: int | None, initial: str, copies: int, blank: bool, seen: bool, cut: bool) -> int:
        """Read a record; returns its class."""
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.rows, self.last = self.rows + copies, initial
        self.illegal += copies - 1
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += cut and not seen
        kind = GONE if blank or seen else class_of(initial, cut)
        for tops in self.tops:
            tops.row(kind, copies)
        return kind

    def table(self) -> list[int]:
        """(stack before, stack after, cost, rank) of every top, flat."""
        return [
            number
            for entry, tops in zip(self.entries, self.tops)
            for after, (cost, rank) in tops.by_stack.items()
            for number in (entry, after, cost + tops.shared, rank)
        ]


FACTS = "turns long, least long, most long, blank long, duplicate long, truncated long, illegal long"
PART = f"conv CONV, part long, first string, last string, {FACTS}, moves array<long>"
RECORD = "place long, k1 long, k2 long, kind int, copies long"


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """Stretches of equal key of sorted batches: (key, whether it begins here, rows)."""
    before, begun = None, False
    for batch in batches:
        keys = batch.column(key).to_pylist()
        start = 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                begins = not begun or keys[start] != before
                yield keys[start], begins, batch.slice(start, end - start)
                before, begun, start = keys[start], True, end


def batch_of(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def arrow_schema(fields: str, conv: T.DataType) -> tuple[T.StructType, pa.Schema]:
    """Spark's and Arrow's form of a schema; CONV stands for the type of the conversation column."""
    schema = T.StructType.fromDDL(fields.replace("CONV", conv.simpleString()))
    return schema, to_arrow_schema(schema)


def parts_of(ordered: DataFrame) -> DataFrame:
    """Records of sorted ranges with their part and place, and one summary after the records of each part."""
    schema, arrow = arrow_schema(f"{PART}, {RECORD}", ordered.schema["conv"].dataType)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        place, nth, conv, summary = 0, -1, None, None

        def closed() -> dict:
            facts = {name.split()[0]: getattr(summary, name.split()[0]) for name in FACTS.split(", ")}
            ends = {"first": summary.first, "last": summary.last, "moves": summary.table()}
            return {"conv": conv, "part": part + nth, **facts, **ends}

        for key, begins, rows in groups(batches, "conv"):
            out = []
            if begins:
                if summary is not None:
                    out.append(closed())
                conv, nth = key, nth + 1
                # Only the first conversation of a range can have begun in the range before.
                summary = Summary(list(range(len(STACKS))) if nth == 0 else [0])
            columns = (rows.column(name).to_pylist() for name in ("turn", "initial", "copies", "blank", "seen", "cut", "k1", "k2"))
            for *facts, k1, k2 in zip(*columns):
                kind = summary.row(*facts)
                record = {"part": part + nth, "place": place, "k1": k1, "k2": k2, "kind": kind, "copies": facts[2]}
                out.append(record)
                place += 1
            yield batch_of(arrow, out)
        if summary is not None:
            yield batch_of(arrow, [closed()])

    return ordered.mapInArrow(read, schema)


CHOICE = "conv CONV, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, end string, last_part long, path array<struct<part:long,before:int,after:int>>"


def fold(parts: list[dict]) -> dict:
    """Faults, cost and the stacks between the parts of one conversation, given in order."""
    tops, trail = {0: (0, 0)}, []
    for part in parts:
        best, flat = {}, part["moves"]
        for entry, after, cost, rank in zip(*(flat[i::4] for i in range(4))):
            if entry in tops:
                edit = (tops[entry][0] + cost, tops[entry][1], rank, entry)
                if after not in best or edit < best[after]:
                    best[after] = edit
        order = sorted(best, key=lambda after: best[after][1:3])
        tops = {after: (best[after][0], rank) for rank, after in enumerate(order)}
        trail.append({after: edit[3] for after, edit in best.items()})
    cost, _, end = min((cost + CLOSING[stack][0], rank, stack) for stack, (cost, rank) in tops.items())
    path, after = [], end
    for part, came in zip(reversed(parts), reversed(trail)):
        path.append({"part": part["part"], "before": came[after], "after": after})
        after = came[after]
    timed = [part for part in parts if part["turns"]]
    turns = sum(part["turns"] for part in timed) - sum(a["most"] == b["least"] for a, b in zip(timed, timed[1:]))
    joints = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
    return {
        "conv": parts[0]["conv"],
        "gaps": timed[-1]["most"] - timed[0]["least"] + 1 - turns if timed else 0,
        **{name: sum(part[name] for part in parts) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(part["illegal"] for part in parts) + joints,
        "cost": cost,
        "end": CLOSING[end][1],
        "last_part": parts[-1]["part"],
        "path": path[::-1],
    }


def folded(summaries: DataFrame) -> DataFrame:
    """One row per conversation from the summaries of its parts."""
    schema, arrow = arrow_schema(CHOICE, summaries.schema["conv"].dataType)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for _, begins, rows in groups(batches, "conv"):
            if begins and held:
                yield batch_of(arrow, [fold(held)])
                held = []
            held += rows.to_pylist()
        if held:
            yield batch_of(arrow, [fold(held)])

    return summaries.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(choose, schema)


EDIT = "part long, place long, k1 long, k2 long, letter string, roles string, audit string"


def edits_of(records: DataFrame, choice: DataFrame) -> DataFrame:
    """For each part its audit, and for each record that stays its letter, the roles inserted before it and its new role."""
    schema, arrow = arrow_schema(EDIT, T.LongType())
    path = choice.select(F.explode("path").alias("p")).select(
        "p.part", F.lit(-1).cast("long").alias("place"), F.col("p.before").alias("before"), F.col("p.after").alias("after")
    )
    rows = records.unionByName(path, allowMissingColumns=True)

    def edited(rows: list[dict], tops: Tops, after: int) -> Iterator[dict]:
        audit = []
        for row, came in zip(reversed(rows), reversed(tops.trail)):
            audit.append("D" * (row["copies"] - (came is not None)))
            if came is not None:
                after, letters, roles = came[after]
                audit.append(letters)
                if letters != "D":
                    yield {name: row[name] for name in ("part", "place", "k1", "k2")} | {"letter": letters[-1], "roles": roles}
        yield {"part": rows[0]["part"], "audit": "".join(reversed(audit))}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tops, after = [], None, None
        for _, begins, rows in groups(batches, "part"):
            found = rows.to_pylist()
            if begins:
                if held:
                    yield batch_of(arrow, list(edited(held, tops, after)))
                choice, *found = found
                held, tops, after = [], Tops({choice["before"]: (0, 0)}, trail=[]), choice["after"]
            for row in found:
                tops.row(row["kind"], row["copies"])
            held += found
        if held:
            yield batch_of(arrow, list(edited(held, tops, after)))

    return rows.repartition("part").sortWithinPartitions("part", "place").mapInArrow(parse, schema)


@dataclass(frozen=True)
class Repaired:
    #: One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    report: DataFrame
    #: The repaired turns: conv, part, place, nth (their order), edit (K, R or I), role, text.
    turns: DataFrame


def hashed(names: list[str], *seeds: int) -> list[Column]:
    parts = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in seeds]


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repaired:
    """Faults, cheapest repair and repaired turns of every conversation that has a row.

    turn_col holds whole numbers. Writes tables on the way, and so runs jobs when called.
    """
    space = F.lit(" ")
    rows = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
    )
    k1, k2 = hashed(["conv", "turn", "role", "text"], 1, 2)
    s1, s2 = hashed(["conv", "role", "text"], 3, 4)
    rows = rows.select("*", k1.alias("k1"), k2.alias("k2"), F.rtrim("text", F.lit(WHITE_SPACE)).alias("bare"))
    last = F.right("bare", F.lit(1))
    described = rows.select(
        "k1", "k2", "conv", "turn", "role", s1.alias("s1"), s2.alias("s2"),
        (F.length("bare") == 0).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    names = [name for name in described.columns if name not in ("k1", "k2")]
    facts = described.groupBy("k1", "k2").agg(
        *(F.first(name).alias(name) for name in names), F.count(F.lit(1)).alias("copies")
    )
    facts = stage(facts, "turns")
    # The smallest turn of a text, null first.
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = facts.groupBy("s1", "s2").agg(F.min(when).alias("earliest"))
    marked = facts.withColumn("own", when).join(first, ["s1", "s2"])
    order = ["conv", "turn", "role", "k1", "k2"]
    ordered = (
        marked.select(*order, F.left("role", F.lit(1)).alias("initial"), "copies", "blank", "cut", (F.col("own") != F.col("earliest")).alias("seen"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    found = stage(parts_of(ordered), "parts")
    summaries = found.filter("place IS NULL").select(*(name.split()[0] for name in PART.split(", ")))
    choice = stage(folded(summaries), "choice")
    records = found.filter("place IS NOT NULL").select("part", *(name.split()[0] for name in RECORD.split(", ")))
    edits = stage(edits_of(records, choice), "edits")

    # Audits of parts meet their conversation through its path.
    of_part = choice.select("conv", F.explode("path.part").alias("part")).join(
        edits.filter("place IS NULL").select("part", "audit"), "part"
    )
    audits = of_part.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "audit"))).alias("audits"))
    faults = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    both = choice.select("conv", *faults, "end").unionByName(audits, allowMissingColumns=True)
    firsts = [F.first(name, ignorenulls=True).alias(name) for name in (*faults, "end", "audits")]
    spelt = F.concat(F.array_join("audits.audit", ""), F.repeat(F.lit("I"), F.length("end")))
    report = both.groupBy("conv").agg(*firsts).select("conv", *faults, spelt.alias("audit"))

    texts = rows.filter(F.length("bare") > 0).groupBy("k1", "k2").agg(*(F.first(name).alias(name) for name in ("conv", "role", "text")))
    kept = edits.filter("place IS NOT NULL").select("part", "place", "k1", "k2", "letter", "roles").join(texts, ["k1", "k2"])
    rerole = F.col("letter") == "R"
    before = F.when(rerole, F.left("roles", F.length("roles") - 1)).otherwise(F.col("roles"))
    own = F.struct(
        F.col("letter").alias("edit"),
        F.when(rerole, role_of(F.right("roles", F.lit(1)))).otherwise(F.col("role")).alias("role"),
        F.col("text").alias("text"),
    )
    kept = kept.select("conv", "part", "place", F.concat(empty_turns(before), F.array(own)).alias("lines"))
    end = choice.filter("end <> ''").select(
        "conv", F.col("last_part").alias("part"), F.lit(2**62).alias("place"), empty_turns(F.col("end")).alias("lines")
    )
    turns = kept.unionByName(end).select("conv", "part", "place", F.posexplode("lines").alias("nth", "line"))
    return Repaired(report, turns.select("conv", "part", "place", "nth", "line.*"))


def role_of(letter: Column) -> Column:
    (_, name), *others = ROLES.items()
    role = F.lit(name)
    for other, name in others:
        role = F.when(letter == other, name).otherwise(role)
    return role


def empty_turns(roles: Column) -> Column:
    """Inserted turns, one for each letter of roles."""
    letters = F.filter(F.split(roles, ""), lambda letter: letter != "")
    return F.transform(
        letters,
        lambda letter: F.struct(F.lit("I").alias("edit"), role_of(letter).alias("role"), F.lit("").alias("text")),
    )


def digests(turns: DataFrame) -> DataFrame:
    """conv and repaired_sha256 of the `role:text` lines of each conversation, newline-joined."""
    schema, arrow = arrow_schema("conv CONV, repaired_sha256 string", turns.schema["conv"].dataType)
    lines = turns.select("conv", "part", "place", "nth", F.concat("role", F.lit(":"), "text").alias("line"))

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for key, begins, rows in groups(batches, "conv"):
            if begins:
                if digest is not None:
                    yield batch_of(arrow, [{"conv": conv, "repaired_sha256": digest.hexdigest()}])
                conv, digest = key, hashlib.sha256()
            for i, line in enumerate(rows.column("line")):
                if i or not begins:
                    digest.update(b"\n")
                digest.update(line.as_py().encode("utf-8", "surrogatepass"))
        if digest is not None:
            yield batch_of(arrow, [{"conv": conv, "repaired_sha256": digest.hexdigest()}])

    order = ["conv", "part", "place", "nth"]
    return lines.repartition("conv").sortWithinPartitions(*order).mapInArrow(hash_lines, schema)
