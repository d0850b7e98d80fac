"""Personal data: high-recall generators, boosted trees, calibrated thresholds.

Generators propose spans of four kinds, strict forms and loose ones, which may overlap. A strict
span that passes its check (address parts, Luhn sum, number of digits) is a base span and always
stays. Every other candidate is scored by boosted trees over its format (digits, separators,
leading character, strict or loose) and the characters on either side. A candidate is added if its
score reaches its kind's threshold, the lowest at which held-out candidates are right often enough,
and if it overlaps no base span and no other such candidate that starts before it (or there, with a higher score).

The trees learn from the candidates of all distinct texts. Those that could be added, the open ones, overlap no
base span; they count as right if a key word of their kind stands before them, else as wrong, so
neither key words nor the check are features. Base spans are right, as they are and rewritten in the loose forms of
their kind ('+' or the country left out, '@' as [at], '.' as [dot]); for each kind and form, strict or loose, they weigh at
most as much as the open candidates, so that their number outvotes no evidence about those. A fifth of all
is held out. With few of them a threshold leans on the trees' own score, which counts
as `PRIOR` held-out candidates; where none held out is right there is no threshold and nothing is added.

Everything on the executors is SQL functions. The features are small codes, so the table of distinct
candidates, from which the driver grows the trees, has at most `CELLS` rows whatever the
number of documents; the trees go back as CASE expressions. Texts are never shuffled.

Patterns have possessive loops only, so neither long runs nor many matches nest calls or backtrack
far; they find what the plain forms in the comments find. Overlaps and offsets come from running totals over the
spans in order of start, and a text is cut by blocks, so work grows with the text and its spans, not their product.

Defined results: a null text has no spans. Ids play no part, so null or repeated ids and repeated
rows are treated alike. Columns of the input stay; one named like the spans column is replaced. An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import inf

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.rows import absent

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
STRICT_EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
STRICT_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# [0-9]([\x20-]?[0-9])+ with 12 digits or more
STRICT_CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
STRICT_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOOSE_EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[(\[{]at[)\]}] ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]++)++"
)
LOOSE_PHONE = r"(?<![0-9+.])(?:\([0-9]{2,4}\)|[0-9]{2,4}+)(?:[ .-]{1,2}+[0-9]{2,4}+){2,4}+(?![0-9.]?[0-9])"


@dataclass(frozen=True)
class Generator:
    kind: int
    pattern: str
    loose: bool
    #: A cheap test that every text with a match passes.
    needs: str


GENERATORS = (
    Generator(EMAIL, STRICT_EMAIL, False, "contains(text, '@')"),
    Generator(EMAIL, LOOSE_EMAIL, True, r"text RLIKE r'[(\[{]at[)\]}]'"),
    Generator(IP, STRICT_IP, False, r"text RLIKE r'[0-9]\.[0-9]++\.[0-9]'"),
    Generator(CARD, STRICT_CARD, False, r"text RLIKE r'[0-9](?:[\x20-]?[0-9]){11}'"),
    Generator(PHONE, STRICT_PHONE, False, r"text RLIKE r'\+[0-9]'"),
    Generator(PHONE, LOOSE_PHONE, True, r"text RLIKE r'[0-9][ .)-]{1,2}[0-9]{2,4}[ .-]{1,2}[0-9]{2}'"),
)
#: Rewritings of a base span, each a list of (pattern, replacement), into loose forms of its kind.
TWINS = {
    EMAIL: (
        (LOOSE_EMAIL, [("@", "[at]")]),
        (LOOSE_EMAIL, [(r"\.", " [dot] "), ("@", " [at] ")]),
        (LOOSE_EMAIL, [("@", " (at) ")]),
    ),
    PHONE: (
        (LOOSE_PHONE, [(r"^\+", "")]),
        (LOOSE_PHONE, [(r"^\+[0-9]{1,3}[ .-]*", "")]),
    ),
}
VALID_IP = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?:\.|$)){4}$"
KEY_WORDS = {
    EMAIL: "mail|contact|write to",
    IP: r"\bip\b|host|server|address|addr",
    CARD: "card|visa|master|amex|credit|debit|pay",
    PHONE: "tel|phone|call|fax|mobile|cell|whatsapp",
}
CONTEXT = 24

# Code of each feature and how many values it has.
FEATURES = {
    "kind": 4,
    "loose": 2,
    "digits": 21,
    "separators": 5,
    "lead": 8,
    "left": 3,
    "right": 3,
}
FOLDS = 5
CELLS = int(np.prod(list(FEATURES.values()))) * FOLDS
SPAN = "start long, end long, base boolean, twin boolean, keyed boolean, " + ", ".join(f"{name} int" for name in FEATURES)

ROUNDS = 40
DEPTH = 3
RATE = 0.3
SMOOTH = 1.0
#: Share of held-out candidates at or above a threshold that must be right.
PRECISION = 0.98
#: Held-out candidates that the score at a threshold counts as, once one of them is right.
PRIOR = 4.0

#: Spans of a block whose offsets are added up on their own.
BLOCK = 64
#: Characters of a block of text that is cut on its own.
CUT = 1024
#: Behind the end of any text.
FAR = 2**62


def luhn(digits: Column) -> Column:
    def doubled(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - place, F.lit(1))) - F.lit(ord("0"))
        twice = digit * (place % 2 + 1)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), doubled)
    return total % 10 == 0


def passes(kind: int, found: Column, digits: Column) -> Column:
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return found.rlike(VALID_IP)
    if kind == CARD:
        return F.length(digits).between(12, 19) & luhn(digits)
    return F.length(digits).between(9, 15)


def side(character: Column) -> Column:
    """0 white space or an end of the text, 1 letter or digit, 2 anything else."""
    return (
        F.when(character.rlike(r"^[\p{L}\p{N}]"), 1).when(character.rlike(r"^\S"), 2).otherwise(0)
    )


def lead(found: Column) -> Column:
    first = F.substring(found, 1, 1)
    codes = F.when(first == "+", 1).when(first == "(", 2)
    for code, character in enumerate("3456", start=3):
        codes = codes.when(first == character, code)
    return codes.when(first.rlike("[A-Za-z]"), 7).otherwise(0)


def nothing() -> Column:
    return F.array().cast(f"array<struct<{typed(SPAN)}>>")


def cut(parts: Column, found: Column) -> Column:
    """The matches and the text on either side of each."""
    return F.transform(
        found,
        lambda text, i: F.struct(
            text.alias("found"), F.get(parts, i).alias("before"), F.get(parts, i + 1).alias("after")
        ),
    )


def described(
    kind: int, start: Column, match: Column, text: Column, loose: bool, twin: bool = False
) -> Column:
    """A span with its codes."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    before = F.right(match["before"], F.lit(CONTEXT))
    codes = {
        "kind": F.lit(kind),
        "loose": F.lit(int(loose)),
        "digits": F.least(F.length(digits), F.lit(20)),
        "separators": F.least(F.length(F.regexp_replace(text, "[^ ().-]", "")), F.lit(4)),
        "lead": lead(text),
        "left": side(F.right(before, F.lit(1))),
        "right": side(F.left(match["after"], F.lit(1))),
    }
    base = F.lit(False) if loose else passes(kind, text, digits)
    return F.struct(
        start.alias("start"),
        (start + F.length(text)).alias("end"),
        base.alias("base"),
        F.lit(twin).alias("twin"),
        F.lower(before).rlike(KEY_WORDS[kind]).alias("keyed"),
        *(code.cast("int").alias(name) for name, code in codes.items()),
    )


def let(value: Column, body) -> Column:
    """body of a value that is evaluated once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge) -> Column:
    """Running merge over an array: of each value and all before it; merge(null, x) is x.

    Blocks are merged on their own, then their totals, so that what grows by copying stays short.
    No CASE stands around nested functions here: Spark would derive their type twice for each level.
    """

    def scan(array: Column) -> Column:
        return F.aggregate(
            array,
            F.array().cast("array<long>"),
            lambda done, value: F.concat(done, F.array(merge(F.get(done, F.size(done) - 1), value))),
        )

    def merged(inner: Column) -> Column:
        totals = scan(F.transform(inner, lambda block: F.get(block, F.size(block) - 1)))
        return let(
            totals,
            lambda totals: F.flatten(
                F.transform(inner, lambda block, b: F.transform(block, lambda value: merge(F.get(totals, b - 1), value)))
            ),
        )

    def blocks(values: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        return let(F.transform(firsts, lambda b: scan(F.slice(values, b * BLOCK + 1, BLOCK))), merged)

    return let(values, blocks)


def added(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + b


def candidates_of(generator: Generator, parts: Column, found: Column) -> Column:
    """Spans of one generator, from the matches and the text between them."""

    def span(matches: Column, ends: Column) -> Column:
        def one(match: Column, i: Column) -> Column:
            start = F.get(ends, i) - F.length(match["found"])
            return described(generator.kind, start, match, match["found"], generator.loose)

        return F.transform(matches, one)

    def all_(matches: Column) -> Column:
        lengths = F.transform(matches, lambda m: (F.length(m["before"]) + F.length(m["found"])).cast("long"))
        return let(running(lengths, added), lambda ends: span(matches, ends))

    return let(cut(parts, found), all_)


def twins_of(generator: Generator, parts: Column, found: Column) -> Column:
    """The base spans of one generator, rewritten in loose forms; they start at the number of their match."""

    def rewritten(match: Column, i: Column) -> Column:
        text, twins = match["found"], []
        base = passes(generator.kind, text, F.regexp_replace(text, "[^0-9]", ""))
        for pattern, changes in TWINS[generator.kind]:
            form = text
            for old, new in changes:
                form = F.regexp_replace(form, old, new)
            twin = described(generator.kind, i.cast("long"), match, form, True, True)
            whole = base & form.rlike(f"^(?:{pattern})$")
            twins.append(F.when(whole, F.array(twin)).otherwise(nothing()))
        return F.concat(*twins)

    return F.flatten(F.transform(cut(parts, found), rewritten))


def typed(fields: str) -> str:
    return ", ".join(": ".join(part.split(" ")) for part in fields.split(", "))


def with_candidates(docs: DataFrame, text_col: str, spans: str, twins: str | None = None) -> DataFrame:
    """docs with the spans that any generator proposes, by start, and if asked for the twins of base spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    empty = F.array().cast("array<string>")
    columns = [*docs.columns, spans, *([twins] if twins else [])]
    founds = [absent(docs, f"found{nth}") for nth in range(len(GENERATORS))]
    parts = [absent(docs, f"parts{nth}") for nth in range(len(GENERATORS))]
    all_found = {}
    for name, generator in zip(founds, GENERATORS):
        needs = F.expr(generator.needs.replace("text", f"coalesce(`{text_col}`, '')", 1))
        found = F.regexp_extract_all(text, F.lit(f"({generator.pattern})"), F.lit(1))
        all_found[name] = F.when(needs, found).otherwise(empty)
    docs = docs.withColumns(all_found)
    between = {}
    for name, own, generator in zip(parts, founds, GENERATORS):
        between[name] = F.when(F.size(own) > 0, F.split(text, generator.pattern, -1)).otherwise(empty)
    docs = docs.withColumns(between)
    sources = [(generator, F.col(part), F.col(own)) for generator, part, own in zip(GENERATORS, parts, founds)]
    made = {spans: F.array_sort(F.concat(*(candidates_of(*source) for source in sources)))}
    if twins:
        made[twins] = F.concat(*(twins_of(*s) for s in sources if not s[0].loose and s[0].kind in TWINS))
    return docs.withColumns(made).select(columns)


def covered(spans: Column, then) -> Column:
    """then(span, whether a base span covers part of it) of each span that is none itself, spans sorted by start.

    A base span before it ends behind its start, or one after it starts before its end.
    """
    ends = F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(0))
    starts = F.reverse(F.transform(spans, lambda s: F.when(s["base"], s["start"]).otherwise(FAR)))

    def both(spans: Column, before: Column, after: Column) -> Column:
        def one(span: Column, i: Column) -> Column:
            left = F.coalesce(F.get(before, i - 1), F.lit(0)) > span["start"]
            right = F.coalesce(F.get(after, F.size(spans) - 2 - i), F.lit(FAR)) < span["end"]
            return then(span, ~span["base"] & (left | right))

        return F.transform(spans, one)

    return let(
        running(ends, F.greatest),
        lambda before: let(running(starts, F.least), lambda after: both(spans, before, after)),
    )


@dataclass
class Model:
    """Boosted trees over the codes, and the threshold of each kind."""

    trees: list = field(default_factory=list)
    prior: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return self.prior + sum((grown(tree, codes) for tree in self.trees), np.zeros(len(codes)))

    def score(self, span: Column) -> Column:
        """Probability that a candidate is personal data."""
        margin = F.lit(self.prior)
        for tree in self.trees:
            margin = margin + as_column(tree, span)
        return 1 / (1 + F.exp(-margin))

    def threshold(self, span: Column) -> Column:
        value = F.lit(inf)
        for kind, threshold in self.thresholds.items():
            value = F.when(span["kind"] == kind, F.lit(threshold)).otherwise(value)
        return value


# A tree is a number, or (feature, highest value that goes left, left tree, right tree).


def grown(tree, codes: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(codes), tree)
    feature, most, low, high = tree
    return np.where(codes[:, feature] <= most, grown(low, codes), grown(high, codes))


def as_column(tree, span: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, most, low, high = tree
    name = list(FEATURES)[feature]
    return F.when(span[name] <= most, as_column(low, span)).otherwise(as_column(high, span))


def grow(codes: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, depth: int):
    """Regression tree that lowers the logistic loss most at each split."""
    g, h = gradient.sum(), curvature.sum()
    leaf = float(RATE * g / (h + SMOOTH))
    if depth == 0:
        return leaf
    best, best_gain = None, 1e-6
    for feature, values in enumerate(FEATURES.values()):
        left_g = np.cumsum(np.bincount(codes[:, feature], gradient, values))[:-1]
        left_h = np.cumsum(np.bincount(codes[:, feature], curvature, values))[:-1]
        if not len(left_g):
            continue
        gains = (
            left_g**2 / (left_h + SMOOTH)
            + (g - left_g) ** 2 / (h - left_h + SMOOTH)
            - g**2 / (h + SMOOTH)
        )
        most = int(gains.argmax())
        if gains[most] > best_gain:
            best, best_gain = (feature, most), gains[most]
    if best is None:
        return leaf
    low = codes[:, best[0]] <= best[1]
    return (
        *best,
        grow(codes[low], gradient[low], curvature[low], depth - 1),
        grow(codes[~low], gradient[~low], curvature[~low], depth - 1),
    )


def fit_cells(
    codes: np.ndarray,
    right: np.ndarray,
    wrong: np.ndarray,
    held_out: np.ndarray,
    sure: np.ndarray | None = None,
) -> Model:
    """Model from distinct candidates and how often each was right and wrong.

    sure: how often each was a base span or a twin of one.
    """
    model = Model()
    train = ~held_out
    learnt = right.copy()
    if sure is not None:
        form = codes[:, 0] * 2 + codes[:, 1]
        open_ = np.bincount(form, right + wrong, 2 * len(KINDS))
        known = np.bincount(form, sure, 2 * len(KINDS))
        learnt += sure * np.minimum(1.0, open_ / np.maximum(known, 1.0))[form]
    r, w, x = learnt[train], wrong[train], codes[train]
    if r.sum() + w.sum() == 0:
        return model
    model.prior = float(np.log((r.sum() + SMOOTH) / (w.sum() + SMOOTH)))
    margin = np.full(len(x), model.prior)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x, r * (1 - p) - w * p, (r + w) * p * (1 - p), DEPTH)
        model.trees.append(tree)
        margin += grown(tree, x)
    scores = 1 / (1 + np.exp(-model.margins(codes)))
    for kind in range(len(KINDS)):
        own = codes[:, 0] == kind
        order = np.argsort(-scores[own], kind="stable")
        s = scores[own][order]
        good = np.cumsum((learnt * held_out)[own][order])
        all_ = good + np.cumsum((wrong * held_out)[own][order])
        ends = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)
        # The trees' own score is no evidence: at least one held-out candidate has to be right.
        enough = ends & (good > 0) & (good + PRIOR * s >= PRECISION * (all_ + PRIOR))
        if enough.any():
            model.thresholds[kind] = float(s[np.flatnonzero(enough)[-1]]) - 1e-9
    return model


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds learnt on all candidates of all distinct texts."""

    def marked(c: Column, hidden: Column) -> Column:
        return F.struct(c.alias("c"), c["base"].alias("sure"), hidden.alias("covered"))

    texts = docs.select(F.col(text_col).alias("text"))
    found = with_candidates(texts, "text", "spans", "twins")
    spans = let(F.col("spans"), lambda spans: covered(spans, marked))
    twins = F.transform("twins", lambda c: F.struct(c.alias("c"), F.lit(True).alias("sure"), F.lit(False).alias("covered")))
    found = found.select(F.xxhash64("text").alias("h"), F.concat(spans, twins).alias("spans"))
    # With explode() Spark would also filter on the size of spans, below the columns that hold the matches, and so match
    # the whole text again for every span.
    found = found.select("h", F.explode_outer("spans").alias("span")).filter("NOT span.covered")
    # A text may come in many rows and counts once; its candidates are numbers.
    found = found.select("h", "span.c.*", "span.sure").distinct()
    dealt = F.pmod(F.xxhash64("h", "start"), F.lit(FOLDS))
    fold = dealt.cast("int").alias("fold")
    cells = (
        found.groupBy(*FEATURES, fold)
        .agg(
            F.count_if(~F.col("sure") & F.col("keyed")).alias("right"),
            F.count_if(~F.col("sure") & ~F.col("keyed")).alias("wrong"),
            F.count_if("sure").alias("known"),
        )
        .collect()
    )
    n = len(FEATURES)
    table = np.array([list(map(int, cell)) for cell in cells], dtype=np.int64).reshape(len(cells), n + 4)
    table = table[np.lexsort(table.T[::-1])]
    right, wrong, sure = table[:, n + 1 :].T * 1.0
    return fit_cells(table[:, :n], right, wrong, table[:, n] == 0, sure)


def find_spans(
    docs: DataFrame, model: Model, text_col: str = "text", spans_col: str = "spans"
) -> DataFrame:
    """docs with spans_col: array of (start, kind, end, base), sorted; code points, end exclusive."""

    def scored(c: Column, hidden: Column) -> Column:
        return F.struct(
            c["start"].alias("start"),
            F.when(c["base"], 0.0).otherwise(-model.score(c)).alias("minus"),
            c["kind"].alias("kind"),
            c["end"].alias("end"),
            c["base"].alias("base"),
            hidden.alias("hidden"),
        )

    def first(open_: Column) -> Column:
        """Those that start behind the end of all before them."""

        def clear(ends: Column) -> Column:
            own = F.transform(
                open_, lambda c, i: F.struct(c.alias("c"), (F.coalesce(F.get(ends, i - 1), F.lit(0)) <= c["start"]).alias("clear"))
            )
            return F.transform(F.filter(own, lambda o: o["clear"]), lambda o: o["c"])

        return let(running(F.transform(open_, lambda c: c["end"]), F.greatest), clear)

    def chosen(all_: Column) -> Column:
        base = F.filter(all_, lambda c: c["base"])
        open_ = F.filter(all_, lambda c: ~c["base"] & ~c["hidden"] & (-c["minus"] >= model.threshold(c)))
        spans = F.concat(base, let(F.array_sort(open_), first))
        return F.transform(
            spans,
            lambda c: F.struct(
                c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base")
            ),
        )

    docs = docs.drop(spans_col)
    candidates = absent(docs, "candidates")
    found = with_candidates(docs, text_col, candidates)
    # Each candidate is scored once, and the trees stand in the plan once.
    spans = let(F.col(candidates), lambda spans: let(covered(spans, scored), chosen))
    return found.withColumn(spans_col, F.array_sort(spans)).drop(candidates)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """docs with each span of its text replaced by its kind in brackets; overlapping ones count as the first."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    text, spans = F.col(text_col), F.col(spans_col)

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        """Characters from start to end; only the blocks that hold them are read."""
        first = F.floor(start / CUT).cast("int")
        own = F.slice(blocks, first + 1, F.floor((end - 1) / CUT).cast("int") - first + 1)
        cut = F.substring(F.array_join(own, ""), (start % CUT + 1).cast("int"), (end - start).cast("int"))
        return F.when(end > start, cut).otherwise("")

    def replaced(blocks: Column, ends: Column) -> Column:
        def one(span: Column, i: Column) -> Column:
            at = F.coalesce(F.get(ends, i - 1), F.lit(0).cast("long"))
            line = F.concat(piece(blocks, at, span["start"]), F.get(names, span["kind"]))
            return F.when(span["start"] >= at, line).otherwise("")

        rest = piece(blocks, F.get(ends, F.size(ends) - 1), F.length(text).cast("long"))
        return F.concat(F.array_join(F.transform(spans, one), ""), rest)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    changed = let(blocks, lambda blocks: let(ends, lambda ends: replaced(blocks, ends)))
    return docs.withColumn(text_col, F.when(F.size(spans_col) > 0, changed).otherwise(text))
