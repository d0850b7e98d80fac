"""Periodic runs of a text's words, and the text with every run cut down to its first period.

A run is a stretch of words with smallest period q and at least `least_exponent` periods that no
neighbouring word extends. The suffix automaton of the words has one state per set of end
positions. Words are then appended one by one: the path from a prefix's state to the root holds all
its suffixes, and link-cut access recolours that path with the new end. Each segment of equal
colour it meets says where the suffixes up to the segment's length ended last. A segment whose length reaches the
distance between that end and the new one is a square; it stands in a run that starts a distance and a length
before the new end, so the squares of one run agree on start and period and the last one ends it.
Periods that are multiples of a run's never show, as its suffixes ended later.

The automaton is built only over stretches that can hold a run. All of a run but its first period and
WIDTH - 1 words ends a WIDTH-word gram seen before in the text, no farther back than the period, and that
part is long enough to bound the period: see `stretches`. Prose that repeats nothing costs one sort of its grams.

Work grows as n log n in the words of such a stretch, memory as n; whole texts are read. One text is one
task's work, texts are independent and none is shuffled.

Defined results: a null text or one without words has no runs and is cut down to the empty text.
Ids play no part, so null or repeated ids and repeated rows are treated alike. Columns of the input stay;
one named like an output column is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import encoded, words_of

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
#: Words of the grams that tell where runs can be.
WIDTH = 5
MIX = np.uint64(0x9E3779B97F4A7C15)

#: start, length and period, in words.
Run = tuple[int, int, int]


def automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: link and longest length of every state, and the state of every prefix."""
    edges: list[dict[int, int]] = [{}]
    link, longest, prefixes = [-1], [0], []
    last = 0
    for code in codes:
        new = len(longest)
        longest.append(longest[last] + 1)
        edges.append({})
        link.append(0)
        at = last
        while at >= 0 and code not in edges[at]:
            edges[at][code] = new
            at = link[at]
        if at >= 0:
            old = edges[at][code]
            if longest[old] != longest[at] + 1:
                copy = len(longest)
                longest.append(longest[at] + 1)
                edges.append(edges[old].copy())
                link.append(link[old])
                link[old] = copy
                while at >= 0 and edges[at].get(code) == old:
                    edges[at][code] = copy
                    at = link[at]
                old = copy
            link[new] = old
        last = new
        prefixes.append(new)
    return link, longest, prefixes


class Paths:
    """Link-cut tree over fixed links: nodes last reached by the same access form one coloured path.

    A path is a splay tree ordered by depth; its root carries the colour and the node above the path.
    """

    def __init__(self, link: list[int]):
        n = len(link)
        self.above = list(link)
        self.up = [-1] * n
        self.left = [-1] * n
        self.right = [-1] * n
        self.colour = [-1] * n

    def rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            up[inner] = p
        up[p] = x
        up[x] = g
        if g < 0:
            self.above[x] = self.above[p]
            self.colour[x] = self.colour[p]
        elif left[g] == p:
            left[g] = x
        else:
            right[g] = x

    def splay(self, x: int) -> None:
        up, left = self.up, self.left
        while (p := up[x]) >= 0:
            g = up[p]
            if g >= 0:
                self.rotate(p if (left[g] == p) == (left[p] == x) else x)
            self.rotate(x)

    def access(self, node: int, colour: int) -> Iterator[tuple[int, int]]:
        """(deepest node, colour) of each segment from node to the root, which all get the new colour."""
        below, x = -1, node
        while x >= 0:
            if self.up[x] >= 0:
                self.splay(x)
            cut = self.right[x]
            if cut >= 0:
                self.up[cut] = -1
                self.above[cut] = x
                self.colour[cut] = self.colour[x]
            self.right[x] = below
            if below >= 0:
                self.up[below] = x
            if self.colour[x] >= 0:
                yield x, self.colour[x]
            below, x = x, self.above[x]
        self.splay(node)
        self.colour[node] = colour


def runs_of(codes: list[int], least_length: int, least_exponent: int) -> list[Run]:
    """All runs of a sequence with that length and number of periods (two at least), by end."""
    link, longest, prefixes = automaton(codes)
    paths = Paths(link)
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefixes):
        for node, before in paths.access(state, i):
            period = i - before
            length = longest[node] + period
            if length >= least_exponent * period and length >= least_length and length >= 2 * period:
                ends[i - length + 1, period] = i
    return [(start, end - start + 1, period) for (start, period), end in ends.items()]


def spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of each stretch of consecutive positions."""
    breaks = np.flatnonzero(np.diff(marks) != 1)
    return marks[np.append(0, breaks + 1)], marks[np.append(breaks, len(marks) - 1)]


def stretches(codes: np.ndarray, least_length: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """(first, mark, last): every run that ends from mark to last starts at first or later.

    In a run of period q and length l, from word q + WIDTH - 1 on, every word ends a gram that also ended q words
    before: at least (least_exponent - 1) * q - WIDTH + 1 marked words in a row. So a stretch of m
    marked words ends only runs of period (m + WIDTH - 1) / (least_exponent - 1) at most, and marks whose gram was last seen farther back
    belong to none. Grams are compared by hash: a collision marks too much, never too little.
    """
    n = len(codes)
    if n <= WIDTH:
        return []
    mixed = np.zeros(n - WIDTH + 1, dtype=np.uint64)
    for i in range(WIDTH):
        mixed = (mixed + codes[i : n - WIDTH + 1 + i]) * MIX
        mixed ^= mixed >> np.uint64(31)
    order = np.argsort(mixed, kind="stable")
    ordered = mixed[order]
    again = np.flatnonzero(ordered[1:] == ordered[:-1])
    if not len(again):
        return []
    back = np.zeros(n, dtype=np.int64)
    back[order[again + 1] + WIDTH - 1] = order[again + 1] - order[again]
    marks = np.flatnonzero(back)
    most = np.zeros(0, dtype=np.int64)
    for _ in range(3):
        if not len(marks):
            return []
        first, last = spans(marks)
        most = (last - first + WIDTH) // (least_exponent - 1)
        near = back[marks] <= np.repeat(most, last - first + 1)
        if near.all():
            break
        marks = marks[near]
    else:
        if not len(marks):
            return []
        first, last = spans(marks)
        most = (last - first + WIDTH) // (least_exponent - 1)
    begin = np.maximum(0, first - most - WIDTH + 1)
    return list(zip(begin.tolist(), first.tolist(), last.tolist()))


def word_runs(words: list[bytes], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[Run]:
    """All runs of a text's words, by start and period."""
    if len(words) < least_length:
        return []
    codes = {word: i for i, word in enumerate(dict.fromkeys(words))}
    if any(max(least_length, least_exponent * q) - q < WIDTH for q in range(1, WIDTH + 1)):
        # Some run is too short to hold a gram seen before.
        return sorted(runs_of([codes[word] for word in words], least_length, least_exponent), key=by_start)
    numbers = np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=len(words))
    found = []
    for begin, mark, end in stretches(numbers, least_length, least_exponent):
        for start, length, period in runs_of(numbers[begin : end + 1].tolist(), least_length, least_exponent):
            if begin + start + length > mark:
                found.append((begin + start, length, period))
    return sorted(found, key=by_start)


def by_start(run: Run) -> tuple[int, int]:
    return run[0], run[2]


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside runs, and the first period of each run unless another run drops it."""
    if not runs:
        return words
    drops = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drops[start + period] += 1
        drops[start + length] -= 1
    kept = np.cumsum(drops[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


def triples_of(numbers: Column) -> Column:
    """Array of (start, length, period) from one array of numbers."""
    names = ("start", "length", "period")
    firsts = F.filter(F.sequence(F.lit(0), F.size(numbers)), lambda i: (i % 3 == 0) & (i < F.size(numbers)))
    return F.transform(
        firsts, lambda i: F.struct(*(F.get(numbers, i + k).alias(name) for k, name in enumerate(names)))
    )


def find_runs(
    docs: DataFrame,
    text_col: str = "text",
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """docs with runs_col, array of (start, length, period) by start and period, and collapsed_col, the
    words that no run drops, joined by one space.

    least_exponent is 2 at least.
    """
    if least_exponent < 2:
        raise ValueError("a run has two periods at least")
    find = partial(word_runs, least_length=least_length, least_exponent=least_exponent)

    @F.pandas_udf("numbers array<long>, collapsed string")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            numbers, collapsed = [], []
            for text in texts:
                words = words_of(encoded(text))
                runs = find(words)
                numbers.append([number for run in runs for number in run])
                collapsed.append(b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"numbers": numbers, "collapsed": collapsed})

    names = [name for name in docs.columns if name not in (runs_col, collapsed_col)]
    work = "_" * (1 + max(map(len, docs.columns))) + "found"
    found = docs.withColumn(work, search(F.col(text_col)))
    numbers = F.col(f"{work}.numbers")
    return found.select(
        *(F.col(f"`{name}`") for name in names),
        triples_of(numbers).alias(runs_col),
        F.col(f"{work}.collapsed").alias(collapsed_col),
    )
