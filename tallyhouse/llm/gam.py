"""Text quality by a generalised additive model with pairwise interactions.

A score is the sum of one lookup table per feature and of small two-feature tables, through the
logistic function. Learning is cyclic boosting: feature after feature, round after round, a shallow
tree over the feature's bins is fitted to the gradient and added to its table at a small
rate, so no feature takes another's effect. Pairs are then ranked by how much one tree over both
lowers the remaining loss, and the best are boosted in the same way. Scoring is a vectorised
binning of each feature and additions.

Features describe the form of a text only. The model is learnt on at most about `rows` labelled
texts, chosen by hash; their features, a few numbers each, are collected.

Defined results: a null text counts as empty and gets the score of an empty text. A null id is
not held out. Labels other than 0 and 1 and labels without a document are not learnt from; several
labels of a document all are. Without both labels the score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.rules import measure
from tallyhouse.llm.words import encoded, words_of

FEATURES = [
    "log_words",
    "word_length",
    "symbols",
    "duplicate_lines",
    "repeated_words",
    "stutters",
    "capitals",
    "distinct_words",
    "digits",
    "stops",
    "marks",
    "line_words",
    "commonest_word",
    "entropy",
    "beyond_ascii",
]
ROWS = 20_000
BINS = 64
PAIR_BINS = 12
ROUNDS = 150
PAIRS = 8
PAIR_ROUNDS = 40
RATE = 0.1
SMOOTH = 1.0
DIGITS = b"0123456789"
STOPS = b".?"
MARKS = b"!,;:\"'()[]{}"
ASCII = bytes(range(128))


def features(text: str | None) -> list[float]:
    raw = encoded(text)
    n, chars, symbols, lines, dup_lines, repeated, stutters, letters, capitals = measure(text)
    words, size = max(n, 1), max(len(raw), 1)
    times = Counter(words_of(raw))
    used = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=1) / size
    used = used[used > 0]

    def count(of: bytes) -> int:
        return len(raw) - len(raw.translate(None, of))

    return [
        float(np.log1p(n)),
        chars / words,
        symbols / words,
        dup_lines / max(lines, 1),
        repeated / words,
        stutters / words,
        capitals / max(letters, 1),
        len(times) / words,
        count(DIGITS) / size,
        count(STOPS) / words,
        count(MARKS) / words,
        n / max(lines, 1),
        max(times.values(), default=0) / words,
        float(-(used * np.log2(used)).sum()),
        1 - count(ASCII) / size,
    ]


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    #: Bin of a feature to its coarser bin in the pair tables.
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.intercept)
        bins = self.bins(x)
        for table, own in zip(self.tables, bins):
            margin += table[own]
        for (a, b), table in self.pairs.items():
            margin += table[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-margin))


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Largest gain of cutting the bins in two, and the first bin of the upper part."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h, all_g, all_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1], g.sum(), h.sum()
    gains = (
        left_g**2 / (left_h + SMOOTH)
        + (all_g - left_g) ** 2 / (all_h - left_h + SMOOTH)
        - all_g**2 / (all_h + SMOOTH)
    )
    at = int(gains.argmax())
    return max(float(gains[at]), 0.0), at + 1


def leaves(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Value for each bin of a shallow tree over the bins of one feature."""
    gain, at = best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + SMOOTH))
    return np.concatenate((leaves(g[:at], h[:at], depth - 1), leaves(g[at:], h[at:], depth - 1)))


def pair_leaves(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree that cuts one feature, then the other on either side; and its gain."""
    best = (np.full(g.shape, g.sum() / (h.sum() + SMOOTH)), 0.0)
    whole = g.sum() ** 2 / (h.sum() + SMOOTH)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(gg)):
            parts, gain = [], -whole
            for part_g, part_h in ((gg[:at], hh[:at]), (gg[at:], hh[at:])):
                row_g, row_h = part_g.sum(axis=0), part_h.sum(axis=0)
                more, cut = best_cut(row_g, row_h)
                gain += row_g.sum() ** 2 / (row_h.sum() + SMOOTH) + more
                values = np.empty(len(row_g))
                for side in (slice(0, cut), slice(cut, None)):
                    values[side] = row_g[side].sum() / (row_h[side].sum() + SMOOTH)
                parts.append(np.tile(values, (len(part_g), 1)))
            if gain > best[1]:
                table = np.concatenate(parts)
                best = (table.T if turned else table, gain)
    return best


def fit_arrays(x: np.ndarray, y: np.ndarray) -> Model:
    """Model from features and labels 0 and 1."""
    model = Model()
    if not len(y) or y.min() == y.max():
        return model
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(column, steps)) for column in x.T]
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    model.coarse = []
    for own, n in zip(bins, sizes):
        rank = np.cumsum(np.bincount(own, minlength=n)) - np.bincount(own, minlength=n)
        model.coarse.append(np.unique(rank * PAIR_BINS // len(y), return_inverse=True)[1])
    model.intercept = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, own in zip(model.tables, bins):
            g, h = slopes()
            step = RATE * leaves(
                np.bincount(own, g, len(table)), np.bincount(own, h, len(table))
            )
            table += step
            margin += step[own]
    coarse = [c[own] for c, own in zip(model.coarse, bins)]
    widths = [int(c.max()) + 1 for c in model.coarse]

    def pair_tree(a: int, b: int) -> tuple[np.ndarray, float]:
        g, h = slopes()
        cell = coarse[a] * widths[b] + coarse[b]
        shape = (widths[a], widths[b])
        cells = widths[a] * widths[b]
        return pair_leaves(
            np.bincount(cell, g, cells).reshape(shape), np.bincount(cell, h, cells).reshape(shape)
        )

    ranked = sorted(
        combinations(range(x.shape[1]), 2), key=lambda pair: -pair_tree(*pair)[1]
    )
    model.pairs = {(a, b): np.zeros((widths[a], widths[b])) for a, b in ranked[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in model.pairs.items():
            step = RATE * pair_tree(a, b)[0]
            table += step
            margin += step[coarse[a], coarse[b]]
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = ROWS,
) -> Model:
    """Model learnt from docs and their labels (id_col, label_col); at most about `rows` are used."""
    known = labels.select(
        F.col(id_col).alias("labelled"), F.col(label_col).cast("int").alias("label")
    ).filter("labelled IS NOT NULL AND label IN (0, 1)")
    n = known.count()
    uniform = F.pmod(F.xxhash64("labelled"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    sample = known.filter(uniform < min(1.0, rows / max(n, 1)))

    @F.pandas_udf("array<double>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(text) for text in texts])

    texts = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).alias("text"))
    # The sample is ids and labels of about `rows` rows.
    joined = texts.join(F.broadcast(sample), "labelled")
    found = joined.select("labelled", "label", described("text").alias("x")).toPandas()
    found = found.sort_values(["labelled", "label"], kind="stable")
    x = np.array(found["x"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    return fit_arrays(x, found["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(text) for text in texts], dtype=float)
            yield pd.Series(model.scores(x.reshape(len(texts), len(FEATURES))))

    return docs.select(F.col(id_col).alias("doc_id"), scored(F.col(text_col)).alias("score"))
