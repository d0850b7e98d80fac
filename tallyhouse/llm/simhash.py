"""Near copies by SimHash: fingerprints that differ in few bits, found by a trie self-join.

The fingerprints are read as binary tries. Pairs of nodes are traversed together from the
root, the bits in which their paths differ are added up, and a pair is dropped as soon as they
exceed the error budget. Five tries are joined, each starting with another fifth of the bits:
two fingerprints that differ in at most four bits agree in one fifth, so a trie allows no
difference in its leading fifth, and its node pairs below can be joined in separate tasks.
A pair of nodes with more fingerprints than `NODE_ROWS` is first expanded over the
cluster, four bits at a time. Inside a task the traversal is vectorised: a node is a range of the
sorted fingerprints, and all node pairs of a level are split at once. A task returns a spanning
forest of the links it finds, not the links.

Only distinct fingerprints are joined, so copies cost nothing here however many there are.

Defined results: a null text counts as empty; a text without words has fingerprint zero and
is linked like any other. component_id is the smallest id reachable; a null id never is, unless all
ids of a component are null. Only the id and text columns are read. An empty table gives
an empty result. `drop_near_copies` keeps one row of each component: the one with the smallest
id (null last), then the smallest hash over all columns; rows equal in every column count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.components import components
from tallyhouse.llm.rows import ROW, with_row
from tallyhouse.llm.words import encoded, words_of
from tallyhouse.session import stage

SHINGLE = 4
BUDGET = 4
SEED = 42
# Leading bits of each trie: (first bit, number of bits).
FIFTHS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a node pair that one task takes on.
NODE_ROWS = 1_000_000
#: Rows that a task gathers before it traverses them, a larger node pair aside.
TASK_ROWS = 200_000
STEP = 4
FRONTIER = 1 << 18
LEAF = 256
HASHES = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of one text: a bit is set if over half the shingle hashes have it."""
    words = words_of(encoded(text).lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    lasts = (ends - 1).tolist()[SHINGLE - 1 :] or [len(joined)]
    hash_of = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(lasts), HASHES):
        part = [hash_of(joined[a:b], SEED) for a, b in zip(starts[at:], lasts[at : at + HASHES])]
        bits = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(lasts), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(text) for text in texts], dtype="int64")


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of a[i] and b[i]; label[x] is the smallest member of x's class."""
    while True:
        left, right = label[a], label[b]
        differ = left != right
        if not differ.any():
            return
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def traverse(bits: np.ndarray, pairs: np.ndarray, depth: int, budget: int = BUDGET) -> np.ndarray:
    """Class of every fingerprint after linking those of the node pairs that are close.

    bits: fingerprints sorted within each node; pairs: columns a_from, a_to, b_from, b_to of
    nodes whose paths of `depth` bits lead to these ranges.
    """
    label = np.arange(len(bits))
    zeros: dict[int, np.ndarray] = {}
    stack = [(depth, pairs)]
    while stack:
        level, todo = stack.pop()
        if not len(todo):
            continue
        size = (todo[:, 1] - todo[:, 0]) * (todo[:, 3] - todo[:, 2])
        small = (size <= LEAF) | (level == 64)
        link_leaves(bits, label, todo[small], budget)
        todo = todo[~small]
        if len(todo) > FRONTIER:
            stack += [(level, part) for part in np.array_split(todo, len(todo) // FRONTIER + 1)]
            continue
        if not len(todo):
            continue
        if level not in zeros:
            bit = (bits >> np.uint64(63 - level)) & np.uint64(1)
            zeros[level] = np.concatenate(([0], np.cumsum(bit == 0)))
        before = zeros[level]
        a0, a2, b0, b2 = todo.T
        a1 = a0 + before[a2] - before[a0]
        b1 = b0 + before[b2] - before[b0]
        same = a0 == b0
        children = np.concatenate(
            [
                np.column_stack((a0, a1, b0, b1)),
                np.column_stack((a1, a2, b1, b2)),
                np.column_stack((a0, a1, b1, b2)),
                np.column_stack((a1, a2, b0, b1))[~same],
            ]
        )
        children = children[(children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])]
        paths = bits[children[:, 0]] ^ bits[children[:, 2]]
        errors = np.bitwise_count(paths >> np.uint64(63 - level))
        stack.append((level + 1, children[errors <= budget]))
    return label


def link_leaves(bits: np.ndarray, label: np.ndarray, pairs: np.ndarray, budget: int) -> None:
    """Compare every fingerprint of one node with every one of the other."""
    sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
    ends = np.cumsum(sizes)
    start = 0
    while start < len(pairs):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + (1 << 20), "right")))
        part, count = pairs[start:stop], sizes[start:stop]
        which = np.repeat(np.arange(len(part)), count)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        width = (part[:, 3] - part[:, 2])[which]
        a = part[which, 0] + nth // width
        b = part[which, 2] + nth % width
        near = (a < b) & (np.bitwise_count(bits[a] ^ bits[b]) <= budget)
        unite(label, a[near], b[near])
        start = stop


LINKS = "a long, b long"


def link_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of the node pairs in one partition, sorted by node pair and bits."""
    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        frame = batch.to_pandas()
        held.append(frame)
        n += len(frame)
        if n >= TASK_ROWS:
            frame = pd.concat(held, ignore_index=True)
            last = frame.iloc[-1]
            open_ = (frame[UNIT] == last[UNIT]).all(axis=1)
            yield from link_frame(frame[~open_])
            held = [frame[open_]]
            n = 0
    if held:
        yield from link_frame(pd.concat(held, ignore_index=True))


def link_frame(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
    for (block, depth), part in frame.groupby(["block", "depth"], sort=False):
        bits = part["bits"].to_numpy(np.int64).view(np.uint64)
        paths = part[["node_a", "node_b"]].to_numpy(np.int64).view(np.uint64)
        new = (paths[1:] != paths[:-1]).any(axis=1)
        starts = np.concatenate(([0], np.flatnonzero(new) + 1))
        stops = np.concatenate((starts[1:], [len(bits)]))
        second = (bits >> np.uint64(64 - depth)) != paths[:, 0]
        before = np.concatenate(([0], np.cumsum(~second)))
        middle = starts + before[stops] - before[starts]
        own = paths[starts, 0] == paths[starts, 1]
        pairs = np.column_stack(
            (starts, np.where(own, stops, middle), np.where(own, starts, middle), stops)
        )
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
        label = traverse(bits, pairs, int(depth))
        moved = np.flatnonzero(label != np.arange(len(label)))
        if len(moved):
            first = FIFTHS[int(block)][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(turned_back(bits[rows], first)) for rows in (moved, label[moved])],
                names=["a", "b"],
            )


def turned_back(bits: np.ndarray, first: int) -> np.ndarray:
    if first:
        bits = (bits >> np.uint64(first)) | (bits << np.uint64(64 - first))
    return bits.view(np.int64)


UNIT = ["block", "depth", "node_a", "node_b"]


def turned(fp: Column, first: int) -> Column:
    """Bits of fp from bit `first` on, then those before it."""
    if not first:
        return fp
    return F.shiftleft(fp, first).bitwiseOR(F.shiftrightunsigned(fp, 64 - first))


def roots(distinct: DataFrame) -> DataFrame:
    """Each fingerprint once in each of the five tries, at the node of its leading fifth."""
    tries = []
    for block, (first, width) in enumerate(FIFTHS):
        bits = turned(F.col("fp"), first)
        node = F.shiftrightunsigned(bits, 64 - width)
        tries.append(
            F.struct(
                F.lit(block).alias("block"),
                F.lit(width).alias("depth"),
                node.alias("node_a"),
                node.alias("node_b"),
                bits.alias("bits"),
            )
        )
    return distinct.select(F.explode(F.array(*tries)).alias("trie")).select("trie.*")


def expanded(rows: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Rows of node pairs, moved to the pairs of their nodes STEP bits further down.

    Pairs beyond the budget, and pairs one side of which has no rows, are dropped.
    """
    deeper = F.col("depth") + STEP
    node = F.expr(f"shiftrightunsigned(bits, 64 - depth - {STEP})")
    other = F.when(
        F.shiftright(node, STEP) == F.col("node_a"), F.col("node_b")
    ).otherwise(F.col("node_a"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit((1 << STEP) - 1)),
        lambda nibble: F.struct(
            F.least(node, F.shiftleft(other, STEP) + nibble).alias("node_a"),
            F.greatest(node, F.shiftleft(other, STEP) + nibble).alias("node_b"),
        ),
    )
    near = F.filter(
        pairs, lambda p: F.bit_count(p["node_a"].bitwiseXOR(p["node_b"])) <= budget
    )
    moved = rows.select("block", deeper.alias("deeper"), F.explode(near).alias("pair"), "bits")
    moved = moved.select(
        "block", F.col("deeper").alias("depth"), "pair.node_a", "pair.node_b", "bits"
    )
    path = F.expr("shiftrightunsigned(bits, 64 - depth)")
    sides = moved.groupBy(*UNIT).agg(
        F.count_if(path == F.col("node_a")).alias("n_a"), F.count_if(path == F.col("node_b")).alias("n_b")
    )
    alive = sides.filter("n_a > 0 AND n_b > 0 AND (node_a <> node_b OR n_a > 1)")
    return moved.join(alive.select(*UNIT), UNIT, "left_semi")


def links(distinct: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Spanning links (a, b) of the graph that joins fingerprints differing in at most BUDGET bits."""
    rows = roots(distinct)
    ready = None
    while True:
        full = rows.groupBy(*UNIT).count().filter((F.col("count") > node_rows) & (F.col("depth") < 60))
        full = stage(full.drop("count"), "full-nodes")
        if full.isEmpty():
            break
        fit = rows.join(full, UNIT, "left_anti")
        ready = fit if ready is None else ready.union(fit)
        rows = stage(expanded(rows.join(full, UNIT, "left_semi")), "node-pairs")
    ready = rows if ready is None else ready.union(rows)
    unsigned = F.col("bits").bitwiseXOR(F.lit(-(2**63)))
    dealt = ready.repartition(*UNIT).sortWithinPartitions(*UNIT, unsigned)
    return dealt.mapInArrow(link_units, LINKS).distinct()


def classes(rows: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """fp, root for every distinct fp of rows: root names its component."""
    distinct = stage(rows.select("fp").distinct(), "fingerprints")
    found = components(links(distinct, node_rows))
    return distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", node_rows: int = NODE_ROWS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = stage(
        docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")), "simhash"
    )
    smallest = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    root = classes(rows, node_rows)
    of_fp = root.join(smallest, "fp").select("fp", "root", "doc_id")
    of_root = of_fp.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = of_fp.join(of_root, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", node_rows: int = NODE_ROWS
) -> DataFrame:
    """One row of docs for each component, unchanged."""
    hashed = with_row(docs)
    rows = hashed.select(F.col(id_col).alias("doc_id"), *ROW, fingerprints(F.col(text_col)).alias("fp"))
    rows = stage(rows, "simhash")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *ROW)
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    kept = classes(rows, node_rows).join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(*(F.col(f"first.{name}").alias(name) for name in ROW))
    return hashed.join(kept, ROW, "left_semi").dropDuplicates(ROW).select(*docs.columns)
