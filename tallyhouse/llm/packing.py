"""Packing token pieces into sequences by best fit and swap-based local search.

Documents longer than a sequence are cut into whole sequences and a rest. Pieces are dealt by
hash into groups of about `GROUP` documents; a group is packed by best fit, longest first, and
then improved: the emptiest sequence gives pieces to other underfull ones, moving one,
exchanging one for one, or exchanging one for two or two for one. Every step moves
length from an emptier to a fuller sequence and so raises the sum of squared fills; a sequence
that becomes empty is gone. The search ends when no step is left, or when the group needs no more
sequences than its total length demands.

A task holds one group at a time, at most `MOST_PIECES` pieces of a few numbers each, however
many rows reach it; groups are sorted by hash first, so a lost task packs them again alike.

Defined results: a null text is empty and packs as the closing id alone. Rows with a null or
repeated id, and repeated rows, are packed like any others. Only the id and text columns are
read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.tokens import ID_BYTES, document_ids, word_ids
from tallyhouse.session import stage

CAPACITY = 4096
GROUP = 20_000
MOST_PIECES = 50_000
STEPS = 20_000
PASSES = 4
PAIRED = 32
PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def cut(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, path: str | None, ids: bool
) -> DataFrame:
    """Pieces of every document, in order; with their ids as bytes if asked for."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for batch in batches:
            row, piece, start, length, crc, raw = [], [], [], [], [], []
            for nth, text in enumerate(batch.column("text")):
                found = document_ids(text.as_py(), known)
                for at in range(0, len(found), capacity * ID_BYTES):
                    part = found[at : at + capacity * ID_BYTES]
                    row.append(nth)
                    piece.append(at // (capacity * ID_BYTES))
                    start.append(at // ID_BYTES)
                    length.append(len(part) // ID_BYTES)
                    crc.append(zlib.crc32(part))
                    if ids:
                        raw.append(part)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if ids:
                columns["ids"] = pa.array(raw, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = PIECES.format(id=narrow.schema["doc_id"].dataType.simpleString())
    return narrow.mapInArrow(pieces, schema + (", ids binary" if ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices: each piece, longest first, goes to the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for index in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[index])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[where].append(index)
        else:
            room, where = capacity, len(bins)
            bins.append([index])
        room -= length
        if room:
            by_room[room].append(where)
            rooms |= 1 << room
    return bins


def improve(
    bins: list[list[int]], lengths: np.ndarray, capacity: int, steps: int = STEPS
) -> list[list[int]]:
    """Local search: empty the emptiest bins into other underfull ones."""
    fill = [int(lengths[b].sum()) for b in bins]
    needed = ceil(int(lengths.sum()) / capacity)
    for _ in range(PASSES):
        if sum(map(bool, bins)) <= needed:
            break
        changed = False
        underfull = [k for k in range(len(bins)) if 0 < fill[k] < capacity]
        for source in sorted(underfull, key=fill.__getitem__):
            takers = [
                k for k in underfull if k != source and 0 < fill[source] <= fill[k] < capacity
            ]
            while bins[source] and fill[source] < capacity and takers and steps > 0:
                found = step(source, takers, bins, fill, lengths, capacity)
                if found is None:
                    break
                taker, out, back = found
                bins[source] = [x for x in bins[source] if x not in out] + back
                bins[taker] = [x for x in bins[taker] if x not in back] + out
                gain = int(lengths[out].sum() - lengths[back].sum())
                fill[source] -= gain
                fill[taker] += gain
                if fill[taker] == capacity:
                    takers.remove(taker)
                changed = True
                steps -= 1
        if not changed:
            break
    return [b for b in bins if b]


def step(source, takers, bins, fill, lengths, capacity):
    """The move or exchange with the largest gain for a taker: (taker, out, back) or None."""
    room = {k: capacity - fill[k] for k in takers}
    item = np.array([x for k in takers for x in bins[k]])
    owner = np.array([k for k in takers for _ in bins[k]])
    size, free = lengths[item], np.array([room[k] for k in owner])
    # Pairs of the fullest takers only: an exchange of one for two needs little room.
    pairs = [
        (k, x, y)
        for k in sorted(takers, key=room.__getitem__)[:PAIRED]
        for i, x in enumerate(bins[k])
        for y in bins[k][i + 1 :]
    ]
    best, best_gain = None, 0

    def better(gain, make):
        nonlocal best, best_gain
        if gain > best_gain:
            best, best_gain = make(), gain

    own = bins[source]
    for a in own:
        length = int(lengths[a])
        fits = [k for k in takers if room[k] >= length]
        if fits:
            better(length, lambda: (min(fits, key=room.__getitem__), [a], []))
        gains = length - size
        gains[(gains <= 0) | (gains > free)] = 0
        at = int(gains.argmax())
        better(int(gains[at]), lambda: (int(owner[at]), [a], [int(item[at])]))
        for k, x, y in pairs:
            gain = length - int(lengths[x]) - int(lengths[y])
            if 0 < gain <= room[k]:
                better(gain, lambda: (k, [a], [x, y]))
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            gains = int(lengths[a] + lengths[b]) - size
            gains[(gains <= 0) | (gains > free)] = 0
            at = int(gains.argmax())
            better(int(gains[at]), lambda: (int(owner[at]), [a, b], [int(item[at])]))
    return best


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices of the pieces."""
    return improve(best_fit(lengths, capacity), lengths, capacity)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: where it comes from, and its sequence_id and offset there."""
    pieces = stage(cut(docs, id_col, text_col, capacity, path, ids=False), "pieces")
    groups = max(1, ceil(pieces.filter("piece = 0").count() / group))
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    schema += ", sequence_id long, offset long"

    def fill_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal number
            lengths = table.column("length").to_numpy()
            order, sequence, offset = [], [], []
            for members in pack(lengths, capacity):
                places = np.cumsum(lengths[members]) - lengths[members]
                order += members
                sequence += [number] * len(members)
                offset += places.tolist()
                number += 1
            out = table.take(pa.array(order, pa.int64()))
            out = out.append_column("sequence_id", pa.array(sequence, pa.int64()))
            yield from out.append_column("offset", pa.array(offset, pa.int64())).to_batches()

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, MOST_PIECES - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == MOST_PIECES:
                    yield from packed(pa.Table.from_batches(held))
                    held, n = [], 0
        if held:
            yield from packed(pa.Table.from_batches(held))

    key = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    dealt = pieces.repartition(groups, key).sortWithinPartitions(key, *names)
    return dealt.mapInArrow(fill_sequences, schema)


def sequences(
    docs: DataFrame,
    packed: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
) -> DataFrame:
    """sequence_id and its ids as little-endian bytes, from the result of pack_documents."""
    keys = ["doc_id", "piece", "length", "ids_crc32"]
    content = cut(docs, id_col, text_col, capacity, path, ids=True).dropDuplicates(keys)
    same = [packed[k].eqNullSafe(content[k]) for k in keys]
    parts = packed.join(content, same).select("sequence_id", F.struct("offset", "ids").alias("part"))
    # A sequence holds at most `capacity` ids, so its parts fit one row.
    gathered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    nothing = F.lit(b"").cast("binary")
    ids = F.aggregate("parts", nothing, lambda all_, part: F.concat(all_, part["ids"]))
    return gathered.select("sequence_id", ids.alias("ids"))
