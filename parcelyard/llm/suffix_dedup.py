"""Removal of repeated passages by suffix arrays (operator 3).

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another.

Suffixes are sorted by linear grouping construction. Phase one puts each suffix into the group of its Lyndon prefix:
groups start as the first symbols and are processed in descending order; every member of a group hands its context to
the nearest smaller suffix before it (a previous-smaller pointer that skips what has been processed), which moves to a
new group just above its own, by how many members it got. Phase two emits each group's order: going up through
the sorted suffixes, the suffix before one, and along the previous-smaller pointers from there, takes the next free
place of its group. No suffix is renamed or sorted again.

So that equal strings meet without sorting the corpus in one place, a start belongs to the anchor of its string: of
the pieces of ``ANCHOR`` bytes in it the one whose hash is least (the first of equal ones), which depends on the string
alone. Consecutive starts of one anchor are a run; the run's context is all bytes its strings cover. Only runs whose
anchor occurs again go further, dealt by anchor hash. A context that occurs again as a whole is repeated wholly,
whatever its number, and is kept once. Strings of the different contexts of an anchor meet in cells by how far they reach
before it; the parts in which those of a cell can differ are joined to one text, whose suffix array puts equal strings
side by side. Where different contexts of an anchor exceed ``GROUP_BYTES``, its cells are dealt to tasks instead and each is
sorted alone; where the pieces of a cell still do, its strings are dealt by their hash: the exact way for hot passages.

Hashes have 64 bits, strings dealt by their own hash are compared by 128. Defined cases: NULL text is empty; texts
below ``length`` bytes lose nothing; repeated rows and ids are texts of their own, so copies remove each other.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import discard, keep

LENGTH = 400
ANCHOR = 64
CELLS = 16
MIDDLE = 257  # symbol of the part that all strings of a cell have, after those of bytes
GROUP_BYTES = 1 << 16
BATCH_ROWS = 8192
_MIX = np.uint64(0xFF51AFD7ED558CCD)  # fixed value: a mixing constant
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def suffix_array(text) -> list[int]:
    """Start positions of the suffixes of a sequence of small non-negative integers, sorted. Linear time."""
    n = len(text)
    if not n:
        return []
    members: list[list[int]] = []
    above, below, group = [], [], [0] * n
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    for g, symbol in enumerate(sorted(by_symbol)):
        members.append(by_symbol[symbol])
        for i in by_symbol[symbol]:
            group[i] = g
        above.append(g + 1)
        below.append(g - 1)
    top = len(members) - 1
    above[top] = -1
    smaller = list(range(-1, n - 1))  # nearest position before that isn't processed, found by path halving
    done = [False] * n
    pointer, descending = [-1] * n, []
    while top >= 0:
        now = [i for i in members[top] if group[i] == top]
        descending.append(now)
        for i in now:
            done[i] = True
        handed: dict[int, int] = {}
        for i in now:
            p = smaller[i]
            while p >= 0 and done[p]:
                q = smaller[p]
                smaller[i] = q
                p = q
            pointer[i] = p
            if p >= 0:
                handed[p] = handed.get(p, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for p, count in handed.items():
            split.setdefault((group[p], count), []).append(p)
        for lower, count in sorted(split, key=lambda k: -k[1]):
            # The highest count is placed first, so that lower counts come between it and the rest.
            new, higher = len(members), above[lower]
            members.append(split[lower, count])
            above.append(higher)
            below.append(lower)
            above[lower] = new
            if higher >= 0:
                below[higher] = new
            for p in split[lower, count]:
                group[p] = new
        top = below[top]
    # Phase two: first free place of each group, in ascending order of groups.
    place, free, number = [0] * n, [], 0
    for rank, now in enumerate(reversed(descending)):
        free.append(number)
        number += len(now)
        for i in now:
            place[i] = rank
    order, placed = [-1] * n, [False] * n

    def chain(j: int) -> None:
        while j >= 0 and not placed[j]:
            placed[j] = True
            order[free[place[j]]] = j
            free[place[j]] += 1
            j = pointer[j]

    chain(n - 1)
    for k in range(n):
        if order[k] > 0:
            chain(order[k] - 1)
    return order


def repeated_starts(contexts: list[list[int]], length: int) -> list[np.ndarray]:
    """Per context, a sequence of positive integers, which of its strings of ``length`` symbols occur again in these contexts."""
    joined, starts = [], []
    for c in contexts:
        starts.append(len(joined))
        joined += c
        joined.append(0)
    counts = [max(0, len(c) - length + 1) for c in contexts]
    valid, again, last = bytearray(len(joined)), bytearray(len(joined)), -1
    for start, count in zip(starts, counts):
        valid[start : start + count] = b"\1" * count
    for i in suffix_array(joined):
        if valid[i]:
            if last >= 0 and joined[i : i + length] == joined[last : last + length]:
                again[i] = again[last] = 1
            last = i
    return [np.frombuffer(again, bool, count, start) for start, count in zip(starts, counts)]


def anchor_places(contexts: list[bytes], length: int, size: int) -> list[int]:
    """Where the anchor of each context is, from the hashes of all of them at once."""
    hashes, start, out = gram_hashes(np.frombuffer(b"".join(contexts), np.uint8), size) & _HIGH, 0, []
    for c in contexts:
        out.append(int(np.argmin(hashes[start : start + min(len(c), length) - size + 1])))
        start += len(c)
    return out


def cells_of(context: bytes, at: int, length: int) -> Iterator[tuple[int, bytes, int, int, bytes, bytes]]:
    """Cells of a context with its anchor at ``at``: number, middle part, first and last start, what is before and after it."""
    around = length - min(ANCHOR, length)
    step, starts = max(1, around // CELLS), len(context) - length + 1
    for j in range((at - starts + 1) // step, at // step + 1):
        low, high = j * step, min((j + 1) * step - 1, around)
        first, last, core, end = max(0, at - high), min(starts - 1, at - low), at - low, at + length - high
        yield j, context[core:end], first, last, context[first:core], context[end : last + length]


def repeated_pieces(pieces: list[tuple[bytes, bytes]], length: int) -> list[np.ndarray]:
    """As ``repeated_starts``, for the pieces of a cell; equal ones are repeated and sorted once."""
    times = Counter(pieces)
    found = {piece: np.ones(len(piece[0]) + len(piece[1]) + 2 - length, bool) for piece in times}
    if len(times) > 1:
        texts = [[*(b + 1 for b in head), MIDDLE, *(b + 1 for b in tail)] for head, tail in times]
        for (piece, n), again in zip(times.items(), repeated_starts(texts, length)):
            if n == 1:
                found[piece] = again
    return [found[piece] for piece in pieces]


def repeated_around(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """As ``repeated_starts``, for contexts of one anchor.

    Equal strings reach equally far before the anchor, so a string meets only those of its cell: strings that reach about
    as far have a middle part in common, which is the key of the cell and one symbol in its suffix array. What a context
    has before and after that part is its piece.
    """
    out = [np.zeros(max(0, len(c) - length + 1), bool) for c in contexts]
    cells: dict[tuple[int, bytes], list[tuple]] = {}
    for k, (c, at) in enumerate(zip(contexts, anchor_places(contexts, length, min(ANCHOR, length)))):
        for j, middle, first, last, head, tail in cells_of(c, at, length):
            cells.setdefault((j, middle), []).append((k, first, last, (head, tail)))
    for (_, middle), found in cells.items():
        if len(found) > 1:
            for (k, first, last, _), again in zip(found, repeated_pieces([f[3] for f in found], length - len(middle) + 1)):
                out[k][first : last + 1] = again
    return out


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` consecutive bytes, by doubling."""
    level = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    out, covered, width = None, 0, 1
    while True:
        if size & width:
            if out is None:
                out = level
            else:
                n = min(len(out), len(level) - covered)
                out = (out[:n] * _MIX) ^ (level[covered : covered + n] + (out[:n] >> np.uint64(31)))
            covered += width
        if covered == size:
            return out[: len(data) - size + 1] * _MIX ^ (out[: len(data) - size + 1] >> np.uint64(29))
        n = len(level) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        level = (level[:n] * _MIX) ^ (level[width : width + n] + (level[:n] >> np.uint64(33)))
        width *= 2


def runs(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts with one anchor: first start, last start, and the anchor's hash. ``data`` has ``length`` bytes or more."""
    size = min(ANCHOR, length)
    hashes = gram_hashes(np.frombuffer(data, np.uint8), size)
    starts, width, have = len(data) - length + 1, length - size + 1, 1
    # The upper half of the hash, then the place: of equal ones, the first is the least.
    least = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:starts], least[width - have : width - have + starts])
    places = (least & _LOW).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
    last = np.concatenate([first[1:] - 1, [starts - 1]])
    return first, last, hashes[places[first]].view(np.int64)


def _halves(data: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [f for f, _ in fields])


def _batched(rows_of, schema: str):
    """A function of batches from one that yields lists of rows, which are put together to batches of some size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in rows_of(batches):
            out += rows
            if len(out) >= BATCH_ROWS:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal values in the first ``keys`` columns, from batches sorted by these; a group may span batches."""
    found: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if found and row[:keys] != found[0][:keys]:
                yield found
                found = []
            found.append(row)
    if found:
        yield found


def _spans(again: np.ndarray, first: int) -> list[tuple[int, int]]:
    """First and last of each run of marks, counted from ``first``."""
    edges = np.flatnonzero(np.diff(again.astype(np.int8), prepend=0, append=0)) + first
    return [(int(i), int(j) - 1) for i, j in edges.reshape(-1, 2)]


def find_runs(texts: DataFrame, length: int) -> DataFrame:
    """Runs of ``texts`` (row, text) with the identity of their contexts; the context itself comes later."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests = [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode()
                if len(data) < length:
                    continue
                first, last, anchor = runs(data, length)
                rows.append((np.full(len(first), row), first, last, anchor))
                digests += [hashlib.blake2b(data[f : t + length], digest_size=16).digest() for f, t in zip(first.tolist(), last.tolist())]
            if rows:
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [np.concatenate(c) for c in zip(*rows)] + [halves[:, 0], halves[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in SHORT.split(", ")])

    return texts.select("row", "text").mapInArrow(cut, SHORT)


SHORT = "row long, first long, last long, anchor long, c1 long, c2 long"


def repeats(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeated starts of ``texts`` (row, text), a stored table: row, first, last."""
    every = keep(find_runs(texts, length), "runs")
    # Stored, so that the join reads it as a side of its own and a hot anchor's rows can be split.
    again = keep(every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "repeated-anchors")
    found = keep(every.join(again, "anchor", "left_semi"), "shared-runs")
    discard(every)
    counted = keep(
        found.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("copies"), F.min(F.struct("row", "first", "last")).alias("at")),
        "contexts",
    )
    whole = found.join(counted.filter("copies > 1").select("c1", "c2"), ["c1", "c2"], "left_semi").select("row", "first", "last")
    # Anchors with different contexts, one occurrence of each; only those need sorting.
    size = F.col("at.last") - F.col("at.first") + length
    several = keep(counted.groupBy("anchor").agg(F.count("*").alias("c"), F.sum(size).alias("bytes")).filter("c > 1"), "anchors")
    chosen = keep(counted.join(several, "anchor").select("anchor", "copies", "bytes", "at.*"), "chosen")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, text, places in zip(*(column.to_pylist() for column in batch.columns)):
                data = (text or "").encode()
                for p in places:
                    rows.append((row, p["first"], p["anchor"], p["copies"], p["bytes"], data[p["first"] : p["last"] + length]))
            yield _batch(rows, TAKEN)

    places = chosen.groupBy("row").agg(F.collect_list(F.struct("first", "last", "anchor", "copies", "bytes")).alias("places"))
    taken = keep(texts.select("row", "text").join(places, "row").mapInArrow(take, TAKEN), "taken")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for rows in _groups(batches, 1):
            again = repeated_around([r[-1] for r in rows], length)
            yield [(row, *span) for (_, row, first, copies, _), a in zip(rows, again) if copies == 1 for span in _spans(a, first)]

    small = taken.filter(F.col("bytes") <= GROUP_BYTES).select("anchor", "row", "first", "copies", "context")
    sorted_out = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_batched(sort, SPANS), SPANS)
    return whole.unionByName(sorted_out).unionByName(repeated_cells(taken.filter(F.col("bytes") > GROUP_BYTES), length))


def repeated_cells(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated starts of contexts whose anchors have too many for one task: the cells are dealt instead.

    Strings of a cell that is still too large are dealt one by one.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            rows, out = list(zip(*(c.to_pylist() for c in batch.columns))), []
            for (row, start, copies, context), at in zip(rows, anchor_places([r[-1] for r in rows], length, min(ANCHOR, length))):
                for j, middle, first, _, head, tail in cells_of(context, at, length):
                    name = _halves(j.to_bytes(8, "little") + middle)
                    out.append((*name, row, start + first, copies, length - len(middle) + 1, head, tail))
            yield out

    dealt = keep(contexts.select("row", "first", "copies", "context").mapInArrow(_batched(deal, DEALT), DEALT), "cells")
    size = F.sum(F.octet_length("head") + F.octet_length("tail") + 2)
    shared = keep(dealt.groupBy("c1", "c2").agg(F.count("*").alias("n"), size.alias("bytes")).filter("n > 1").drop("n"), "shared-cells")
    met = dealt.join(shared, ["c1", "c2"]).select(*dealt.columns, "bytes")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for rows in _groups(batches, 2):
            again = repeated_pieces([r[6:8] for r in rows], rows[0][5])
            yield [(r[2], *span) for r, a in zip(rows, again) if r[4] == 1 for span in _spans(a, r[3])]

    small = met.filter(F.col("bytes") <= GROUP_BYTES).repartition("c1", "c2").sortWithinPartitions("c1", "c2")
    sorted_out = small.mapInArrow(_batched(sort, SPANS), SPANS)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            for c1, c2, row, first, copies, count, head, tail, _ in zip(*(c.to_pylist() for c in batch.columns)):
                cell, out = c1.to_bytes(8, "little", signed=True) + c2.to_bytes(8, "little", signed=True), []
                for i in range(len(head) + len(tail) + 2 - count):
                    before = len(head) - i
                    string = cell + before.to_bytes(8, "little") + head[i:] + tail[: count - 1 - before]
                    out.append((row, first + i, copies, *_halves(string)))
                yield out

    spelt = keep(met.filter(F.col("bytes") > GROUP_BYTES).mapInArrow(_batched(spell, SPELT), SPELT), "strings")
    twice = spelt.groupBy("s1", "s2").agg(F.count("*").alias("c")).filter("c > 1").select("s1", "s2")
    hot = spelt.filter("copies = 1").join(twice, ["s1", "s2"], "left_semi").select("row", F.col("at").alias("first"), F.col("at").alias("last"))
    return sorted_out.unionByName(hot)


SPANS = "row long, first long, last long"
DEALT = "c1 long, c2 long, row long, first long, copies long, count long, head binary, tail binary"
TAKEN = "row long, first long, anchor long, copies long, bytes long, context binary"
SPELT = "row long, at long, copies long, s1 long, s2 long"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = keep(docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.monotonically_increasing_id()), "texts")
    spans = repeats(texts, length).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(column.to_pylist() for column in batch.columns)):
                data, kept, end, removed, count = (text or "").encode(), [], 0, 0, 0
                for first, last in sorted((s["first"], s["last"] + length) for s in found or []):
                    if first > end or not count:
                        kept.append(data[end:first])
                        count, removed, end = count + 1, removed + last - first, last
                    elif last > end:
                        removed, end = removed + last - end, last
                kept.append(data[end:])
                rows.append((doc_id, len(data), removed, count, hashlib.sha256(b"".join(kept)).hexdigest()))
            yield _batch(rows, DIGESTS)

    return texts.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(digest, DIGESTS)
