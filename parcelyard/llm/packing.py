"""Bulk-synchronous best-fit packing of token sequences (operator 7).

Documents become pieces of at most ``capacity`` tokens: longer ones are cut into full pieces, and what
remains is the first, shorter piece. Pieces are range-sorted by length over the cluster, so a piece's rank among
equals is its global position less the shorter pieces. Open sequences (gaps) are kept sorted by room, equal
ones as runs of consecutive sequence numbers.

In a round, lengths are taken from the longest down; each asks for its successor, the least room that
holds it. Pieces of equal length compete for the gaps of that room, and their rank decides: rank r gets
the (r // fit)-th gap, where ``fit`` pieces go into one. Gaps filled in a round are updated and open again in the
next; a length opens new sequences only when no gap, updated ones included, holds it. Rounds repeat until all
lengths are placed. A round needs the number of pieces of each length and the runs, at most ``capacity`` of
the former whatever the corpus; its matches are ranges of ranks, which are applied to all pieces at once by
a join in Spark. No piece passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import batches_of, give_back, keep, only
from parcelyard.llm.encoding import END_ID, WORDS, default_vocabulary, encoder
from parcelyard.operators.staging import LOOKUP_ROW_BYTES, broadcast_if_small, stage, with_source_position

CAPACITY = 1024
BATCH = 1_000  # documents that a Python worker holds at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MATCHES = "length long, first long, last long, first_sequence long, fit long, room_used long"


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; all but the first are full."""
    first = n % capacity or min(n, capacity)
    start = 0
    while start < n:
        length = first if start == 0 else capacity
        yield start, length
        start += length


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID, words: int = WORDS
) -> DataFrame:
    """Pieces of every document with the CRC-32 of their packed ids. NULL text counts as empty.

    ``words`` is what the encoder of a worker remembers: fewer take less memory and more time.
    """
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(vocabulary, words).packed
        try:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = memoryview(packed(text.as_py(), end_id))
                    for piece, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc_id, piece, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )
        finally:
            give_back()

    source = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(encode, PIECES)


def match_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Matches of lengths to sequences: length, first and last rank (0-based), sequence of the first, pieces
    per sequence, room used before them. ``counts`` has the number of pieces of each length."""
    left, placed = {k: n for k, n in counts.items() if n}, dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # room -> runs of (first sequence, number)
    matches, opened = [], 0

    def fill(length: int, room: int, sequence: int, number: int, fresh: dict) -> int:
        """Put pieces into a run of equal gaps; how many gaps got some."""
        fit = room // length
        full, rest = divmod(min(left[length], number * fit), fit)
        taken = full * fit + rest
        first = placed[length]
        matches.append((length, first, first + taken - 1, sequence, fit, capacity - room))
        for fitted, at, n in ((fit, sequence, full), (rest, sequence + full, 1)):
            if n and fitted and room > fitted * length:
                fresh.setdefault(room - fitted * length, []).append((at, n))
        placed[length] += taken
        left[length] -= taken
        return full + (rest > 0)

    while left:
        fresh: dict[int, list[tuple[int, int]]] = {}
        rooms = sorted(gaps)
        for length in sorted(left, reverse=True):
            for room in rooms[bisect_left(rooms, length) :]:
                runs = gaps[room]
                while left[length] and runs:
                    sequence, number = runs.pop()
                    used = fill(length, room, sequence, number, fresh)
                    if used < number:
                        runs.append((sequence + used, number - used))
                if not left[length]:
                    break
            if left[length] and length > max(fresh, default=0):
                needed = -(-left[length] // (capacity // length))
                opened += fill(length, capacity, opened, needed, fresh)
        for room, runs in fresh.items():
            gaps.setdefault(room, []).extend(runs)
        gaps = {room: runs for room, runs in gaps.items() if runs}
        left = {length: n for length, n in left.items() if n}
    return matches


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``; other columns stay.

    ``pieces`` must be a stored table. Equal rows are packed each on its own; an empty table gives none.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    positioned = with_source_position(pieces)
    staged = stage(positioned, ["length", *positioned.columns[-2:]])
    counts = {r["length"]: r["count"] for r in staged.read().groupBy("length").count().collect()}
    shorter, seen = {}, 0
    for length in sorted(counts):
        shorter[length], seen = seen, seen + counts[length]
    matches = [
        (length, shorter[length] + first, shorter[length] + last, *rest)
        for length, first, last, *rest in match_rounds(counts, capacity)
    ]
    table = broadcast_if_small(spark.createDataFrame(matches, MATCHES), len(matches) * LOOKUP_ROW_BYTES)
    rank = F.col("row_index") - 1 - F.col("first")
    return (
        staged.indexed().join(table, "length").filter((F.col("row_index") - 1).between(F.col("first"), F.col("last")))
        .select(
            *names,
            (F.col("first_sequence") + F.floor(rank / F.col("fit"))).alias("sequence_id"),
            (F.col("room_used") + rank % F.col("fit") * F.col("length")).alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, words: int = WORDS) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    with batches_of(docs.sparkSession, BATCH):
        pieces = keep(token_pieces(docs, capacity, vocabulary, words=words), "pieces")
    return pack(pieces, capacity)
