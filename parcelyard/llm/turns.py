"""Repair of conversation structure by rank-convergence parallel Viterbi (operator 12).

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. Its rows, by turn, are kept, given another role
or deleted, and empty rows are inserted, at the least total cost; of equally cheap repairs the one whose edits, written
``D``, ``I``, ``K``, ``R``, come first in ASCII order is taken. With ``W[i][s]`` the least cost from row i on in state s of
that pattern (nothing yet, after s, after u, after a) this is a Viterbi recursion from the last row backwards; the edits are
then read off forwards, at each row the least letter that keeps to the cost.

Rows are range-sorted by conversation and turn and cut into chunks of up to ``CHUNK`` rows, so a conversation of any
size is spread over tasks, and a chunk is one letter a row. A chunk that ends its conversation starts from the known
end vector. Any other starts from four *speculative cost vectors*: whatever follows, an inserted or deleted row bounds
the differences between the states' costs, and each vector within these bounds is a minimum of these four plus
constants. Once the four left ends *differ only by constants*, the chunk's left end is known whatever follows. The others
(long runs of one role keep two parities apart) take part in *fix-up passes*, which are rerun until no such chunk is
left: a pass takes the vectors of what follows the rows covered so far and reruns the chunk from them, which by linearity
needs its four vectors and not its rows. The rows covered double with each pass, so there are few passes even where nothing
converges. The *stitched backward costs* then drive the tracing: a chunk tells in which state it ends for each state
it may begin in, passes of the same kind find the state it does begin in, and its edits are traced.

Costs are kept less their minimum; as differences are bounded there are few such vectors, so a step is looked up by letter
and vector. Rows are shuffled twice (sorting; bringing a conversation's repaired rows together). SHA-256 has no
parallel form: the digest of a conversation is made by one task, row by row from a sorted shuffle, in bounded memory.
``repaired_rows`` spreads one conversation over tasks.

Defined cases: NULL role or text counts as one space, NULL turns come first, a NULL conversation id is a conversation.
Rows of equal turn are ordered by role, MD5 of the text and place in the input; equal rows follow each other. Further
columns are not read, whatever their names. Numbers of missing turns beyond 64 bits are NULL.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parcelyard.llm.common import keep, only

CHUNK = 8_192
BLANKS = " \t\n\x0b\x0c\r"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
NAMES = {"u": "user", "a": "assistant"}

# States: nothing yet, after s, after u, after a. The next letter wanted (s may come first, too), and the state after it.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WANTED = "uuau"
AFTER = (USER, USER, ASSISTANT, USER)
END = (0, 6, 3, 0)  # what it costs to end: insert u and a, insert a
# Whatever rows follow, W[i] <= W[j] + BOUND[i][j]: from i, what j does can be done after so much of inserting and deleting.
BOUND = ((0, 0, 3, 0), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
SPECULATIVE = tuple(zip(*BOUND))
# A letter a row: initial s, u, a or other; capital if truncated; a digit if it has to go.
LETTERS = "suaxSUAX0123"
LEGAL = {"su", "ua", "au"}
_CLASS = str.maketrans("SUAX0123", "suaxsuax")

Vector = tuple[int, int, int, int]


@functools.cache
def step(letter: str, after: Vector) -> tuple[Vector, int, tuple[tuple[str, int], ...]]:
    """From the costs after a row to those before it, less their minimum; and for each state the edits and the next state."""
    initial, extra = letter.translate(_CLASS), TRUNCATED_COST if letter in "SUAX" else 0
    once: list[tuple[int, str, int]] = []  # cheapest treatment of the row itself
    for state in range(4):
        ways = [(DELETE_COST + after[state], "D", state)]
        if not letter.isdigit():
            if initial == WANTED[state]:
                ways.append((extra + after[AFTER[state]], "K", AFTER[state]))
            elif initial == "s" and state == NOTHING:
                ways.append((extra + after[SYSTEM], "K", SYSTEM))
            ways.append((REROLE_COST + extra + after[AFTER[state]], "R", AFTER[state]))
        once.append(min(ways))
    costs, moves = [], []
    for state in range(4):
        # Rows may be inserted first; a second turn through u and a never pays. Of equal costs the least edits.
        cost, edits, at = once[state]
        ways, place = [(cost, edits, at)], state
        for inserted in (1, 2):
            place = AFTER[place]
            cost, edits, at = once[place]
            ways.append((INSERT_COST * inserted + cost, "I" * inserted + edits, at))
        cost, edits, at = min(ways)
        costs.append(cost)
        moves.append((edits, at))
    least = min(costs)
    return tuple(c - least for c in costs), least, tuple(moves)


def sweep(letters: str, after: Vector) -> tuple[Vector, int]:
    """Costs before a chunk from those after it, and their minimum."""
    total = min(after)
    vector = tuple(c - total for c in after)
    for letter in reversed(letters):
        vector, least, _ = step(letter, vector)
        total += least
    return vector, total


def speculate(letters: str) -> list[Vector]:
    """The left ends of a chunk for the four speculative vectors."""
    return [tuple(c + total for c in vector) for vector, total in (sweep(letters, s) for s in SPECULATIVE)]


def rerun(ends: list[Vector], after: Vector) -> Vector:
    """The left end of a chunk from ``after``, by the left ends it has for the speculative vectors."""
    return tuple(min(after[k] + ends[k][state] for k in range(4)) for state in range(4))


def relative(vector: Vector) -> Vector:
    return tuple(c - min(vector) for c in vector)


def converged(ends: list[Vector]) -> bool:
    """Do the vectors differ only by constants?"""
    return len({relative(v) for v in ends}) == 1


def plan(letters: str, after: Vector) -> list[tuple[tuple[str, int], ...]]:
    """For each row of a chunk and each state, the edits and the next state."""
    moves, vector = [], relative(after)
    for letter in reversed(letters):
        vector, _, move = step(letter, vector)
        moves.append(move)
    return moves[::-1]


def exits(letters: str, after: Vector) -> list[int]:
    """The state after a chunk for each state before it."""
    states = list(range(4))
    for move in plan(letters, after):
        states = [move[s][1] for s in states]
    return states


def trace(letters: str, after: Vector, state: int, last: bool) -> tuple[str, int]:
    """Edits of a chunk, and what they cost."""
    edits = []
    for move in plan(letters, after):
        done, state = move[state]
        edits.append(done)
    cost = sum(TRUNCATED_COST for letter, done in zip(letters, edits) if letter in "SUAX" and done[-1] != "D")
    if last:
        edits.append({SYSTEM: "II", USER: "I"}.get(state, ""))
    audit = "".join(edits)
    return audit, cost + DELETE_COST * audit.count("D") + INSERT_COST * audit.count("I") + REROLE_COST * audit.count("R")


def _conversation(conv_id: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("")).alias("conv")


def damaged(rows: DataFrame) -> DataFrame:
    """A fixed twentieth each of all rows dropped, emptied, cut of its sentence ends, repeated, given to the user."""
    text = F.coalesce("text", F.lit(" "))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    return (
        only(rows, "conv_id", "turn", "role", "text").withColumn("kind", kind).filter("kind <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        ).drop("copy")
    )


def _ordered(rows: DataFrame, chunk: int) -> DataFrame:
    """All rows in the order of their conversations, written once; ``place`` tells the order, also across tasks."""
    text = F.coalesce("text", F.lit(" "))
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest", "seen"]
    return keep(
        rows.select(
            _conversation(), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
            F.md5(text.cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("seen"),
        )
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("chunk", F.expr(f"place div {chunk}")).drop("seen"),
        "turns",
    )


def _chunks(rows: DataFrame) -> DataFrame:
    """Per chunk of a conversation: its letters, its first place, and how many rows have which fault."""
    end = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    rows = rows.select(
        "conv", "chunk", "place", "role", "digest", kind.alias("kind"), (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    repeated = (
        rows.filter("not blank").groupBy("conv", "role", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )
    fault = F.when(F.col("blank"), 3).when(F.col("place") > F.col("first"), 2).when(F.col("cut"), 1).otherwise(0)
    letter = F.lit(LETTERS).substr(F.col("kind") + F.least("fault", F.lit(2)) * 4, F.lit(1))
    row = F.struct("place", letter.alias("letter"))
    return keep(
        rows.join(repeated, ["conv", "role", "digest"], "left").withColumn("fault", fault)
        .groupBy("conv", "chunk").agg(
            F.min("place").alias("place"), F.sort_array(F.collect_list(row)).alias("rows"),
            *[F.count_if(F.col("fault") == n).alias(name) for n, name in ((3, "blank"), (2, "duplicate"), (1, "truncated"))],
        )
        .withColumn("letters", F.array_join(F.transform("rows", lambda r: r["letter"]), "")).drop("rows"),
        "chunks",
    )


def _mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` of each row as a dict, which returns the values of ``schema``."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [dict(zip(arrow.names, function(row))) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.mapInArrow(run, schema)


def _passes(start: DataFrame, forward: bool, combine: Callable, schema: str) -> tuple[DataFrame, int]:
    """Rerun fix-up passes over chunks (conv, number, ..., settled) until all are settled.

    A chunk that is not settled meets the one that follows (or, ``forward``, precedes) what it covers, which doubles.
    """
    state, covered, passes = keep(start, "fix-up"), 1, 0
    while not state.filter("not settled").isEmpty():
        others = state.select("conv", (F.col("number") + (covered if forward else -covered)).alias("number"), F.struct("*").alias("other"))
        state = keep(
            state.filter("settled").unionByName(_mapped(state.filter("not settled").join(others, ["conv", "number"]), combine, schema)),
            "fix-up",
        )
        covered, passes = 2 * covered, passes + 1
    return state, passes


ENDS = "conv string, number long, ends array<array<bigint>>, settled boolean"
EXITS = "conv string, number long, exits array<int>, settled boolean"


def _vectors(ends) -> list[Vector]:
    return [tuple(int(c) for c in vector) for vector in ends]


def _speculated(row: dict) -> tuple:
    ends = [sweep(row["letters"], END)[0]] * 4 if row["last"] else speculate(row["letters"])
    return row["conv"], row["number"], ends, converged(ends)


def _rerun(row: dict) -> tuple:
    own, others = _vectors(row["ends"]), _vectors(row["other"]["ends"])
    ends = [rerun(own, after) for after in others]
    return row["conv"], row["number"], ends, converged(ends) or bool(row["other"]["settled"])


def _exits(row: dict) -> tuple:
    found = exits(row["letters"], tuple(int(c) for c in row["after"]))
    if row["number"] == 1:
        found = [found[NOTHING]] * 4
    return row["conv"], row["number"], found, len(set(found)) == 1


def _led(row: dict) -> tuple:
    found = [int(row["exits"][s]) for s in row["other"]["exits"]]
    return row["conv"], row["number"], found, len(set(found)) == 1 or bool(row["other"]["settled"])


@dataclass(frozen=True)
class Stitched:
    """Chunks with the costs after them and the state before them; how many passes that took."""

    chunks: DataFrame
    passes: tuple[int, int]


def stitched(chunks: DataFrame) -> Stitched:
    """Find, for the chunks of conversations that have several, costs after and state before."""
    along = Window.partitionBy("conv").orderBy("place")
    # One narrow row a chunk; where there is only one, nothing is left to do.
    links = keep(
        chunks.select("conv", "chunk", "place", F.substring("letters", -1, 1).alias("letter"))
        .select(
            "conv", "chunk", F.row_number().over(along).cast("long").alias("number"), F.lag("letter").over(along).alias("before"),
            F.lead("chunk").over(along).isNull().alias("last"),
        ).filter("number > 1 or not last"),
        "links",
    )
    if links.isEmpty():
        whole = chunks.withColumns({
            "after": F.array(*[F.lit(c).cast("long") for c in END]), "state": F.lit(NOTHING), "before": F.lit(""), "last": F.lit(True),
        })
        return Stitched(whole, (0, 0))
    several = keep(chunks.select("conv", "chunk", "letters").join(links, ["conv", "chunk"]), "several")
    ends, back = _passes(_mapped(several, _speculated, ENDS), False, _rerun, ENDS)
    after = ends.select("conv", (F.col("number") - 1).alias("number"), F.col("ends")[0].alias("after"))
    several = keep(
        several.join(after, ["conv", "number"], "left")
        .withColumn("after", F.coalesce("after", F.array(*[F.lit(c).cast("long") for c in END]))),
        "costs",
    )
    led, forth = _passes(_mapped(several, _exits, EXITS), True, _led, EXITS)
    state = led.select("conv", (F.col("number") + 1).alias("number"), F.col("exits")[NOTHING].alias("state"))
    found = several.join(state, ["conv", "number"], "left").select("conv", "chunk", "after", "state", "before", "last")
    whole = chunks.join(found, ["conv", "chunk"], "left").withColumns({
        "after": F.coalesce("after", F.array(*[F.lit(c).cast("long") for c in END])), "state": F.coalesce("state", F.lit(NOTHING)),
        "before": F.coalesce("before", F.lit("")), "last": F.coalesce("last", F.lit(True)),
    })
    return Stitched(whole, (back, forth))


TRACED = "conv string, chunk long, place long, blank long, duplicate long, truncated long, state int, audit string, cost long, illegal long"


def _traced(row: dict) -> tuple:
    audit, cost = trace(row["letters"], tuple(int(c) for c in row["after"]), row["state"], row["last"])
    initials = (row["before"] + row["letters"]).translate(_CLASS)
    illegal = sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1))
    return *[row[c] for c in ("conv", "chunk", "place", "blank", "duplicate", "truncated", "state")], audit, cost, illegal


@dataclass(frozen=True)
class Repair:
    """The rows in order, and per chunk what is done to them."""

    rows: DataFrame
    chunks: DataFrame
    passes: tuple[int, int]


def repair(conversations: DataFrame, chunk: int = CHUNK) -> Repair:
    """Find the cheapest repair of each conversation (conv_id, turn, role, text)."""
    rows = _ordered(only(conversations, "conv_id", "turn", "role", "text"), chunk)
    found = stitched(_chunks(rows))
    return Repair(rows, _mapped(found.chunks, _traced, TRACED), found.passes)


def _together(done: Repair, *keys: str) -> DataFrame:
    """Chunks, each followed by its rows, in the order of their conversations."""
    rows = done.rows.select("conv", "chunk", "place", F.lit(True).alias("is_row"), "turn", "role", "text")
    chunks = done.chunks.select("*", F.lit(False).alias("is_row"))
    return (
        chunks.unionByName(rows, allowMissingColumns=True).repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions("conv", "place", "is_row")
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict | None, list[tuple[int, str, str]]]]:
    """Conversation, row or chunk, and the repaired rows (place, role, text) that it gives; none is kept."""
    edits, at, state, conv, place = "", 0, NOTHING, None, 0

    def inserted() -> list[tuple[int, str, str]]:
        nonlocal at, state
        made = []
        while at < len(edits) and edits[at] == "I":
            made.append((place, NAMES[WANTED[state]], ""))
            at, state = at + 1, AFTER[state]
        return made

    for batch in batches:
        for row in batch.to_pylist():
            if not row["is_row"]:
                if conv is not None:
                    yield conv, None, inserted()  # those after the last row
                edits, at, state, conv = row["audit"], 0, row["state"], row["conv"]
                yield conv, row, []
                continue
            place = row["place"]
            made, edit = inserted(), edits[at]
            at += 1
            if edit == "K":
                made.append((place, row["role"], row["text"]))
                state = SYSTEM if state == NOTHING and row["role"][0] == "s" else AFTER[state]
            elif edit == "R":
                made.append((place, NAMES[WANTED[state]], row["text"]))
                state = AFTER[state]
            yield conv, row, made
    if conv is not None:
        yield conv, None, inserted()


REPAIRED = "conv string, place long, nth int, role string, text string"


def repaired_rows(done: Repair) -> DataFrame:
    """The repaired conversations: conv, place, nth, role, text; place and nth give the order of a conversation."""
    schema = to_arrow_schema(T.StructType.fromDDL(REPAIRED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []
        last, nth = None, 0
        for conv, _, made in _walk(batches):
            for place, role, text in made:
                nth = nth + 1 if (conv, place) == last else 0
                last = conv, place
                lines.append(dict(zip(schema.names, (conv, place, nth, role, text))))
            if len(lines) >= 1000:
                yield pa.RecordBatch.from_pylist(lines, schema)
                lines = []
        yield pa.RecordBatch.from_pylist(lines, schema)

    return _together(done, "conv", "chunk").mapInArrow(run, REPAIRED)


COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
SUMMARY = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summaries(done: Repair) -> DataFrame:
    """Per conversation: missing turns, faults, cost, edits, and the digest of its repaired rows."""
    schema = to_arrow_schema(T.StructType.fromDDL(SUMMARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, finished = None, []

        def finish() -> None:
            gaps = current["last"] - current["first"] + 1 - current["turns"] if current["turns"] else 0
            finished.append({
                "conv": current["conv"], "gaps": gaps if gaps < 2**63 else None, **{c: current[c] for c in COUNTS},
                "audit": "".join(current["audit"]), "repaired_sha256": current["hash"].hexdigest(),
            })

        for conv, row, made in _walk(batches):
            if current is None or conv != current["conv"]:
                if current is not None:
                    finish()
                current = {"conv": conv, "first": None, "last": None, "turns": 0, "audit": [], "lines": 0,
                           "hash": hashlib.sha256(), **dict.fromkeys(COUNTS, 0)}
            if row is not None and not row["is_row"]:
                current["audit"].append(row["audit"])
                for c in COUNTS:
                    current[c] += row[c]
            elif row is not None and row["turn"] is not None and row["turn"] != current["last"]:
                current["first"] = row["turn"] if current["first"] is None else current["first"]
                current["last"], current["turns"] = row["turn"], current["turns"] + 1
            for _, role, text in made:
                current["hash"].update(f"{chr(10) * bool(current['lines'])}{role}:{text}".encode())
                current["lines"] += 1
            if len(finished) >= 1000:
                yield pa.RecordBatch.from_pylist(finished, schema)
                finished.clear()
        if current is not None:
            finish()
        yield pa.RecordBatch.from_pylist(finished, schema)

    return _together(done, "conv").mapInArrow(run, SUMMARY)


def repair_report(original: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each conversation of ``original``, with the repair of what ``conversations`` has of it."""
    ids = only(original, "conv_id").distinct().withColumn("conv", _conversation())
    done = summaries(repair(conversations, chunk))
    number = {c: F.when(F.col("repaired_sha256").isNull(), F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in ("gaps", *COUNTS)}
    return ids.join(done, "conv", "left").select(
        "conv_id", *number.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
