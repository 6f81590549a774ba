"""Near-duplicate lines by a deletion-neighbourhood join (operator 10). Spark SQL functions only.

A line goes when an equal line, or one within one edit (a character inserted, deleted or replaced), stands earlier
in the corpus; order is by document id, then line number. Lines with fewer than ``MIN_CHARS`` characters stay: they are too
short to tell copies from chance.

Variants of a line are itself with one character deleted: two lines are within one edit if the shorter equals a
variant of the longer, or if deleting the same place of both gives the same text. Emitting all variants of all lines would
take a key per character, so exact filters come before. Two lines of m and m or m+1 characters that differ
by one edit differ in one of s consecutive segments only, and agree before and after it (counted from the front
and from the back). The frame of segment j is the hash of m, j and the text around the segment; each line has s
frames for its own length and s for one less. First every distinct line's frames for s = 2 are counted; lines that share none
go no further. Those left are cut into about sqrt(m) segments, and only segments whose frame is shared emit their
variants, as keys of frame and variant. Lines with an equal key are joined through the earliest line of the key, never
pairwise, and the edit distance of each such pair is verified on the texts.

Defined cases: NULL and empty texts have no lines to remove; a NULL id comes first; lines of documents with equal ids are
ordered by line number. In a ``stored`` table the order is total: at the same id and line number the hash of the text
decides, and of equal rows (same id and text) the first by file and row, so all lines of the others are later copies.
Frames that are not stored have no row numbers: there equal rows are the same document and lose the same lines, and of
two lines at the same id and line number neither is earlier. Lines end at newline characters, and other characters, also
carriage returns, belong to the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import discard, keep, keep_alone, row_key

MIN_CHARS = 16
LINE = ["h1", "h2"]  # 128-bit identity of a line's text
KEY = ["row_id", "row_hash"]
PLACE = ["row_id", "pos"]
TOTAL = [*PLACE, "row_hash"]  # the place in a stored table; equal rows are told apart by later_rows


def _identity(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2")]


def _edge(n: Column, segments: Column, j: Column) -> Column:
    """Start of segment j of ``n`` characters in ``segments`` about equal ones."""
    return F.least(F.ceil(n / segments) * j, n).cast("int")


def frames(line: str) -> Column:
    """Array of (m, j, frame, segment) of a line: about sqrt(m) segments for its own length and for one less."""
    text, n = F.col(line), F.char_length(line)

    def of(m: Column) -> Column:
        s = F.greatest(F.ceil(F.sqrt(m)), F.lit(2)).cast("int")

        def cut(j: Column) -> Column:
            start, after = _edge(m, s, j), m - _edge(m, s, j + 1)
            frame = F.xxhash64(
                m, s, j, F.substring(text, F.lit(1), start), F.substring(text, n - after + 1, after)
            )
            return F.struct(
                m.alias("m"), j.alias("j"), frame.alias("frame"), F.substring(text, start + 1, n - start - after).alias("segment")
            )

        return F.transform(F.sequence(F.lit(0), s - 1), cut)

    return F.concat(of(n), of(n - 1))


def half_frames(line: str) -> list[Column]:
    """The frames for two segments, as plain expressions: the text after the first half or before the second."""
    n, out = F.col("n"), []
    for m in (n, n - 1):
        half = F.ceil(m / 2).cast("int")
        out.append(F.xxhash64(m, F.lit("after"), F.substring(F.col(line), n - (m - half) + 1, m - half)))
        out.append(F.xxhash64(m, F.lit("before"), F.substring(F.col(line), F.lit(1), half)))
    return out


def lines_of(docs: DataFrame) -> DataFrame:
    """row_id, row_hash, pos (from 0), line; NULL text has none."""
    return docs.select(*row_key(), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def distinct_lines(docs: DataFrame, min_chars: int = MIN_CHARS, place: list[str] = PLACE) -> DataFrame:
    """Each distinct long enough line: identity, first place, and its frames for two segments."""
    rows = lines_of(docs).withColumn("n", F.char_length("line")).filter(F.col("n") >= min_chars)
    rows = rows.select(*place, *_identity("line"), *[f.alias(f"f{k}") for k, f in enumerate(half_frames("line"))])
    return rows.groupBy(*LINE).agg(F.min(F.struct(*place)).alias("first"), *[F.min(f"f{k}").alias(f"f{k}") for k in range(4)])


def shared_keys(keyed: DataFrame, key: str) -> DataFrame:
    """Keys held by at least two distinct lines, stored; ``keyed`` has each key of a line once."""
    return keep(keyed.groupBy(key).agg(F.count("*").alias("c")).filter("c > 1").select(key), f"shared-{key}s")


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Identity of every line in ``firsts`` that has a line within one edit whose first place is earlier."""
    halves = firsts.select(*LINE, F.explode(F.array_distinct(F.array(*[f"f{k}" for k in range(4)]))).alias("frame"))
    possible = halves.join(shared_keys(halves, "frame"), "frame", "left_semi").select(*LINE).distinct()
    places = keep(firsts.select(*LINE, "first").join(possible, LINE), "possible-lines")
    # Their texts, each from its first place.
    wanted = places.select(*LINE, "first", "first.row_id", "first.pos")
    holders = keep(wanted.select("row_id").distinct(), "holders")
    texts = lines_of(docs.join(holders, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))) == F.col("row_id"), "left_semi"))
    texts = texts.select("row_id", "pos", "line", *_identity("line")).join(wanted, ["row_id", "pos", *LINE])
    texts = keep(texts.select(*LINE, "first", "line").dropDuplicates(LINE), "line-texts")
    cut = texts.select(*LINE, "first", F.char_length("line").alias("n"), F.explode(frames("line")).alias("f"))
    every = keep(cut.select(*LINE, "first", "n", "f.*"), "frames")
    cut = keep(every.join(shared_keys(every.select(*LINE, "frame"), "frame"), "frame", "left_semi"), "segments")
    discard(every)
    # Roles: 0 deletes the same place of two equally long lines, 1 is the shorter and 2 the longer of two.
    places = F.sequence(F.lit(1), F.greatest(F.char_length("segment"), F.lit(1)))
    short = lambda i: F.concat(F.expr("substring(segment, 1, 0)"), F.substring("segment", F.lit(1), i - 1), F.substring(F.col("segment"), i + 1, F.char_length("segment")))
    variant = lambda role, at, text: F.struct(F.lit(role).alias("role"), F.xxhash64("frame", F.lit(role > 0), at, text).alias("variant"))
    none = F.lit(0)
    same = F.concat(F.transform(places, lambda i: variant(0, i, short(i))), F.array(variant(1, none, F.col("segment"))))
    less = F.transform(places, lambda i: variant(2, none, short(i)))
    whole = F.when(F.char_length("segment") == 0, F.array(variant(1, none, F.col("segment")))).otherwise(same)
    emitted = cut.select(*LINE, "first", F.explode(F.when(F.col("n") == F.col("m"), whole).otherwise(less)).alias("v"))
    emitted = emitted.select(*LINE, "first", "v.*")
    me = F.struct("first", *LINE)
    earliest = emitted.groupBy("variant").agg(*[F.min(F.when(F.col("role") == r, me)).alias(f"e{r}") for r in range(3)], F.count("*").alias("c"))
    other = F.when(F.col("role") == 0, F.col("e0")).when(F.col("role") == 1, F.col("e2")).otherwise(F.col("e1"))
    met = emitted.join(earliest.filter("c > 1"), "variant").withColumn("other", other).filter(F.col("other.first") < F.col("first"))
    pairs = met.select(*LINE, F.col("other.h1").alias("o1"), F.col("other.h2").alias("o2")).distinct()
    mine = texts.select(*LINE, "line")
    theirs = mine.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("other_line"))
    verified = pairs.join(mine, LINE).join(theirs, ["o1", "o2"]).filter(F.levenshtein("line", "other_line", 1).between(0, 1))
    return verified.select(*LINE).distinct()


def line_flags(docs: DataFrame, min_chars: int = MIN_CHARS, place: list[str] = PLACE) -> DataFrame:
    """Rows that lose lines: row_id, row_hash, and ``mask`` with a byte per line, '1' where it goes."""
    return keep_alone(lambda: _line_flags(docs, min_chars, place), "line-masks")


def _line_flags(docs: DataFrame, min_chars: int, place: list[str]) -> DataFrame:
    firsts = keep(distinct_lines(docs, min_chars, place), "first-lines")
    near = keep_alone(lambda: near_lines(docs, firsts), "near-lines").withColumn("near", F.lit(True))
    of_line = firsts.select(*LINE, "first").join(near, LINE, "left")
    placed = lines_of(docs).select(*KEY, "pos", *_identity("line"))
    goes = F.coalesce("near", F.lit(False)) | (F.col("first") < F.struct(*place))
    flags = placed.join(of_line, LINE, "left").select(*KEY, "pos", F.coalesce(goes, F.lit(False)).alias("goes"))
    # Equal rows send equal flags; one of each place is enough.
    listed = flags.distinct().groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("pos", "goes"))).alias("flags"), F.max("goes").alias("any"))
    mask = F.array_join(F.transform("flags", lambda f: F.when(f["goes"], "1").otherwise("0")), "").cast("binary")
    return listed.filter("any").select(*KEY, mask.alias("mask"))


def _stored_place() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def first_rows(docs: DataFrame) -> DataFrame:
    """The first place of each text row that a stored table holds more than once: row_id, row_hash, at."""
    rows = docs.filter(F.col("text").isNotNull()).select(*row_key(), _stored_place().alias("at"))
    counted = rows.groupBy(*KEY).agg(F.min("at").alias("at"), F.count("*").alias("c"))
    return counted.filter("c > 1").select(*KEY, "at")


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, stored: bool = False) -> DataFrame:
    """Each row of ``docs`` (doc_id, text and more) as ``doc``, a struct of its columns, with ``kept``, the text of the lines
    that stay, and ``removed``, how many went.

    ``stored``: ``docs`` is a stored table, and exactly one of all copies of a line is the earliest.
    """
    narrow = docs.select("doc_id", "text", *(["_metadata"] if stored else []))  # whatever other columns are called
    masks = line_flags(narrow, min_chars, TOTAL if stored else PLACE)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    if stored:
        masks = masks.join(first_rows(narrow), KEY, "full")
        keyed = docs.select(row, *row_key(), _stored_place().alias("place"))
    else:
        keyed = docs.select(row, *row_key())
    joined = keyed.join(masks, KEY, "left")
    text = F.col("doc").getField("text")  # once in what is shuffled
    lines = F.split(text, "\n", -1)
    stays = F.filter(lines, lambda _, i: F.substring(F.col("mask"), i + 1, F.lit(1)) == F.lit(b"0"))
    kept = F.when(F.col("mask").isNull(), text).otherwise(F.array_join(stays, "\n"))
    removed = F.coalesce(F.octet_length(F.regexp_replace(F.col("mask").cast("string"), "0", "")), F.lit(0))
    if stored:
        # Every line of a later equal row stands in the first one too.
        later = F.col("at").isNotNull() & (F.col("place") != F.col("at"))
        short = F.filter(lines, lambda line: F.char_length(line) < min_chars)
        kept = F.when(later, F.array_join(short, "\n")).otherwise(kept)
        removed = F.when(later, F.size(lines) - F.size(short)).otherwise(removed)
    return joined.select("doc", kept.alias("kept"), removed.cast("long").alias("removed"))


def digests(docs: DataFrame, min_chars: int = MIN_CHARS, stored: bool = False) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 (of the remaining text in UTF-8)."""
    found = deduplicated(docs.select("doc_id", "text"), min_chars, stored)
    lines = F.coalesce(F.size(F.split("doc.text", "\n", -1)), F.lit(0))
    return found.select(
        F.col("doc.doc_id").cast("long"), F.when(F.col("doc.text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"),
        F.col("removed").alias("n_removed"), F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


def keep_first_lines(docs: DataFrame, min_chars: int = MIN_CHARS, stored: bool = False) -> DataFrame:
    """Documents with the lines that stay as their text; one that lost lines and has nothing else left goes.

    ``n_chars`` follows the text where that column exists. Other columns stay as they are.
    """
    found = deduplicated(docs, min_chars, stored).filter((F.col("removed") == 0) | (F.trim("kept") != ""))
    changed = F.col("removed") > 0
    out = []
    for c in docs.columns:
        own = F.col("doc").getField(c)
        if c == "text":
            out.append(F.col("kept").alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            out.append(F.when(changed, F.char_length("kept").cast(kind)).otherwise(own).alias("n_chars"))
        else:
            out.append(own.alias(c))
    return found.select(*out)
