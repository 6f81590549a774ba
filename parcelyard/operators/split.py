"""Exact splits of a staged table: by rows, by bytes, by key; and the row cap of a read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.operators.staging import (
    BYTES, LOOKUP_ROW_BYTES, PART, POSITION, StagedRows, broadcast_if_small, refuse_columns, stage,
)
from parcelyard.session import scratch_path

SPLIT, SPLIT_ROW = "split_id", "split_row"
BLOCK_ROWS = 65_536  # rows whose bytes are summed together before split starts are located
MAX_STARTS = 64  # split starts that one look-up list may hold
_FAN = 64  # a chunk with more is cut into so many
_MAX_CHUNKS = 200_000
_STARTS_PER_CHUNK = 8  # on average


def table_name(base: str, split_id: Column, splits: int) -> Column:
    """``base`` for an undivided table, ``base_1``, ``base_2`` ... for a divided one."""
    if splits <= 1:
        return F.lit(base)
    return F.concat(F.lit(f"{base}_"), split_id.cast("string"))


def capped_split(staged: StagedRows, threshold: int | None) -> DataFrame:
    """Rows with ``split_id`` and their 1-based place in it; at most ``threshold`` rows per split.

    No threshold (None or 0) means one split. The index makes this plain arithmetic per row.
    """
    refuse_columns(staged.schema.names, (SPLIT, SPLIT_ROW))
    cap = threshold or max(staged.total_rows, 1)
    return staged.indexed().withColumns({
        SPLIT: F.expr(f"int((row_index - 1) div {cap} + 1)"),
        SPLIT_ROW: F.expr(f"(row_index - 1) % {cap} + 1"),
    })


def split_total(rows: int, threshold: int | None) -> int:
    """How many splits ``capped_split`` makes."""
    if not rows:
        return 0
    return -(-rows // threshold) if threshold else 1


def capped_counts(spark: SparkSession, rows: int, threshold: int | None) -> DataFrame:
    """What ``split_counts`` of a capped split gives, from the number of rows alone."""
    splits = split_total(rows, threshold)
    cap = threshold or rows
    return spark.range(1, splits + 1).select(
        F.col("id").cast("int").alias(SPLIT),
        F.least(F.lit(cap).cast("long"), F.lit(rows).cast("long") - (F.col("id") - 1) * cap).alias("row_count"),
    )


def _split_starts(staged: StagedRows, cap: int, block_rows: int, chunk_rows: int) -> DataFrame:
    """First position of every byte-capped split in each chunk of each part that it touches.

    Bytes are summed per block of rows first, which the map side does almost alone. Only blocks
    in which the running sum passes a multiple of ``cap`` are looked at row by row. A chunk is a
    whole number of blocks, so every chunk has a start at its first row.
    """
    rows = staged.sizes().withColumn("_block", F.expr(f"{POSITION} div {block_rows}"))
    by_block = Window.partitionBy(PART).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy(PART, "_block").agg(F.sum(BYTES).alias("_size"))
        .withColumn("_in_part", F.coalesce(F.sum("_size").over(by_block), F.lit(0)))
        .join(staged.part_offsets(), PART)
        .select(PART, "_block", "_size", (F.col("bytes_before") + F.col("_in_part")).alias("_before"))
    )
    at_block_start = blocks.select(
        PART, F.expr(f"_block * {block_rows}").alias("_start"), F.expr(f"_before div {cap} + 1").alias(SPLIT)
    )
    crossed = blocks.filter(F.expr(f"_before div {cap} <> (_before + _size) div {cap}")).drop("_size")
    crossed = broadcast_if_small(crossed, (staged.total_bytes // cap + 1) * LOOKUP_ROW_BYTES)
    by_row = Window.partitionBy(PART, "_block").orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        rows.join(crossed, [PART, "_block"])
        .withColumn("_in_block", F.coalesce(F.sum(BYTES).over(by_row), F.lit(0)))
        .select(PART, F.col(POSITION).alias("_start"), F.expr(f"(_before + _in_block) div {cap} + 1").alias(SPLIT))
    )
    chunk = F.expr(f"_start div {chunk_rows}").alias("_chunk")
    return at_block_start.unionByName(inside).groupBy(PART, chunk, SPLIT).agg(F.min("_start").alias("_start"))


def _start_index(starts: DataFrame, chunk_rows: int) -> list[tuple[int, DataFrame, int]]:
    """Look-up levels of split starts: rows per chunk, the chunks' sorted lists, how many lists there are.

    A chunk with at most ``MAX_STARTS`` starts has them as its list. One with more (much of the bytes in few rows) has none
    but is cut into ``_FAN`` smaller chunks, which are a level of their own, and so on: as a split begins with a row, a
    chunk of ``MAX_STARTS`` rows has no more starts than that. A cut chunk brings fewer chunks than it has starts, so
    every level has at most as many lists as there are starts, wherever the bytes lie.
    """
    levels = []
    while True:
        spark = starts.sparkSession
        path = scratch_path(spark, "starts")
        starts.withColumn("_chunk", F.expr(f"_start div {chunk_rows}")).write.parquet(path)
        placed = spark.read.parquet(path)
        counts = placed.groupBy(PART, "_chunk").agg(F.count("*").alias("_n"))
        sums = counts.agg(F.count("*"), F.count_if(F.col("_n") > MAX_STARTS)).first()
        crowded = counts.filter(F.col("_n") > MAX_STARTS).select(PART, "_chunk")
        few = placed.join(crowded, [PART, "_chunk"], "left_anti") if sums[1] else placed
        lists = few.groupBy(PART, "_chunk").agg(F.sort_array(F.collect_list(F.struct("_start", SPLIT))).alias("_starts"))
        levels.append((chunk_rows, lists, sums[0] - sums[1]))
        if not sums[1]:
            return levels
        size, chunk_rows = chunk_rows, max(chunk_rows // _FAN, MAX_STARTS)
        first = F.expr(f"(_chunk * {size} + {chunk_rows - 1}) div {chunk_rows} * {chunk_rows}")
        heads = crowded.withColumn("_start", F.explode(F.sequence(first, F.expr(f"(_chunk + 1) * {size} - 1"), F.lit(chunk_rows))))
        # A smaller chunk begins in the split of the last start before it; a crowded chunk itself begins with a start.
        along = Window.partitionBy(PART, "_chunk").orderBy("_start")
        starts = (
            placed.join(crowded, [PART, "_chunk"]).unionByName(heads.withColumn(SPLIT, F.lit(None).cast("long")))
            .groupBy(PART, "_chunk", "_start").agg(F.max(SPLIT).alias(SPLIT))
            .withColumn(SPLIT, F.last(SPLIT, ignorenulls=True).over(along)).drop("_chunk")
        )


def byte_capped_split(staged: StagedRows, cap: int, hard: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows with ``split_id`` so that a split ends with the row that reaches ``cap`` bytes.

    A split may pass ``cap`` by less than one row; ``hard`` lowers the cap by the largest row, so
    that no split passes it. The wide rows are not shuffled: each looks its split up in the sorted
    starts of its chunk of its part. Chunks are sized by count and by bytes and cut further where
    they hold many starts, so no row searches more than ``MAX_STARTS`` of them.
    """
    refuse_columns(staged.schema.names, (SPLIT, "row_bytes", "row_index"))
    if hard:
        cap -= staged.max_row_bytes
    if cap < 1:
        raise ValueError("the byte cap must be larger than the largest row")
    rows_per_cap = max(1, cap * staged.total_rows // max(staged.total_bytes, 1))
    chunk_rows = min(max(block_rows, staged.total_rows // _MAX_CHUNKS), _STARTS_PER_CHUNK * rows_per_cap)
    block_rows = min(block_rows, chunk_rows)
    chunk_rows -= chunk_rows % block_rows
    rows, found = staged.read(), []
    for level, (size, lists, count) in enumerate(_start_index(_split_starts(staged, cap, block_rows, chunk_rows), chunk_rows)):
        names = f"_chunk{level}", f"_starts{level}"
        lists = lists.withColumnsRenamed(dict(zip(("_chunk", "_starts"), names)))
        rows = rows.withColumn(names[0], F.expr(f"{POSITION} div {size}"))
        rows = rows.join(broadcast_if_small(lists, count * MAX_STARTS * LOOKUP_ROW_BYTES), [PART, names[0]], "left")
        reached = F.filter(names[1], lambda s: s["_start"] <= F.col(POSITION))
        # Most chunks lie in one split; only rows of the others search the starts.
        found.append(F.when(F.size(names[1]) == 1, F.col(names[1])[0]).otherwise(F.element_at(reached, -1)))
    return rows.join(staged.part_offsets(), PART).select(
        *staged.data_columns(),
        F.col(BYTES).alias("row_bytes"),
        (F.col("rows_before") + F.col(POSITION) + 1).alias("row_index"),
        F.coalesce(*found)[SPLIT].cast("int").alias(SPLIT),
    )


@dataclass(frozen=True)
class KeySplits:
    """Rows already divided by a key: one split per key value, numbered in key order."""

    rows: DataFrame
    splits: DataFrame
    count: int


def split_by_key(staged: StagedRows, key: str) -> KeySplits:
    """Treat the values of ``key`` as splits 1, 2, ...; ``split_row`` counts inside each.

    ``staged`` must be ordered by ``key`` first, so that a hot key spreads over as many range
    partitions as its rows need. Only the table of distinct keys is grouped and numbered.
    """
    refuse_columns(staged.schema.names, (SPLIT, SPLIT_ROW))
    indexed = staged.indexed()
    first_rows = indexed.groupBy(key).agg(F.min("row_index").alias("_first"), F.count("*").alias("row_count"))
    keys = stage(first_rows, [key], measure_bytes=True)
    splits = keys.indexed(SPLIT).withColumn(SPLIT, F.col(SPLIT).cast("int"))
    lookup = broadcast_if_small(splits.select(F.col(key).alias("_key"), SPLIT, "_first"), keys.total_bytes)
    rows = indexed.join(lookup, F.col(key).eqNullSafe(F.col("_key"))).withColumn(
        SPLIT_ROW, F.col("row_index") - F.col("_first") + 1
    )
    return KeySplits(
        rows.drop("_key", "_first", "row_index"), splits.select(SPLIT, key, "row_count"), keys.total_rows
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Number, key and rows of each split by ``key``, from a scan of that column alone.

    The numbers are those of ``split_by_key``. Only the counts are put in order and written, one row per key: they are
    range-partitioned, numbered in their partition, and the keys before each partition are added, so the keys of a table
    with very many of them never meet in one task.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("row_count"))
    return stage(counts, [key]).indexed(SPLIT).select(F.col(SPLIT).cast("int").alias(SPLIT), key, "row_count")


def split_by_number(staged: StagedRows, column: str, splits: int) -> KeySplits:
    """Rows that carry their split's number, 1 to ``splits``, in ``column`` and lie in its order.

    Numbers without rows are splits of no rows. ``column`` itself is not kept.
    """
    refuse_columns(staged.schema.names, (SPLIT, SPLIT_ROW))
    indexed = staged.indexed().withColumnRenamed(column, SPLIT)
    first_rows = indexed.groupBy(SPLIT).agg(F.min("row_index").alias("_first"), F.count("*").alias("_rows"))
    first_rows = broadcast_if_small(first_rows, splits * LOOKUP_ROW_BYTES)
    rows = indexed.join(first_rows, SPLIT).withColumn(SPLIT_ROW, F.col("row_index") - F.col("_first") + 1)
    counts = (
        staged.spark.range(1, splits + 1).select(F.col("id").cast("int").alias(SPLIT))
        .join(first_rows, SPLIT, "left")
        .select(SPLIT, F.coalesce("_rows", F.lit(0)).alias("row_count"))
    )
    return KeySplits(rows.drop("_first", "_rows", "row_index"), counts, splits)


def capped_read(staged: StagedRows, limit: int) -> DataFrame:
    """The first ``limit`` rows in staging order, read in parallel from the partitions they fill."""
    return staged.indexed(first=limit)


def cut_off_key(df: DataFrame, order_by: list[str], limit: int, most: int = 100_000) -> tuple[Row | None, int]:
    """The key of the ``limit``-th row by ``order_by`` (NULLs first) and how many rows have smaller keys.

    A selection, not a sort: keys of a small random sample are boundaries, one scan of the key columns counts rows
    between them, and only the range that holds the wanted row is looked at again, until at most ``most`` rows are left
    or all left have one key. Some sixty keys and counts a round reach the driver. ``None`` where there are fewer rows.
    """
    key = F.struct(*order_by)
    keys, before, seed = df.select(*order_by), 0, 0
    total = keys.count()
    if total < limit:
        return None, total
    within = F.lit(True)
    while True:
        left = keys.filter(within)
        if total <= most:
            groups = left.groupBy(*order_by).agg(F.count("*").alias("_n")).orderBy(*[F.asc_nulls_first(c) for c in order_by])
            for row in groups.collect():
                if before + row["_n"] >= limit:
                    return row, before
                before += row["_n"]
        share = min(1.0, 4_096 / total)
        drawn = sorted({tuple(r) for r in left.sample(share, seed=seed).collect()}, key=_null_first)
        marks = drawn[:: max(1, len(drawn) // _MARKS)]
        seed += 1
        if not marks:
            continue
        # ``below`` marks are at or before a row; it is in bucket 2 * below if it equals the last of them, else in the next.
        bounds = F.array(*[F.struct(*[_literal(v, df.schema[c]).alias(c) for c, v in zip(order_by, m)]) for m in marks])
        below = F.size(F.filter(bounds, lambda m: (m < key) | m.eqNullSafe(key)))
        equal = F.exists(bounds, lambda m: m.eqNullSafe(key))
        bucket = F.when(equal, 2 * below).otherwise(2 * below + 1)
        counts = {r["_b"]: r["count"] for r in left.groupBy(bucket.alias("_b")).count().collect()}
        for b in sorted(counts):
            if before + counts[b] >= limit:
                break
            before += counts[b]
        total = counts[b]
        below = b // 2
        if b % 2 == 0:
            return Row(*order_by)(*marks[below - 1]), before
        if below:
            within = within & _after(marks[below - 1], order_by, df.schema)
        if below < len(marks):
            within = within & ~_after(marks[below], order_by, df.schema, or_equal=True)


_MARKS = 60


def _literal(value: object, field: T.StructField) -> Column:
    """A collected value as a constant of its column's type; times without a zone must not pass through one."""
    if isinstance(field.dataType, T.TimestampNTZType) and value is not None:
        value = str(value)
    return F.lit(value).cast(field.dataType)


def _null_first(key: tuple) -> tuple:
    return tuple((v is not None, v) if v is not None else (False,) for v in key)


def _after(mark: tuple, order_by: list[str], schema: T.StructType, or_equal: bool = False) -> Column:
    """Is a row's key larger than ``mark``? Written out on bare columns, so that scans can use it."""
    result = F.lit(or_equal)
    for name, value in reversed(list(zip(order_by, mark))):
        col, bound = F.col(name), _literal(value, schema[name])
        larger = col.isNotNull() if value is None else F.coalesce(col > bound, F.lit(False))
        result = larger | (col.eqNullSafe(bound) & result)
    return result


def first_rows(df: DataFrame, order_by: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order_by`` with their 1-based ``row_index``; ``df`` itself is neither sorted nor written.

    The key of the last of them is selected on the key columns, becomes a filter that reaches the scan, and only what
    it lets through is put in order. Rows that share that key are taken as they come until the limit is full; add
    source positions to ``order_by`` to fix which. A limit at or above the row count takes all rows.
    """
    last, _ = cut_off_key(df, order_by, limit) if limit > 0 else (None, 0)
    rows = df if limit > 0 else df.limit(0)
    if last is not None:
        key = tuple(last[c] for c in order_by)
        bare = F.col(order_by[0]).isNull()
        if key[0] is not None:
            bare = bare | (F.col(order_by[0]) <= _literal(key[0], df.schema[order_by[0]]))
        rows = df.filter(bare).filter(~_after(key, order_by, df.schema))
    return stage(rows, order_by).indexed(first=limit)


def split_counts(rows: DataFrame) -> DataFrame:
    """Rows per split in one aggregation."""
    return rows.groupBy(SPLIT).agg(F.count("*").alias("row_count"))
