"""Staging tables with an exact global row index.

A global ``row_number()`` would move all rows to one task, and a window per key value would move
all rows of a hot value to one task. Here every row knows the part of the table it is in and its
position in that part; rows per part, counted once, turn that into a global position by one
addition. There are two kinds of parts:

* ``index_stored`` takes a parquet table as it is: parts are its files, and the scan itself tells
  the row number in a file. Nothing is shuffled. This is for rows whose order is their own.
* ``stage`` puts rows in the order of a key: they are range-partitioned by the whole key, sorted
  inside each partition and written once with partition number and position. The wide rows are
  shuffled once; a hot key value spreads over as many partitions as its rows need.

Whatever reads the table afterwards needs no shuffle for the index, and it survives lost executors
because the table is on shared storage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, replace
from itertools import accumulate
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard.session import drop_path, scratch_path

PART, POSITION, BYTES = "_part", "_position", "_bytes"
SOURCE_FILE, SOURCE_ROW = "_source_file", "_source_row"
SEGMENT = "_segment"  # piece of a staging file that one task reads: its rows are in order and without gaps
_SIZES = f"{PART} long, {POSITION} long, {BYTES} long"
LOOKUP_ROW_BYTES = 64  # generous size in memory of a row of a few numbers
BROADCAST_BYTES = 128 * 1024**2  # lookup tables up to this size are broadcast
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low bits


def with_source_position(df: DataFrame) -> DataFrame:
    """Add file (as a number) and row number of a parquet scan: a tie-break that makes any order key total.

    Copies of a row, however many, get different positions and can so be spread over partitions.
    """
    return df.select(
        "*",
        F.xxhash64("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW),
    )


# Bytes of a value of fixed width in the target profile.
_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DecimalType: 8, T.DateType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def row_bytes(df: DataFrame) -> Column:
    """Estimated stored bytes of a row; NULL takes none, text and binary their own length."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        width = _FIXED_WIDTH.get(type(field.dataType))
        if width is not None:
            size = F.when(col.isNotNull(), F.lit(width)).otherwise(0)
        elif isinstance(field.dataType, (T.StringType, T.BinaryType, T.VarcharType, T.CharType)):
            size = F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(col)), F.lit(0))
        else:
            size = F.coalesce(F.octet_length(col.cast("string")), F.lit(0))
        total = total + size
    return total


@dataclass(frozen=True)
class Part:
    """A file of a stored table or a partition of an ordered one, in table order."""

    key: int
    rows: int
    size: int
    largest_row: int
    file: str | None = None


@dataclass(frozen=True)
class StagedRows:
    """A written staging table and its parts."""

    spark: SparkSession
    path: str
    schema: T.StructType
    parts: tuple[Part, ...]
    stored: bool = False
    sizes_path: str | None = None
    segments: bool = False

    def with_segments(self) -> StagedRows:
        """The same rows; ``indexed`` also gives them ``SEGMENT``, text whose order is that of the pieces in the table."""
        return replace(self, segments=True)

    @property
    def total_rows(self) -> int:
        return sum(part.rows for part in self.parts)

    @property
    def total_bytes(self) -> int:
        return sum(part.size for part in self.parts)

    @property
    def max_row_bytes(self) -> int:
        return max((part.largest_row for part in self.parts), default=0)

    def read(self, parts: int | None = None) -> DataFrame:
        """Rows with part key, position and bytes; of the first ``parts`` parts when given."""
        reader = self.spark.read.schema(self.schema)
        if parts is None or not self.parts:
            rows = reader.parquet(self.path)
        elif self.stored:
            # The scan reports file names URL-encoded; the base path keeps partition columns.
            files = [unquote(part.file) for part in self.parts[:parts]]
            rows = reader.option("basePath", self.path).parquet(*files)
        else:
            rows = reader.parquet(self.path).filter(F.col(PART) <= self.parts[parts - 1].key)
        if self.segments:
            rows = rows.select("*", F.col("_metadata.file_block_start").alias(SEGMENT), "_metadata")
        return _positioned(rows) if self.stored else rows

    def sizes(self) -> DataFrame:
        """Part, position and bytes of every row: narrow columns only."""
        if self.sizes_path:
            return self.spark.read.schema(_SIZES).parquet(self.sizes_path)
        return self.read().select(PART, POSITION, BYTES)

    def part_offsets(self) -> DataFrame:
        """Rows and bytes before each part: one row per file or range partition, never more."""
        count = len(self.parts)
        offsets = self.spark.createDataFrame(pa.table({
            PART: pa.array([part.key for part in self.parts], pa.int64()),
            "rows_before": pa.array([0, *accumulate(part.rows for part in self.parts)][:count], pa.int64()),
            "bytes_before": pa.array([0, *accumulate(part.size for part in self.parts)][:count], pa.int64()),
        }))
        return broadcast_if_small(offsets, count * LOOKUP_ROW_BYTES)

    def indexed(self, name: str = "row_index", first: int | None = None) -> DataFrame:
        """Rows with their 1-based global position; ``first`` reads that many from the start."""
        refuse_columns(self.schema.names, (name, "rows_before", "bytes_before", *([SEGMENT] if self.segments else [])))
        index = F.col("rows_before") + F.col(POSITION) + 1
        rows = self.read() if first is None else self.read(self._parts_holding(first))
        rows = rows.join(self.part_offsets(), PART)
        if first is not None:
            rows = rows.filter(index <= first)
        piece = [F.lpad(F.col(c).cast("string"), 19, "0") for c in ("rows_before", SEGMENT)] if self.segments else []
        return rows.select(*self.data_columns(), index.alias(name), *([F.concat_ws("-", *piece).alias(SEGMENT)] if piece else []))

    def drop(self) -> None:
        """Delete the stored table and the table of its sizes."""
        for path in filter(None, (self.path, self.sizes_path)):
            drop_path(self.spark, path)

    def data_columns(self) -> list[Column]:
        return [F.col(f"`{f.name}`") for f in self.schema.fields if f.name not in (PART, POSITION, BYTES)]

    def _parts_holding(self, rows: int) -> int:
        seen = list(accumulate(part.rows for part in self.parts))
        return min(bisect_left(seen, rows) + 1, len(seen))


def _positioned(df: DataFrame) -> DataFrame:
    """A parquet scan with file and row number as part and position."""
    size = [] if BYTES in df.columns else [row_bytes(df).alias(BYTES)]
    return df.select(
        "*", F.xxhash64("_metadata.file_path").alias(PART), F.col("_metadata.row_index").alias(POSITION), *size
    )


def _file_order(path: str) -> tuple[str, int, str]:
    """Total order of files: folder, part number (part-100000 comes after part-99999), then the whole name."""
    folder, _, name = path.rpartition("/")
    number = re.match(r"part-([0-9]+)", name)
    return folder, int(number[1]) if number else -1, name


def index_stored(
    spark: SparkSession, path: str, measure_bytes: bool = False, schema: T.StructType | None = None
) -> StagedRows:
    """Index a parquet table in the order of its files and of the rows in them, without a shuffle.

    Rows per file come from the file footers alone. ``measure_bytes`` reads the columns once and
    keeps the size of every row in a narrow table of its own, unless the table has it already.
    Give ``schema`` when files lack some of the columns; those are NULL.
    """
    table = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    files = table.select(F.col("_metadata.file_path").alias("file")).groupBy("file").count()
    rows = files.withColumn("key", F.xxhash64("file")).collect()
    found = sorted(((r["file"], r["count"], r["key"]) for r in rows), key=lambda r: _file_order(r[0]))
    if len({key for _, _, key in found}) < len(found):
        raise RuntimeError("two file names share a hash; store the table again")
    sizes_path, measured = None, {}
    if measure_bytes:
        sizes = _positioned(table).select(PART, POSITION, BYTES)
        if BYTES not in table.columns:
            sizes_path = scratch_path(spark, "sizes")
            sizes.write.parquet(sizes_path)
            sizes = spark.read.schema(_SIZES).parquet(sizes_path)
        sums = sizes.groupBy(PART).agg(F.sum(BYTES).alias("size"), F.max(BYTES).alias("largest"))
        measured = {r[PART]: (r["size"], r["largest"]) for r in sums.collect()}
    parts = tuple(Part(key, rows, *measured.get(key, (0, 0)), file) for file, rows, key in found)
    return StagedRows(spark, path, table.schema, parts, stored=True, sizes_path=sizes_path)


def store(
    df: DataFrame, path: str | None = None, measure_bytes: bool = False, partitions: int | None = None
) -> StagedRows:
    """Write rows as they come, with their sizes when wanted, replacing what ``path`` held; index them.

    ``partitions`` spreads rows that come in too few pieces, such as one file or one connection.
    """
    refuse_columns(df.columns, (PART, POSITION, BYTES))
    path = path or scratch_path(df.sparkSession, "stored")
    rows = df.withColumn(BYTES, row_bytes(df)) if measure_bytes else df
    if partitions:
        rows = rows.repartition(partitions)
    rows.write.mode("overwrite").parquet(path)
    return index_stored(df.sparkSession, path, measure_bytes)


def refuse_columns(columns: list[str], reserved: tuple[str, ...]) -> None:
    """Names that an operator adds must be free."""
    taken = sorted(c for c in columns if c.lower() in reserved)
    if taken:
        raise ValueError(f"rename the columns {taken}: these names are added here")


def stage(
    df: DataFrame,
    order_by: list[str],
    path: str | None = None,
    measure_bytes: bool = False,
    partitions: int | None = None,
) -> StagedRows:
    """Write ``df`` in the order of ``order_by`` (NULLs first), replacing what ``path`` held.

    ``order_by`` should identify a row; add ``with_source_position`` columns to it when the data
    columns alone do not. Without ``path`` the table goes to the scratch folder. ``partitions``
    is for very large inputs: about input bytes / 256 MB, so that each sort stays in memory. By
    default the session's shuffle partitions are used and small ones are merged at run time.
    Measured bytes leave the source position out.
    """
    refuse_columns(df.columns, (PART, POSITION, BYTES))
    spark = df.sparkSession
    path = path or scratch_path(spark, "staging")
    size = row_bytes(df.drop(SOURCE_FILE, SOURCE_ROW)) if measure_bytes else F.lit(0).cast("long")
    keys = [F.asc_nulls_first(c) for c in order_by]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = (
        ranged
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().cast("long").alias(PART),
            F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1).alias(POSITION),
            size.alias(BYTES),
        )
    )
    placed.write.mode("overwrite").parquet(path)
    counted = (
        spark.read.schema(placed.schema).parquet(path)
        .groupBy(PART)
        .agg(F.count("*").alias("rows"), F.sum(BYTES).alias("size"), F.max(BYTES).alias("largest"))
    )
    parts = sorted((r[PART], r["rows"], r["size"], r["largest"]) for r in counted.collect())
    return StagedRows(spark, path, placed.schema, tuple(Part(*part) for part in parts))


def broadcast_if_small(df: DataFrame, size: int) -> DataFrame:
    """Broadcast a join side whose bytes are known to be few; otherwise leave the join to Spark."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
