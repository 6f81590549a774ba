"""Continuing capped split: outputs rotate at the threshold while data keeps arriving.

Rows are written once, where they stay, in the batch's order. What places them is a *range log*: per file of a batch the
global number of its first row, taken from the file footers after the write. A row's number is that plus its place in
its file, and its split follows by arithmetic, so no row is moved or written again when an output is full. The
log of a batch is written last. Readers take files through the log only: the data of a batch that died before its log is
not seen, and a batch that is tried again replaces its own files and log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from parcelyard.operators.split import SPLIT
from parcelyard.operators.staging import LOOKUP_ROW_BYTES, broadcast_if_small, index_stored

_RANGES = "file string, file_first long, first_row long, end_row long, threshold long"
_OFFSETS = f"{_RANGES}, batch_id long"


def _rows_before(spark: SparkSession, offsets: str, batch_id: int) -> int:
    """Rows delivered by the batches before this one; what a failed try of it left is not counted.

    The previous batch normally tells; all batches are looked at only where it left no offset. A later
    batch without any earlier offset is an error: numbering from the start would mix with what is there.
    """
    for path in (f"{offsets}/batch_id={batch_id - 1}", offsets):
        try:
            done = spark.read.schema(_OFFSETS).option("basePath", offsets).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        end = done.filter(F.col("batch_id") < batch_id).agg(F.max("end_row")).first()[0]
        if end is not None:
            return end
    if batch_id > 0:
        raise RuntimeError(f"batch {batch_id} finds no offsets of earlier batches in {offsets}")
    return 0


def write_batch(batch: DataFrame, batch_id: int, output: str, threshold: int, order_by: list[str] | None) -> None:
    """Continue the numbering with one batch, in key order or, without a key, as rows arrive.

    Rows go to ``data/batch_id=N`` in overwrite mode, once; the batch's range log is written after them, so a batch that
    is tried again writes the same rows to the same place. One row per file reaches the driver.
    """
    spark = batch.sparkSession
    before = _rows_before(spark, f"{output}/offsets", batch_id)
    data = f"{output}/data/batch_id={batch_id}"
    rows = batch
    if order_by:
        keys = [F.asc_nulls_first(c) for c in order_by]
        rows = batch.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").parquet(data)
    ranges, first = [], before
    for part in index_stored(spark, data, schema=batch.schema).parts:
        ranges.append((part.file.rsplit("/", 1)[1], first))
        first += part.rows
    _write_offset(spark, f"{output}/offsets/batch_id={batch_id}", [(f, n, before, first, threshold) for f, n in ranges])


def _write_offset(spark: SparkSession, path: str, ranges: list[tuple]) -> None:
    spark.createDataFrame(ranges, _RANGES).coalesce(1).write.mode("overwrite").parquet(path)


def start_capped_stream(
    stream: DataFrame, output: str, checkpoint: str, threshold: int, order_by: list[str] | None = None
):
    """Deliver what is available now and stop; a later start with the same checkpoint goes on."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, output, threshold, order_by))
        .start()
    )


def read_stream_output(spark: SparkSession, output: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of finished batches with ``batch_id`` and ``split_id``; files that no log names give no row."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    log = spark.read.schema(_OFFSETS).parquet(f"{output}/offsets").select(
        F.col("file").alias("_file"), F.col("file_first").alias("_first"), F.col("threshold").alias("_threshold")
    )
    log = broadcast_if_small(log, log.count() * 4 * LOOKUP_ROW_BYTES)
    rows = reader.parquet(f"{output}/data").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    return (
        rows.join(log, "_file").withColumn(SPLIT, F.expr("int((_first + _row) div _threshold + 1)"))
        .drop("_file", "_first", "_row", "_threshold")
    )
