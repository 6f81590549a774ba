"""Token ids in binary files of shuffled planes (operator 4).

A file holds the ids of consecutive documents. They are cut into chunks of ``CHUNK_IDS`` ids. A chunk is
transposed into planes: plane b of kind ``byte`` has the b-th byte of every id, plane b of kind ``bit`` the b-th
bit. Each plane is compressed on its own with zstandard; a plane of zeros takes no bytes. The chunk index at
the end says where each chunk starts and how long its planes are, so any range of ids is read by decoding
the chunks that hold it and nothing else.

Layout: magic, then planes, then the zstandard-compressed footer (chunk rows: offset, ids, plane lengths;
document rows: id is null, id, ids), then kind and lengths of the footer parts, then magic again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.llm.common import only
from parcelyard.llm.encoding import END_ID, default_vocabulary, encoder
from parcelyard.llm.files import RangeReader, fresh_name, locate, make_folder, map_files
from parcelyard.session import scratch_path

CHUNK_IDS = 1 << 17
FILE_IDS = 1 << 28
LEVEL = 3
MAGIC = b"IDPLANES"
PLANES = {"byte": 4, "bit": 32}
TAIL = struct.Struct("<4sQQQ8s")  # kind, footer offset, chunk rows, document rows, magic
MANIFEST = "part int, file string, documents long, ids long"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: bytes, kind: str) -> list[bytes]:
    """Planes of packed 32-bit little-endian ids, lowest first."""
    rows = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(rows[:, b], bitorder="little").tobytes() for b in range(32)]
    return [rows[:, b].tobytes() for b in range(4)]


def from_planes(planes: list[bytes], n: int, kind: str) -> bytes:
    """Packed ids of planes; an empty plane stands for zeros."""
    rows = np.zeros((n, PLANES[kind]), np.uint8)
    for b, plane in enumerate(planes):
        if plane:
            values = np.frombuffer(plane, np.uint8)
            rows[:, b] = np.unpackbits(values, count=n, bitorder="little") if kind == "bit" else values
    if kind == "bit":
        rows = np.packbits(rows, axis=1, bitorder="little")
    return rows.tobytes()


class PlaneWriter:
    """One file; holds at most a chunk of ids and the index in memory."""

    def __init__(self, uri: str, kind: str):
        store, path = locate(uri)
        self.uri, self.kind = uri, kind
        self._out = store.open_output_stream(path)
        self._out.write(MAGIC)
        self._at, self._buffer, self._press = len(MAGIC), bytearray(), zstandard.ZstdCompressor(level=LEVEL)
        self._chunks: list[tuple] = []
        self._documents: list[tuple] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._documents.append((doc_id is None, doc_id or 0, len(ids) // 4))
        self.ids += len(ids) // 4
        self._buffer += ids
        size = 4 * CHUNK_IDS
        if len(self._buffer) >= size:
            full = len(self._buffer) // size * size
            for k in range(0, full, size):
                self._chunk(bytes(self._buffer[k : k + size]))
            del self._buffer[:full]

    def _chunk(self, ids: bytes) -> None:
        planes = [self._press.compress(p) if p.strip(b"\0") else b"" for p in to_planes(ids, self.kind)]
        self._chunks.append((self._at, len(ids) // 4, *map(len, planes)))
        self._out.write(b"".join(planes))
        self._at += sum(map(len, planes))

    def close(self) -> tuple[str, int, int]:
        if self._buffer:
            self._chunk(bytes(self._buffer))
        rows = [np.array(part, "<i8").tobytes() for part in (self._chunks, self._documents)]
        self._out.write(self._press.compress(b"".join(rows)))
        tail = (self.kind.encode(), self._at, len(self._chunks), len(self._documents), MAGIC)
        self._out.write(TAIL.pack(*tail))
        self._out.close()
        return self.uri, len(self._documents), self.ids


class PlaneReader:
    """Index of a file, and its ids chunk by chunk or by range."""

    def __init__(self, uri: str):
        self._file = RangeReader(uri)
        tail = self._file.read(self._file.size - TAIL.size, TAIL.size)
        kind, at, chunks, documents, magic = TAIL.unpack(tail)
        if magic != MAGIC or self._file.read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is no file of id planes")
        self.kind = kind.rstrip(b"\0").decode()
        self._press = zstandard.ZstdDecompressor()
        footer = self._press.decompress(self._file.read(at, self._file.size - TAIL.size - at))
        numbers, width = np.frombuffer(footer, "<i8"), 2 + PLANES[self.kind]
        self.chunks = numbers[: chunks * width].reshape(chunks, width)
        self.documents = numbers[chunks * width :].reshape(documents, 3)
        self._first = np.concatenate([[0], np.cumsum(self.chunks[:, 1])])

    def chunk(self, k: int) -> bytes:
        at, n, *lengths = map(int, self.chunks[k])
        data, planes = self._file.read(at, sum(lengths)), []
        for length in lengths:
            planes.append(self._press.decompress(data[:length]) if length else b"")
            data = data[length:]
        return from_planes(planes, n, self.kind)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range of the file; only the chunks that hold it are read."""
        first = int(np.searchsorted(self._first, start, "right")) - 1
        last = int(np.searchsorted(self._first, stop, "left"))
        data = b"".join(self.chunk(k) for k in range(first, last)) if stop > start else b""
        base = int(self._first[first])
        return np.frombuffer(data, "<u4")[start - base : stop - base]

    def crcs(self) -> Iterator[int]:
        """CRC-32 of each document's packed ids, holding one chunk in memory."""
        k, data, at = 0, b"", 0
        for n in self.documents[:, 2]:
            need, crc = 4 * int(n), 0
            while need:
                if at == len(data):
                    data, at, k = self.chunk(k), 0, k + 1
                piece = memoryview(data)[at : at + need]
                crc, at, need = zlib.crc32(piece, crc), at + len(piece), need - len(piece)
            yield crc

    def close(self) -> None:
        self._file.close()


def write_ids(
    docs: DataFrame, folder: str, vocabulary: str | None = None, kind: str = "byte", end_id: int = END_ID
) -> list[tuple[int, str, int, int]]:
    """Encode ``docs`` (doc_id, text; more columns don't matter) and write their ids to ``folder``.

    Documents are range-partitioned by id, and equal ids by a hash of the text and the row, so that a
    repeated id spreads. NULL ids come first, NULL text counts as empty. The answer has one row per file in
    order: range partition, file, documents, ids. An empty table writes nothing.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary).packed, TaskContext.get().partitionId()
        writer, done = None, []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer = writer or PlaneWriter(fresh_name(folder, part, ".ids"), kind)
                writer.add(doc_id, encode(text.as_py(), end_id))
                if writer.ids >= FILE_IDS:
                    done, writer = [*done, writer.close()], None
        if writer:
            done.append(writer.close())
        names = ("file", "documents", "ids")
        columns = {name: [row[k] for row in done] for k, name in enumerate(names)}
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part] * len(done), pa.int32()), "file": pa.array(columns["file"], pa.string()),
             "documents": pa.array(columns["documents"], pa.int64()), "ids": pa.array(columns["ids"], pa.int64())}
        )

    spread = (
        only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
        .withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    )
    keys = [F.asc_nulls_first("doc_id"), "_tie", "_row"]
    ordered = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    path = scratch_path(spark, "id-manifest")
    ordered.mapInArrow(write, MANIFEST).write.parquet(path)
    listed = spark.read.schema(MANIFEST).parquet(path).withColumn("_at", F.monotonically_increasing_id())
    rows = listed.orderBy("part", "_at").collect()  # one row per file
    return [(r["part"], r["file"], r["documents"], r["ids"]) for r in rows]


def read_digests(spark: SparkSession, files: list[tuple[int, str, int, int]]) -> DataFrame:
    """Per document of the files: id, ids before it in all files, its ids and their CRC-32."""
    before = [0, *accumulate(row[3] for row in files)]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, start in zip(frame["file"], frame["before"]):
                reader = PlaneReader(file)
                docs = reader.documents
                starts = start + np.concatenate([[0], np.cumsum(docs[:, 2])[:-1]]).astype("int64")
                ids = pd.Series(docs[:, 1], dtype="Int64").mask(pd.Series(docs[:, 0] == 1))
                yield pd.DataFrame({
                    "doc_id": ids, "start": starts, "n_tokens": docs[:, 2],
                    "ids_crc32": np.fromiter(reader.crcs(), "int64", len(docs)),
                })
                reader.close()

    rows = [(file, start) for (_, file, _, _), start in zip(files, before)]
    return map_files(spark, rows, "file string, before long", read, DIGESTS)


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` and read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    return read_digests(spark, write_ids(docs, folder or scratch_path(spark, "ids"), **options))
