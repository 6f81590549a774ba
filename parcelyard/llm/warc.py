"""Web archives with a two-level capture index (operator 2).

Archives are WARC 1.1 files whose records are gzip members of their own. The index lists every capture under its
reversed-host URL key: lines are range-sorted by key over the cluster, cut into blocks of ``BLOCK_LINES``, and each
block is compressed. A directory per index part, the second level, has the first key, place and length of each
block, and the list of parts has their first and last keys. A look-up binary-searches the parts, then the
part's directory, and reads only the blocks and then the record ranges that can hold the key.

Defined cases: NULL payloads are empty, NULL URLs get a ``urn:`` of the page; pages may repeat (of equal payloads,
all rows with the largest id are responses, the others refer to it); an empty table gives no files and no rows. URL
characters that a header can't hold are percent-encoded.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.llm.files import RangeReader, fresh_name, locate, make_folder, map_files
from parcelyard.session import scratch_path

MIN_REVISIT_BYTES = 1000
BLOCK_LINES = 2_000
GZIP_LEVEL = 3
DATE = "2024-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
CAPTURES = "url_key string, page_id long, file string, offset long, length long"
PARTS = "part int, file string, directory_at long, first_key string, last_key string, blocks long, lines long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query; scheme, ``www.`` and fragment don't count."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return ")" + url.strip()
    labels = ",".join(reversed(host.split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{f':{port}' if port and port not in (80, 443) else ''}){parts.path or '/'}{query}"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header_url(url: str | None, page_id: int | None) -> str:
    return quote(url.strip(), safe="!#$%&'()*+,/:;=?@[]~") if url and url.strip() else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record (HTTP headers only) when ``refers_to`` names a page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_url(url, page_id)}", f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record; lengths and digest are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    answer = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["WARC-Payload-Digest"] != f"sha1:{digest}" or len(payload) != int(answer["Content-Length"]):
            raise ValueError("payload doesn't match its digest")
    return fields, answer, payload


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``refers_to``: the largest page id with an equal payload, for other pages of ``min_bytes`` at least."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    keyed = rows.withColumns({"digest": F.sha1(payload), "size": F.octet_length(payload)})
    # Only payloads that occur again reach the join, as one row each.
    largest = (
        keyed.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    )
    other = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return (
        keyed.join(largest, ["digest", "size"], "left")
        .select("page_id", "url", "html", F.when(other, F.col("original")).alias("refers_to"))
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html, refers_to), a file per task; returns the captures."""
    spark = pages.sparkSession
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, at = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(batch.column(k) for k in range(4))):
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                if out is None:
                    uri = fresh_name(folder, TaskContext.get().partitionId(), ".warc.gz")
                    store, path = locate(uri)
                    out = store.open_output_stream(path, compression=None)
                press = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                data = press.compress(record(page_id, url, (html.as_py() or "").encode(), refers_to)) + press.flush()
                out.write(data)
                rows.append((url_key(url), page_id, uri, at, len(data)))
                at += len(data)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], CAPTURE_NAMES)
        if out is not None:
            out.close()

    path = scratch_path(spark, "captures")
    pages.select("page_id", "url", "html", "refers_to").mapInArrow(write, CAPTURES).write.parquet(path)
    return spark.read.schema(CAPTURES).parquet(path)


CAPTURE_NAMES = [field.split()[0] for field in CAPTURES.split(", ")]


@dataclass(frozen=True)
class CaptureIndex:
    """Index parts in key order: part, file, place of the directory, first and last key, blocks, lines."""

    parts: tuple[tuple, ...]


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort captures by key into compressed blocks with a sparse directory. One row per part reaches the driver."""
    spark = captures.sparkSession
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lines, directory, at, total = TaskContext.get().partitionId(), [], [], 0, 0
        out, uri, last = None, None, None

        def block() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            out.write(data)
            directory.append([lines[0][0], at, len(data)])
            at, lines = at + len(data), []

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    uri = fresh_name(folder, part, ".idx")
                    store, path = locate(uri)
                    out = store.open_output_stream(path, compression=None)
                lines.append(row)
                last, total = row[0], total + 1
                if len(lines) >= block_lines:
                    block()
        rows = []
        if out is not None:
            if lines:
                block()
            out.write(zlib.compress(json.dumps(directory).encode()))
            out.close()
            rows = [(part, uri, at, directory[0][0], last, len(directory), total)]
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*rows)) or [[]] * 7
        names = [field.split()[0] for field in PARTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    keys = ["url_key", "page_id", "file", "offset"]  # total, so that a hot host or URL spreads
    path = scratch_path(spark, "index-parts")
    captures.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(write, PARTS).write.parquet(path)
    rows = spark.read.schema(PARTS).parquet(path).orderBy("part").collect()
    return CaptureIndex(tuple(tuple(r) for r in rows))


class IndexPart:
    """One index file: its directory in memory, blocks read when asked for."""

    def __init__(self, uri: str, directory_at: int):
        self._file = RangeReader(uri)
        raw = self._file.read(directory_at, self._file.size - directory_at)
        self.directory = json.loads(zlib.decompress(raw))
        self._firsts = [entry[0] for entry in self.directory]

    def block(self, k: int) -> list[list]:
        _, at, length = self.directory[k]
        return [json.loads(line) for line in zlib.decompress(self._file.read(at, length)).split(b"\n")]

    def find(self, key: str) -> Iterator[list]:
        """Lines of a key; blocks are chosen by binary search."""
        first = max(0, bisect.bisect_left(self._firsts, key) - 1)
        for k in range(first, bisect.bisect_right(self._firsts, key)):
            for line in self.block(k):
                if line[0] == key:
                    yield line

    def lines(self) -> Iterator[list]:
        for k in range(len(self.directory)):
            yield from self.block(k)

    def close(self) -> None:
        self._file.close()


def read_record(reader: RangeReader, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    return parse(zlib.decompress(reader.read(offset, length), 31))


def _facts(fields: dict[str, str], answer: dict[str, str]) -> tuple:
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return number("X-Page-Id"), int(answer["Content-Length"]), digest, fields["WARC-Type"], number("X-Refers-To-Page-Id")


def indexed_captures(spark: SparkSession, index: CaptureIndex) -> DataFrame:
    """All index lines, read block by block, a part per task."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, at in zip(frame["file"], frame["directory_at"]):
                part = IndexPart(file, at)
                for k in range(len(part.directory)):
                    rows = pd.DataFrame(part.block(k), columns=CAPTURE_NAMES)
                    yield rows.astype({"page_id": "Int64"})
                part.close()

    rows = [part[1:3] for part in index.parts]
    return map_files(spark, rows, "file string, directory_at long", read, CAPTURES)


def read_captures(captures: DataFrame) -> DataFrame:
    """Facts of the records that ``captures`` (file, offset, length) name, by range reads in file order."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, reader = None, None
        for frame in frames:
            rows = []
            for file, offset, length in zip(frame["file"], frame["offset"], frame["length"]):
                if file != name:
                    if reader:
                        reader.close()
                    name, reader = file, RangeReader(file)
                rows.append(_facts(*read_record(reader, offset, length)[:2]))
            out = pd.DataFrame(rows, columns=[field.split()[0] for field in RECORDS.split(", ")])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    places = captures.select("file", "offset", "length")
    return places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(read, RECORDS)


def look_up(urls: DataFrame, index: CaptureIndex) -> DataFrame:
    """Captures of each distinct ``url``: url and the index line. Binary search in parts, directory, block."""
    parts = index.parts
    firsts, lasts = [p[3] for p in parts], [p[4] for p in parts]

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, part = None, None
        for frame in frames:
            rows = []
            for url in frame["url"]:
                key = url_key(url)
                for k in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)):
                    if k != at:
                        at, part = k, IndexPart(parts[k][1], parts[k][2])
                    rows += [(url, *line) for line in part.find(key)]
            yield pd.DataFrame(rows, columns=["url", *CAPTURE_NAMES]).astype({"page_id": "Int64"})

    return urls.select("url").distinct().mapInPandas(search, f"url string, {CAPTURES}")


def archive(pages: DataFrame, folder: str | None = None) -> tuple[CaptureIndex, DataFrame]:
    """Write ``pages`` (page_id, url, html) as archives with their index: the index, and the captures."""
    folder = folder or scratch_path(pages.sparkSession, "archives")
    captures = write_archives(with_revisits(pages), f"{folder}/warc")
    return build_index(captures, f"{folder}/index"), captures


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` and read every record back through the index."""
    spark = pages.sparkSession
    index, _ = archive(pages, folder)
    return read_captures(indexed_captures(spark, index))
