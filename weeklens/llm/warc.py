"""WARC archives of captured pages, and a two-level capture index over them.

Archives are files of gzip members, one record each. The index is a set of files of compressed blocks, each of them a run
of capture lines in the order of their reversed-host URL keys, with a directory that keeps the first key of every block.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.config import work_path
from weeklens.llm.common import written

#: Fixed value: payloads of fewer bytes are always stored whole.
LEAST_REVISIT = 1000
BLOCK_LINES = 512
FILE_BYTES = 256 << 20
# Record layout of the archive format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

_PLACED = "page_id bigint, surt string, file string, offset bigint, length bigint"
_FOUND = "key string, page_id bigint, file string, offset bigint, length bigint"
_INDEX_FILE = "first_key string, file string, size bigint, lines bigint"


def surt(url: str | None) -> str:
    """The URL with its host reversed, without scheme, a leading www, port 80/443, and fragment, in lower-case host.

    ``http://www.a.example.com/x?y#z`` becomes ``com,example,a)/x?y``. A URL that has no host is kept as it is.
    """
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        host, port, parts = "", None, None
    if not host:
        return url or ""
    host = host[4:] if host.startswith("www.") else host
    tail = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{tail}){parts.path or '/'}{query}"


@F.pandas_udf(T.StringType())
def surt_of(urls: pd.Series) -> pd.Series:
    return pd.Series([surt(u) for u in urls], dtype=object)


def _record(row: dict, payload: bytes) -> bytes:
    """One record as a gzip member."""
    revisit = row["record_type"] == "revisit"
    block = HTTP_HEAD % row["payload_bytes"] + (b"" if revisit else payload)
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:page:{row['page_id']}>",
        "WARC-Target-URI": (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<urn:page:{row['refers_to']}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of one stored record.

    Length and digest of a response are those of the bytes read; of a revisit, which has no payload, those stated.
    """
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"no archive record: {version[:40]}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rsplit(b"Content-Length: ", 1)[1])
    number = lambda name: None if (x := fields[name][len("<urn:page:") : -1]) == "None" else int(x)
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record of page {fields['WARC-Record-ID']}")
    return {
        "page_id": number("WARC-Record-ID"), "payload_bytes": stated, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To") if revisit else None,
    }


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Writer:
    """Files of one task in a shared folder. Names carry the attempt, so a task that runs again never meets old files."""

    def __init__(self, folder: str, kind: str, file_bytes: int = FILE_BYTES):
        self.most = file_bytes
        self.fs, root = _filesystem(folder)
        self.root = f"{root}/{kind}"
        self.kind, self.folder, self.out, self.at, self.count = kind, folder, None, 0, 0
        self.tag = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        self.fs.create_dir(self.root, recursive=True)

    def write(self, data: bytes, roll: bool = True) -> tuple[str, int, int]:
        if self.out is None or roll and self.at >= self.most:
            self.end()
            self.name = f"{self.kind}/{self.tag}-{self.count:04d}.gz"
            self.out, self.at, self.count = self.fs.open_output_stream(f"{self.root}/{self.name.split('/')[1]}", compression=None), 0, self.count + 1
        offset = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, offset, len(data)

    def end(self) -> None:
        """Closes the file; the next record opens another."""
        if self.out is not None:
            self.out.close()
            self.out, self.at = None, 0


class _Reader:
    """Range reads from files of a folder; the file read last stays open."""

    def __init__(self, folder: str):
        self.fs, self.root = _filesystem(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.name, self.file = name, self.fs.open_input_file(f"{self.root}/{name}")
        return self.file.read_at(length, offset)


def record_types(pages: DataFrame) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of ``LEAST_REVISIT`` bytes or more the rows with the largest page_id are responses and the others
    revisit it; a null page_id is smaller than any. If no row of the payload has an id, all are responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")}
    )
    # The groups are found on digests alone; only payloads that occur again are looked up.
    owners = (
        sized.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return sized.join(owners, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def _write_records(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    writer = _Writer(folder, "archive")
    names = [f.split()[0] for f in _PLACED.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        payloads = batch.column("payload")
        rows = batch.drop_columns(["payload"]).to_pylist()
        for row, payload in zip(rows, payloads):
            out.append((row["page_id"], surt(row["url"]), *writer.write(_record(row, payload.as_py()))))
        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], _schema(_PLACED))
    writer.end()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per page below ``folder``/archive and returns the places: page_id, surt, file, offset, length."""
    placed = record_types(pages).mapInArrow(lambda batches: _write_records(batches, folder), _PLACED)
    return written(placed, "places")


def key_of() -> Column:
    """URL key, then the page id in a fixed width, so that captures of one URL are apart and in order."""
    number = F.when(F.col("page_id").isNull(), "").otherwise(F.format_string("%020d", F.col("page_id") + F.lit(1 << 62)))
    return F.concat_ws(" ", F.regexp_replace("surt", r"\s", "+"), number)


class _IndexWriter:
    """Index files of one task: compressed blocks of lines, then the file's block directory and its length."""

    def __init__(self, folder: str, lines_a_block: int, file_bytes: int):
        self.files, self.most = _Writer(folder, "index", file_bytes), lines_a_block
        self.lines: list[str] = []
        self.blocks: list[tuple] = []
        self.first, self.count, self.name = "", 0, ""

    def add(self, key: str, entry: list) -> dict | None:
        """Takes a line; returns a finished file's row once there is one."""
        done = self.end_block() if len(self.lines) == self.most else None
        if not self.lines:
            self.first = key
        self.lines.append(f"{key}\t{json.dumps(entry)}")
        return done

    def end_block(self) -> dict | None:
        self.name, offset, length = self.files.write(zlib.compress("\n".join(self.lines).encode()))
        self.blocks.append((self.first, offset, length))
        self.count += len(self.lines)
        self.lines = []
        return self.end_file() if self.files.at >= self.files.most else None

    def end_file(self) -> dict | None:
        if self.lines:
            return self.end_block() or self.end_file()
        if not self.blocks:
            return None
        directory = zlib.compress(json.dumps(self.blocks).encode())
        self.files.write(directory + len(directory).to_bytes(8, "big"), roll=False)
        row = {"first_key": self.blocks[0][0], "file": self.name, "size": self.files.at, "lines": self.count}
        self.blocks, self.count = [], 0
        self.files.end()
        return row


def _write_index(batches: Iterator[pa.RecordBatch], folder: str, lines_a_block: int, file_bytes: int) -> Iterator[pa.RecordBatch]:
    writer = _IndexWriter(folder, lines_a_block, file_bytes)
    for batch in batches:
        done = [writer.add(r["key"], [r["page_id"], r["file"], r["offset"], r["length"]]) for r in batch.to_pylist()]
        if any(done):
            yield pa.RecordBatch.from_pylist([d for d in done if d], _schema(_INDEX_FILE))
    if last := writer.end_file():
        yield pa.RecordBatch.from_pylist([last], _schema(_INDEX_FILE))


def write_index(places: DataFrame, folder: str, lines_a_block: int = BLOCK_LINES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Sorts the captures by key over all tasks and writes them below ``folder``/index; returns a row for each index file.

    Equal keys are in one task, so they stand side by side, in one file or in files that follow one another.
    """
    ordered = places.withColumn("key", key_of()).repartitionByRange("key").sortWithinPartitions("key", "offset", "file")
    files = ordered.mapInArrow(lambda batches: _write_index(batches, folder, lines_a_block, file_bytes), _INDEX_FILE)
    return written(files, "index")


class Index:
    """Binary search in the files' first keys, then in a file's block directory, then in a block's lines."""

    def __init__(self, folder: str, files: list[tuple[str, str, int]]):
        self.reader, self.files = _Reader(folder), files
        self.firsts = [f[0] for f in files]
        self.file_at = self.block_at = None

    def _open_file(self, at: int) -> None:
        if at != self.file_at:
            _, name, size = self.files[at]
            length = int.from_bytes(self.reader.read(name, size - 8, 8), "big")
            self.blocks = json.loads(zlib.decompress(self.reader.read(name, size - 8 - length, length)))
            self.block_firsts = [b[0] for b in self.blocks]
            self.file_at, self.block_at = at, None

    def _open_block(self, at: int) -> None:
        if at != self.block_at:
            _, offset, length = self.blocks[at]
            lines = zlib.decompress(self.reader.read(self.files[self.file_at][1], offset, length)).decode().split("\n")
            pairs = [line.split("\t", 1) for line in lines]
            self.keys, self.entries = [p[0] for p in pairs], [p[1] for p in pairs]
            self.block_at = at

    def find(self, key: str) -> Iterator[list]:
        """All captures of the key: [page_id, file, offset, length] each."""
        for file in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            self._open_file(file)
            for block in range(max(0, bisect_left(self.block_firsts, key) - 1), bisect_right(self.block_firsts, key)):
                self._open_block(block)
                for i in range(bisect_left(self.keys, key), bisect_right(self.keys, key)):
                    yield json.loads(self.entries[i])


def _look_up(batches: Iterator[pa.RecordBatch], folder: str, files: list[tuple[str, str, int]]) -> Iterator[pa.RecordBatch]:
    index = Index(folder, files)
    names = ("key", "page_id", "file", "offset", "length")
    for batch in batches:
        found = [dict(zip(names, (key, *entry))) for key in batch.column("key").to_pylist() for entry in index.find(key)]
        yield pa.RecordBatch.from_pylist(found, _schema(_FOUND))


def look_up(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """The captures of each distinct ``key``: key, page_id, file, offset, length.

    Keys are sorted over all tasks, so a task reads a few neighbouring blocks once each. The list of index files, one row
    per sorting task or 256 MB, goes to the tasks; block directories are read from the files.
    """
    files = sorted((r["first_key"], r["file"], r["size"]) for r in index.select("first_key", "file", "size").collect())
    ordered = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return ordered.mapInArrow(lambda batches: _look_up(batches, folder, files), _FOUND)


_RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _fetch(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    reader = _Reader(folder)
    for batch in batches:
        rows = [parse(reader.read(r["file"], r["offset"], r["length"])) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, _schema(_RECORD))


def fetch(found: DataFrame, folder: str, task_bytes: int = 64 << 20) -> DataFrame:
    """Reads and parses the records at (file, offset, length), in the order of the archives."""
    found = written(found, "found")
    stored = found.agg(F.sum("length")).first()[0] or 0
    parts = max(found.sparkSession.sparkContext.defaultParallelism, -(-stored // task_bytes))
    ordered = found.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(lambda batches: _fetch(batches, folder), _RECORD)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archives all pages, indexes them, looks every page up and returns what its record says.

    Per row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an empty
    payload; a null or odd url is its own key; repeated rows are records of their own; other columns are not read.
    ``folder`` is shared by driver and executors; without it a new one in the session's shared folder is taken.
    """
    folder = folder or work_path(pages.sparkSession, "warc")
    places = write_archives(pages, folder)
    index = write_index(places, folder)
    keys = pages.select("page_id", surt_of("url").alias("surt")).select(key_of().alias("key"))
    return fetch(look_up(keys, index, folder), folder)
