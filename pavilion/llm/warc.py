"""WARC archives as a data source: ``spark.read.format("warc")`` and ``.write``.

Writing gives one compressed member per record, with its length in the member's
header. Reading plans file groups of bounded size, inflates the head of a record
first, and goes to the next member without touching the rest if the predicates on
record type and header fields rule it out, or if no payload is asked for.

Files are reached through ``pyarrow.fs``, so local paths and the stores that it
knows will do. A write lists its files in a manifest at the end, and a reader
follows manifests where there are any; files of failed tasks are never read.
"""

from __future__ import annotations

import datetime
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from pavilion.llm import workers
from pavilion.llm.storage import new_folder, stored

# Header fields that are columns, by column name. Fixed values of the format.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
}
SCHEMA = ", ".join(f"{name} string" for name in FIELDS) + (
    ", content_length long, headers map<string,string>, payload binary"
)
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 128 << 20
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
MIN_REVISIT_BYTES = 100
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


# ---- records -------------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split()) if any(c in value for c in "\r\n\t") else value.strip()


def record_bytes(fields: dict[str, str], block: bytes) -> bytes:
    lines = [f"{name}: {_clean(value)}" for name, value in fields.items() if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A gzip member whose header tells its own length (field ``sl``)."""
    press = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = press.compress(record) + press.flush()
    extra = 12
    size = 10 + 2 + extra + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", extra, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _member_length(head: bytes) -> int | None:
    """The length a gzip member tells about itself."""
    if len(head) < 12 or not head[3] & 4:
        return None
    (extra,) = struct.unpack_from("<H", head, 10)
    at, end = 12, min(len(head), 12 + extra)
    while at + 4 <= end:
        name, size = struct.unpack_from("<2sH", head, at)
        if name == b"sl" and size >= 4 and at + 8 <= end:
            return struct.unpack_from("<I", head, at + 4)[0] or None
        at += 4 + size
    return None


@dataclass
class _Head:
    fields: dict[str, str]
    length: int
    size: int


def _parsed(text: bytes) -> _Head | None:
    """The head of a record, once it is there as a whole."""
    end = text.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = text[:end].decode("utf-8", errors="replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip()] = value.strip()
    length = next((int(v) for n, v in fields.items() if n.lower() == "content-length"), 0)
    return _Head(fields, length, end + 4)


_STEP = 1 << 14


class _Gzip:
    """Records of a file of gzip members."""

    def __init__(self, file):
        self.file, self.at, self.size = file, 0, file.size()

    def records(self, wanted) -> Iterator[tuple[_Head, bytes | None]]:
        while self.at < self.size:
            self.file.seek(self.at)
            first = self.file.read(_STEP)
            length = _member_length(first)
            inflate = zlib.decompressobj(31)
            text, raw, read = b"", first, len(first)
            head = None
            while head is None and not inflate.eof:
                text += inflate.decompress(raw, _STEP)
                raw = inflate.unconsumed_tail
                head = _parsed(text)
                if head is None and not raw and not inflate.eof:
                    raw = self.file.read(_STEP)
                    read += len(raw)
                    if not raw:
                        raise ValueError("a record breaks off")
            if head is None:
                raise ValueError("a member holds no record")
            need = wanted(head)
            if not need and length:
                self.at += length
                yield head, None
                continue
            parts = [text]
            while not inflate.eof:
                part = inflate.decompress(raw, 1 << 20)
                raw = inflate.unconsumed_tail
                if need:
                    parts.append(part)
                if not raw and not inflate.eof:
                    raw = self.file.read(1 << 16)
                    read += len(raw)
                    if not raw:
                        raise ValueError("a record breaks off")
            self.at += read - len(inflate.unused_data)
            yield head, b"".join(parts)[head.size : head.size + head.length] if need else None


class _Plain:
    """Records of a file without compression."""

    def __init__(self, file):
        self.file, self.at, self.size = file, 0, file.size()

    def records(self, wanted) -> Iterator[tuple[_Head, bytes | None]]:
        while self.at < self.size:
            self.file.seek(self.at)
            text, head = b"", None
            while head is None:
                part = self.file.read(_STEP)
                if not part:
                    if not text.strip():
                        return
                    raise ValueError("a record breaks off")
                text += part
                head = _parsed(text)
            block = None
            if wanted(head):
                self.file.seek(self.at + head.size)
                block = self.file.read(head.length)
            self.at += head.size + head.length + 4
            yield head, block


def payload_of(head: _Head, block: bytes) -> bytes:
    """The block without its HTTP head, if it has one."""
    kind = next((v for n, v in head.fields.items() if n.lower() == "content-type"), "")
    if kind.startswith("application/http"):
        _, split, body = block.partition(b"\r\n\r\n")
        return body if split else b""
    return block


# ---- the data source -------------------------------------------------------------


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def _files(path: str) -> list[tuple[str, int]]:
    store, root = _store(path)
    found = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    manifests = [i.path for i in found if i.base_name.startswith("_manifest-")]
    names: set[str] | None = None
    if manifests:
        names = set()
        for manifest in manifests:
            with store.open_input_stream(manifest) as file:
                names.update(json.loads(file.read()))
    return sorted(
        (i.path, i.size)
        for i in found
        if i.is_file and i.base_name.endswith((".warc", ".warc.gz")) and (names is None or i.base_name in names)
    )


@dataclass
class _FileGroup(InputPartition):
    paths: list[str] = field(default_factory=list)


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.tests = path, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            name = getattr(one, "attribute", ())
            if len(name) == 1 and name[0] in FIELDS and isinstance(
                one, (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith)
            ):
                kind = type(one).__name__
                self.tests.append((kind, FIELDS[name[0]].lower(), getattr(one, "value", None)))
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        groups, size = [_FileGroup()], 0
        for path, length in _files(self.path):
            if groups[-1].paths and size + length > PARTITION_BYTES:
                groups.append(_FileGroup())
                size = 0
            groups[-1].paths.append(path)
            size += length
        return groups

    def _passes(self, fields: dict[str, str]) -> bool:
        for kind, name, value in self.tests:
            own = fields.get(name)
            if kind == "In" and own not in value:
                return False
            if kind in ("EqualTo", "EqualNullSafe") and own != value:
                return False
            if own is None and kind != "EqualNullSafe":
                return False
            if kind == "StringStartsWith" and not own.startswith(value):
                return False
        return True

    def read(self, partition: _FileGroup) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        names = self.schema.fieldNames()
        kinds = pa.schema(
            [
                (n, pa.int64() if n == "content_length" else pa.binary() if n == "payload" else pa.string())
                if n != "headers"
                else (n, pa.map_(pa.string(), pa.string()))
                for n in names
            ]
        )
        rows: list[dict] = []
        size = 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                records = (_Gzip if path.endswith(".gz") else _Plain)(file)

                def wanted(head: _Head) -> bool:
                    return "payload" in names and self._passes({n.lower(): v for n, v in head.fields.items()})

                for head, block in records.records(wanted):
                    fields = {n.lower(): v for n, v in head.fields.items()}
                    if not self._passes(fields):
                        continue
                    row: dict = {n: fields.get(FIELDS[n].lower()) for n in names if n in FIELDS}
                    if "content_length" in names:
                        row["content_length"] = head.length
                    if "headers" in names:
                        row["headers"] = list(head.fields.items())
                    if "payload" in names:
                        row["payload"] = payload_of(head, block)
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size > FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": row["date"]}
                        info["Content-Type"] = "application/warc-fields"
                        size = out.write(member(record_bytes(info, b"format: WARC File Format 1.1\r\n"))) or 0
                    data = member(_written(row))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        old = store.get_file_info(pafs.FileSelector(root)) if self.overwrite else []
        names = [n for m in messages if m for n in m.names]
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as file:
            file.write(json.dumps(names).encode())
        gone = [i for i in old if i.is_file and i.base_name not in set(names)]
        for info in sorted(gone, key=lambda i: not i.base_name.startswith("_manifest-")):
            store.delete_file(info.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _store(self.path)
        for name in (n for m in messages if m for n in m.names):
            if store.get_file_info(f"{root}/{name}").is_file:
                store.delete_file(f"{root}/{name}")


def _written(row: dict) -> bytes:
    """The record of one row of the data source."""
    payload = row["payload"] or b""
    fields = {FIELDS[n]: row[n] for n in FIELDS if row.get(n) is not None}
    fields |= {n: v for n, v in (row["headers"] or []) if v is not None}
    kind = row["record_type"]
    block = payload
    if kind in ("response", "revisit"):
        fields["Content-Type"] = "application/http; msgtype=response"
        block = _HTTP % len(payload) + payload
    return record_bytes(fields, block)


class WarcDataSource(DataSource):
    """Rows are records: the columns of ``SCHEMA``, or those of the schema given."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        unknown = [n for n in schema.fieldNames() if n not in (*FIELDS, "content_length", "headers", "payload")]
        if unknown:
            raise ValueError(f"a WARC record has no {', '.join(unknown)}")
        return _Reader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it push predicates down.

    The setting concerns data sources written in Python alone.
    """
    workers.ship_code(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The records below ``path``; without ``payload`` among ``columns`` only heads are read."""
    register(spark)
    kinds = dict(part.strip().split(" ", 1) for part in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("warc").schema(schema).load(path)


# ---- pages -----------------------------------------------------------------------

_ROW_ID, _ROW_REFERS_TO, _PAYLOAD_LENGTH = "X-Row-ID", "X-Refers-To-Row-ID", "X-Payload-Length"


def _record_id(row_id: Column, digest: Column) -> Column:
    """A record id that a rerun gives again."""
    name = F.sha2(F.concat_ws("/", F.coalesce(row_id.cast("string"), F.lit("none")), digest), 256)
    dashed = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def page_records(pages: DataFrame, id_column: str, url_column: str, payload_column: str, date: str) -> DataFrame:
    """A record per row: of equal payloads, that with the smallest id is a response.

    The others revisit it and are written without payload, unless the payload is
    shorter than ``MIN_REVISIT_BYTES``. A null payload is empty. Rows that repeat
    an id and its payload are alike; a null id comes after all others.
    """
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("binary"), F.lit(b""))
    known = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    size = F.octet_length("payload")
    groups = known.where(size >= MIN_REVISIT_BYTES).groupBy("digest")
    firsts = groups.agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    # Stored, so that both sides are shuffled for the join alone and a payload that
    # very many pages share can be split.
    rows = known.join(stored(firsts.drop("rows"), "firsts"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    headers = F.map_from_arrays(
        F.array(F.lit(_ROW_ID), F.lit(_ROW_REFERS_TO), F.lit(_PAYLOAD_LENGTH)),
        F.array(F.col("id").cast("string"), F.when(again, F.col("first").cast("string")), size.cast("string")),
    )
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("id"), F.col("digest")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, _record_id(F.col("first"), F.col("digest"))).alias("refers_to"),
        F.when(again, SAME_PAYLOAD).alias("profile"),
        F.lit(None).cast("long").alias("content_length"),
        headers.alias("headers"),
        F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )


def write_pages(
    pages: DataFrame,
    path: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> str:
    """Write ``pages`` as WARC files into ``path``, by default a new shared folder. Returns it."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    register(spark)
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    records = page_records(pages, id_column, url_column, payload_column, date)
    records.write.format("warc").mode("append").save(path)
    return path


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` of written pages.

    Payloads of responses are read and measured; of revisits only the head is read,
    which has the length and digest of the payload that they stand for.
    """
    columns = ("record_type", "payload_digest", "headers")
    header = lambda name: F.col("headers")[name]
    answers = read(spark, path, *columns, "payload").where("record_type = 'response'")
    answers = answers.select(
        header(_ROW_ID).alias("id"), "record_type", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), F.lit(None).cast("string").alias("refers_to"),
    )
    again = read(spark, path, *columns).where("record_type = 'revisit'")
    again = again.select(
        header(_ROW_ID).alias("id"), "record_type", header(_PAYLOAD_LENGTH).cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), header(_ROW_REFERS_TO).alias("refers_to"),
    )
    return answers.unionAll(again)
