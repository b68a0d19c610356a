"""WARC archives as a Spark data source written in Python, and an archive job that stores equal payloads once.

*Reading* (``spark.read.format("marquee_warc")``, or ``read_archives``):

1. file partitions are planned on the driver from the manifests of the folder: byte ranges that begin at a
   record, with the record types inside.  Files without a manifest (``*.warc``, ``*.warc.gz``) are one range each;
   small ranges share a partition;
2. predicates on the header columns are pushed into the reader; a predicate on ``record_type`` also drops
   ranges that hold no such record;
3. of each record only the headers are parsed first (of a gzip member, only its first bytes are inflated);
4. the payload of a record that isn't wanted is never decoded: the reader seeks to the next record, by the
   content length, or in gzip by the member's ``sl`` (skip length) field; members without that field are
   inflated and thrown away.  ``payload=false`` leaves the column out and skips all payloads.

*Writing* (``.write.format("marquee_warc")``): each task writes files of its own under fresh names; only the
driver's commit, one manifest naming them, makes them part of the folder, so what lost or repeated tasks leave
behind is never read.

Files are opened with ``pyarrow.fs``: paths without a scheme, ``file:``, ``hdfs:``, ``s3:``, ``gs:``.

Defined results: a NULL payload of a response is an empty one; a revisit has no payload (NULL); NULL headers are
left out and read as NULL; control characters in header values are percent-encoded; an empty table gives an
empty folder that reads as no rows; a record cut off at the end of a file is an error.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not,
                                    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from marquee.llm.common import written
from marquee.session import scratch_path

FORMAT = "marquee_warc"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
#: Column -> header of the record.
NAMED = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "record_date": "WARC-Date",
         "content_type": "Content-Type", "content_length": "Content-Length", "payload_digest": "WARC-Payload-Digest",
         "refers_to": "WARC-Refers-To"}
COLUMNS = ", ".join(f"{c} {'long' if c == 'content_length' else 'string'}" for c in NAMED) + ", headers map<string,string>"
PAYLOAD_LENGTH = "X-Payload-Length"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digests that hold over 1 / HOT of the duplicate rows are joined apart; there are at most HOT of them.
HOT = 1000
SMALLEST_SHARED = 100

_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_MANIFEST = "_manifest-"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


# Writing ---------------------------------------------------------------------

def _clean(value: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(headers: dict[str, str | None], payload: bytes | None) -> bytes:
    """One record; a response's payload stands behind an HTTP header."""
    if headers.get("WARC-Type") == "revisit":
        block, kind = b"", None
    elif headers.get("WARC-Type") == "response":
        payload = payload or b""
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        kind = "application/http; msgtype=response"
    else:
        block, kind = payload or b"", None
    lines = ["WARC/1.1", *(f"{k}: {_clean(v)}" for k, v in headers.items() if v is not None and k != "Content-Length")]
    if kind and headers.get("Content-Type") is None:
        lines.append(f"Content-Type: {kind}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 6) -> bytes:
    """One gzip member with its own and the record's length in the ``sl`` extra field (zeros if over 4 GiB)."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = squeeze.compress(record) + squeeze.flush()
    whole = 24 + len(body) + 8
    sizes = (whole, len(record)) if max(whole, len(record)) < 1 << 32 else (0, 0)
    return (b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *sizes)
            + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


@dataclass
class _Written(WriterCommitMessage):
    files: list[dict]


class _WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.level = int(options.get("level", 6))
        self.file_bytes = int(options.get("file_bytes", 1 << 30))
        self.range_bytes = int(options.get("range_bytes", 8 << 20))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        files: list[dict] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in _rows(batch):
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}"
                        out, size = store.open_output_stream(f"{folder}/{name}", compression=None), 0
                        files.append({"file": name, "ranges": []})
                    headers = {h: row.get(c) for c, h in NAMED.items()} | dict(row.get("headers") or ())
                    headers["WARC-Date"] = headers["WARC-Date"] or self.date
                    headers["WARC-Record-ID"] = headers["WARC-Record-ID"] or f"<urn:uuid:{uuid.uuid4()}>"
                    record = record_bytes(headers, row.get("payload"))
                    record = gzip_member(record, self.level) if self.gzip else record
                    ranges = files[-1]["ranges"]
                    if not ranges or size - ranges[-1]["start"] >= self.range_bytes:
                        ranges.append({"start": size, "end": size, "types": []})
                    out.write(record)
                    size += len(record)
                    ranges[-1]["end"] = size
                    if headers["WARC-Type"] not in ranges[-1]["types"]:
                        ranges[-1]["types"].append(headers["WARC-Type"])
                    if size >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        old = [i.path for i in store.get_file_info(pafs.FileSelector(folder)) if i.is_file] if self.overwrite else []
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/{_MANIFEST}{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps(files).encode())
        new = {f"{folder}/{f['file']}" for f in files}
        for p in old:  # manifests first: a reader never sees one whose files are gone
            if p.rpartition("/")[2].startswith(_MANIFEST):
                store.delete_file(p)
        for p in old:
            if p not in new and re.search(r"\.warc(\.gz)?$", p):
                store.delete_file(p)

    def abort(self, messages: list) -> None:
        store, folder = _open(self.path)
        for m in messages:
            for f in (m.files if m is not None else []):
                store.delete_file(f"{folder}/{f['file']}")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one after the other: a long payload isn't held twice for a whole batch."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}


# Reading ---------------------------------------------------------------------

class _Records:
    """The records of a byte range: headers first, the block only when asked for."""

    CHUNK = 1 << 16

    def __init__(self, source: pa.NativeFile, zipped: bool, start: int, end: int):
        self.source, self.zipped, self.at, self.end = source, zipped, start, end
        self.base, self.buffer = start, b""
        self.decoded = 0  # bytes inflated or read for payloads (tests look at it)

    def _get(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at`` (fewer at the end of the file)."""
        lo = at - self.base
        if lo < 0 or lo + n > len(self.buffer):
            self.source.seek(at)
            self.base, self.buffer, lo = at, self.source.read(max(n, self.CHUNK)), 0
        return self.buffer[lo:lo + n]

    def __iter__(self) -> Iterator[tuple[dict[str, str], "_Block"]]:
        while self.at < self.end:
            block = _Gzip(self) if self.zipped else _Plain(self)
            if block.headers is None:
                return
            yield block.headers, block
            self.at = block.next()


class _Plain:
    """A record of an uncompressed archive."""

    def __init__(self, records: _Records):
        self.r, size = records, 4096
        while True:
            head = records._get(records.at, size)
            pad = len(head) - len(head.lstrip(b"\r\n"))
            stop = head.find(b"\r\n\r\n", pad)
            if stop >= 0:
                break
            if len(head) < size:
                if head.strip(b"\r\n"):
                    raise ValueError(f"a record is cut off at byte {records.at}")
                self.headers = None
                return
            size *= 4
        self.headers = parse_headers(head[pad:stop])
        self.begin = records.at + stop + 4
        self.length = int(self.headers.get("content-length", 0))

    def read(self) -> bytes:
        data = self.r._get(self.begin, self.length)
        if len(data) < self.length:
            raise ValueError(f"a record is cut off at byte {self.r.at}")
        self.r.decoded += self.length
        return data

    def next(self) -> int:
        return self.begin + self.length + 4


class _Gzip:
    """A record that is one gzip member: inflated as far as it is needed."""

    def __init__(self, records: _Records):
        self.r = records
        self.skip = 0
        head = records._get(records.at, 10)
        if not head:
            self.headers = None
            return
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {records.at}")
        if head[3] & 4:
            extra = records._get(records.at + 12, struct.unpack("<H", records._get(records.at + 10, 2))[0])
            at = 0
            while at + 4 <= len(extra):
                n = struct.unpack("<H", extra[at + 2:at + 4])[0]
                if extra[at:at + 2] == b"sl" and n == 8:
                    self.skip = struct.unpack("<I", extra[at + 4:at + 8])[0]
                at += 4 + n
        self.inflate, self.fed, self.text = zlib.decompressobj(zlib.MAX_WBITS | 16), records.at, b""
        while (stop := self.text.find(b"\r\n\r\n")) < 0:
            if not self._more(2048):
                raise ValueError(f"a record is cut off at byte {records.at}")
        self.headers = parse_headers(self.text[:stop].lstrip(b"\r\n"))
        self.begin, self.length = stop + 4, int(self.headers.get("content-length", 0))

    def _more(self, most: int) -> bool:
        """Inflate up to ``most`` bytes more."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail
        if not data:
            data = self.r._get(self.fed, min(self.r.CHUNK, 8192 if most <= 8192 else self.r.CHUNK))
            self.fed += len(data)
            if not data:
                return False
        self.text += self.inflate.decompress(data, most)
        return True

    def read(self) -> bytes:
        parts = [self.text[self.begin:]]
        have = len(parts[0])
        while have < self.length:
            self.text = b""
            if not self._more(self.length - have):
                raise ValueError(f"a record is cut off at byte {self.r.at}")
            parts.append(self.text)
            have += len(self.text)
        self.r.decoded += self.length
        return b"".join(parts)[:self.length]

    def next(self) -> int:
        if self.skip:
            return self.r.at + self.skip
        while not self.inflate.eof:
            self.text = b""
            if not self._more(1 << 20):
                raise ValueError(f"a record is cut off at byte {self.r.at}")
        return self.fed - len(self.inflate.unused_data)


def parse_headers(head: bytes) -> dict[str, str]:
    """Header lines (names in lower case; folded lines joined); the first line is the version."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record begins here: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def payload_of(headers: dict[str, str], block: bytes) -> bytes | None:
    """The body of an HTTP message (chunks joined), else the block; a revisit has none."""
    if headers.get("warc-type") == "revisit":
        return None
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return block
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return b""
    if not re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head):
        return body
    parts, at = [], 0
    while (stop := body.find(b"\r\n", at)) >= 0:
        try:
            n = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return body  # not chunked after all
        if n == 0:
            break
        parts.append(body[stop + 2:stop + 2 + n])
        at = stop + 2 + n + 2
    return b"".join(parts)


def _value(headers: dict[str, str], column: str) -> str | int | None:
    v = headers.get(NAMED[column].lower())
    return int(v) if v is not None and column == "content_length" else v


def holds(condition, headers: dict[str, str]) -> bool | None:
    """A pushed predicate over the headers, in SQL's three values."""
    if isinstance(condition, Not):
        x = holds(condition.child, headers)
        return None if x is None else not x
    v = _value(headers, condition.attribute[0])
    if isinstance(condition, IsNull):
        return v is None
    if isinstance(condition, IsNotNull):
        return v is not None
    if isinstance(condition, EqualNullSafe):
        return v == condition.value
    if v is None:
        return None
    if isinstance(condition, In):
        return True if v in condition.value else (None if None in condition.value else False)
    return _COMPARE[type(condition)](v, condition.value)


_COMPARE = {
    EqualTo: lambda v, x: v == x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
}
#: Python compares texts by code points and Spark by their UTF-8 bytes: the same order.
_KNOWN = (*_COMPARE, IsNull, IsNotNull, EqualNullSafe, In)


def can_push(condition) -> bool:
    if isinstance(condition, Not):
        return can_push(condition.child)
    if not isinstance(condition, _KNOWN) or len(condition.attribute) != 1 or condition.attribute[0] not in NAMED:
        return False
    return not (type(condition) in _COMPARE and condition.value is None)


class _WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        self.pushed: list = []

    def pushFilters(self, filters: list):
        for f in filters:
            if can_push(f):
                self.pushed.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        types = [{f.value} if isinstance(f, EqualTo) else set(f.value) for f in self.pushed
                 if isinstance(f, (EqualTo, In)) and f.attribute == ("record_type",)]
        ranges = [(f, lo, hi) for f, lo, hi, held in self._ranges()
                  if hi > lo and (held is None or all(t & set(held) for t in types))]
        out: list[InputPartition] = []
        group: list[tuple[str, int, int]] = []
        size = 0
        for r in ranges:
            if group and size + r[2] - r[1] > self.partition_bytes:
                out.append(InputPartition(group))
                group, size = [], 0
            group.append(r)
            size += r[2] - r[1]
        return [*out, InputPartition(group)] if group or not out else out

    def _ranges(self) -> Iterator[tuple[str, int, int, list[str] | None]]:
        store, path = _open(self.path)
        info = store.get_file_info(path)
        if info.is_file:
            yield path, 0, info.size, None
            return
        found = sorted(store.get_file_info(pafs.FileSelector(path, recursive=True)), key=lambda i: i.path)
        manifests = [i.path for i in found if i.is_file and i.path.rpartition("/")[2].startswith(_MANIFEST)]
        for m in manifests:
            with store.open_input_file(m) as f:
                for x in json.loads(f.read()):
                    for r in x["ranges"]:
                        yield f"{m.rpartition('/')[0]}/{x['file']}", r["start"], r["end"], r["types"]
        if not manifests:
            for i in found:
                if i.is_file and re.search(r"\.warc(\.gz)?$", i.path):
                    yield i.path, 0, i.size, None

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        rows: list[tuple] = []
        size = 0
        for file, start, end in partition.value or ():
            with store.open_input_file(file) as source:
                for headers, block in _Records(source, file.endswith(".gz"), start, end):
                    if not all(holds(f, headers) for f in self.pushed):
                        continue
                    row = [_value(headers, c) for c in NAMED] + [list(headers.items())]
                    if self.payload:
                        row.append(payload_of(headers, block.read()) if headers.get("warc-type") != "revisit" else None)
                        size += len(row[-1] or b"")
                    rows.append(tuple(row))
                    if len(rows) >= 4096 or size >= 8 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64() if c == "content_length" else pa.string() for c in NAMED] + [pa.map_(pa.string(), pa.string())]
        names = [*NAMED, "headers"]
        if self.payload:
            kinds, names = [*kinds, pa.binary()], [*names, "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)


class WarcDataSource(DataSource):
    """``marquee_warc``.  Options: ``path``; reading: ``payload`` (true), ``partition_bytes``; writing: ``compression``
    (gzip or none), ``level``, ``file_bytes``, ``range_bytes``, ``date``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS + (", payload binary" if self.options.get("payload", "true").lower() == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return _WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark push filters into Python data sources."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN_CONF, "true")


def read_archives(spark: SparkSession, path: str, payload: bool = True, **options: str) -> DataFrame:
    """The records below ``path``: header columns, all headers (names in lower case), the payload if asked for."""
    register(spark)
    return spark.read.format(FORMAT).options(payload=str(payload).lower(), **options).load(path)


def write_archives(records: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Write records (the columns of ``read_archives`` that are there; others are ignored)."""
    register(records.sparkSession)
    names = [c for c in (*NAMED, "headers", "payload") if c in records.columns]
    records.select(*names).write.format(FORMAT).mode(mode).options(path=path, **options).save()


# The archive job -------------------------------------------------------------

def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 smallest: int = SMALLEST_SHARED) -> DataFrame:
    """A record per page; of equal payloads of ``smallest`` bytes or more, the smallest id is kept, the others revisit it.

    A NULL html is an empty payload.  Rows that repeat the smallest id with the same payload are responses too; a
    row with a NULL id revisits if any row of its group has an id, and names no page itself.  Digests are grouped
    with map-side minima; those that hold over 1 / ``HOT`` of the repeated rows (at most ``HOT`` of them) are joined as a
    broadcast, so no task gets all rows of a common payload; the others by a shuffle, whose rows that can't match
    are dealt by their own id.
    """
    rows = pages.select(F.col(page_id).alias("_id"), F.col(url).cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"_digest": F.sha2("payload", 256), "_bytes": F.octet_length("payload").cast("long")})
    shared = written(rows.where(F.col("_bytes") >= smallest).groupBy("_digest")
                     .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "warc-shared")
    total = shared.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col("_n") * HOT > total
    hot = shared.where(is_hot).select("_digest", F.struct("_first").alias("_hot"))
    cold = shared.where(~is_hot).select(F.col("_digest").alias("_key"), F.struct("_first").alias("_cold"))
    rows = rows.join(F.broadcast(hot), "_digest", "left")
    alone = F.col("_hot").isNotNull() | (F.col("_bytes") < smallest)
    repeats = F.col("_hot._first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_hot._first"))
    rows = rows.withColumns({
        "payload": F.when(~repeats, F.col("payload")),
        "_key": F.when(alone, F.concat(F.lit("#"), F.coalesce(F.col("_id").cast("string"), "target_uri", F.lit("")))).otherwise(F.col("_digest"))})
    rows = rows.join(cold.hint("merge"), "_key", "left")
    first = F.coalesce(F.col("_hot._first"), F.col("_cold._first"))
    revisit = first.isNotNull() & ~F.col("_id").eqNullSafe(first)
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return rows.select(
        urn(F.col("_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha256:"), F.col("_digest")).alias("payload_digest"),
        F.when(revisit, urn(first)).alias("refers_to"),
        F.when(revisit, F.create_map(F.lit("WARC-Profile"), F.lit(SAME_PAYLOAD), F.lit(PAYLOAD_LENGTH), F.col("_bytes").cast("string")))
        .alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def archive_pages(pages: DataFrame, path: str | None = None, **options: str) -> str:
    """Write the archive of the pages (``page_records``) and return its folder."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(page_records(pages), path, **options)
    return path


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of an archive, read back: responses from their payloads, revisits from headers alone.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; a response's length and digest are
    computed from the payload read, not taken from its headers.
    """
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    responses = read_archives(spark, path).where("record_type = 'response'").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read_archives(spark, path, payload=False).where("record_type = 'revisit'").select(
        number("record_id").alias("page_id"), F.col("headers")[PAYLOAD_LENGTH.lower()].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))
    return responses.union(revisits)
