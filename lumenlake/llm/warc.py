"""WARC archives as a Python data source named ``warc``.

Writing: each task writes one archive of gzip members, one member per record.
A member's header carries the subfield ``sl`` with its compressed and plain
lengths, so that a reader can step over it without inflating it.  A file
counts once the driver has named it in the manifest of the write, so what
failed or repeated tasks leave behind is never read.

Reading: the driver lists the archives, those of the manifests or, in a folder
without one, every ``*.warc.gz`` and ``*.warc`` below it, and packs them into
partitions by size.  Filters on the record type and on header columns are pushed down.  A
task inflates the head of a record only; if the filters reject it, or the
option ``payload`` is ``none``, its payload is never inflated.  With the
option ``verify`` the payload's SHA-256 is computed and must be the recorded one.

Archives of other writers have members without lengths, one gzip stream for
many records, or no compression, and record types of all kinds.  Their records
are found by Content-Length in a stream that is inflated piece by piece; what
the filters reject passes through and is not kept.  Their payload is what
follows the HTTP head of a response, freed of chunked transfer coding, or the
block of any other record that has no HTTP message; ``payload_bytes`` is its
length as stored, and of a revisit the length its HTTP head names, if any.
``verify`` knows SHA-256 and SHA-1 in hex or base 32, over the payload as stored
or without chunks; records with another digest or none are not checked.

A revisit has no payload of its own: its block is the HTTP head, its headers
name the digest and the record it refers to, and Content-Length in the HTTP
head keeps the length of the full payload.

Defined results: a null page_id is written without an id and read as null; a
null url becomes an empty target; line breaks in a url are percent-encoded;
a null payload of a response is empty; an empty folder reads as no rows; a
header that a record lacks is null, as are page_id and refers_to where the ids
are not those of this writer; an archive that ends inside a record, or that
holds anything but records, fails the read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from lumenlake.llm.common import ship

SCHEMA = (
    "page_id long, target_uri string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary, record_id string, record_date string"
)
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
LEAST_REVISIT = 100
MANIFEST = "_manifest-"
_ID = "urn:page:"
_GZIP_HEAD = struct.Struct("<4sIBBH")  # magic with FEXTRA, time, flags, system, extra length
_MAGIC = b"\x1f\x8b\x08\x04"
_EXTRA = struct.Struct("<2sHII")  # subfield id, its length, compressed and plain lengths of the member
_HEAD_CHUNK = 4096
_CHUNK = 1 << 14  # inflates to 16 MB at most
_HEAD_LIMIT = 1 << 24
ENDINGS = (".warc.gz", ".warc")


# --- the record format -------------------------------------------------------


def encode_record(page_id, uri, kind: str, refers_to, digest: str, length: int, payload: bytes) -> bytes:
    """One gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    uri = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
    heads = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        heads.append(f"WARC-Record-ID: <{_ID}{page_id}>")
    if kind == "revisit":
        heads.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            heads.append(f"WARC-Refers-To: <{_ID}{refers_to}>")
    heads += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    plain = "\r\n".join(heads).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(plain) + packer.flush()
    total = _GZIP_HEAD.size + _EXTRA.size + len(body) + 8
    head = _GZIP_HEAD.pack(_MAGIC, 0, 0, 255, _EXTRA.size) + _EXTRA.pack(b"sl", 8, total, len(plain) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def _headers(block: bytes) -> dict[str, str]:
    """Names in lower case; the first line and folded lines are left out, bytes that are not UTF-8 replaced."""
    lines = [line for line in block.decode("utf-8", "replace").split("\r\n")[1:] if line[:1] not in (" ", "\t")]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _page(value: str | None) -> int | None:
    found = (value or "").strip("<>")
    number = found.removeprefix(_ID)
    return int(number) if found.startswith(_ID) and number.lstrip("-").isdecimal() else None


def _length(value: str | None) -> int | None:
    return int(value) if value and value.isdecimal() else None


def _fields(warc: dict[str, str], payload_bytes: int | None) -> dict:
    record_id, digest = warc.get("warc-record-id"), warc.get("warc-payload-digest")
    return {
        "page_id": _page(record_id),
        "target_uri": warc.get("warc-target-uri"),
        "record_type": warc.get("warc-type"),
        "refers_to": _page(warc.get("warc-refers-to")),
        "payload_digest": digest and digest.removeprefix("sha256:"),
        "payload_bytes": payload_bytes,
        "record_id": record_id and record_id.strip("<>"),
        "record_date": warc.get("warc-date"),
    }


class Member:
    """One record: its head is inflated at once, its payload only when asked for."""

    def __init__(self, read, body_length: int):
        self._read, self._left = read, body_length
        self._inflate = zlib.decompressobj(-15)
        self._plain, self._crc, self._at = b"", 0, 0
        warc = _headers(self._until_blank())
        http = _headers(self._until_blank())
        self.fields = _fields(warc, _length(http.get("content-length")))

    def _more(self) -> bool:
        if not self._left:
            return False
        data = self._read(min(self._left, _HEAD_CHUNK))
        if not data:
            raise EOFError("the archive ends inside a record")
        self._left -= len(data)
        self._plain += self._inflate.decompress(data)
        return True

    def _until_blank(self) -> bytes:
        while (end := self._plain.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("a record without the end of its head")
        block, self._plain = self._plain[:end], self._plain[end + 4 :]
        return block

    def payload(self) -> bytes:
        parts = [self._plain]
        while self._left:
            data = self._read(min(self._left, 1 << 20))
            if not data:
                raise EOFError("the archive ends inside a record")
            self._left -= len(data)
            parts.append(self._inflate.decompress(data))
        return b"".join([*parts, self._inflate.flush()])[:-4]


class _Plain:
    """The plain bytes of an archive from where its stream stands, inflated piece by piece."""

    def __init__(self, stream, packed: bool):
        self._stream, self._inflate = stream, zlib.decompressobj(31) if packed else None
        self.buffer = bytearray()

    def more(self) -> bool:
        """Lengthen the buffer; false at the end of the archive."""
        if self._inflate is None:
            data = self._stream.read(_CHUNK)
            self.buffer += data
            return bool(data)
        while True:
            raw = self._inflate.unused_data
            if self._inflate.eof:
                # The next member; zeros pad the end of some archives.
                raw = raw.lstrip(b"\0")
            raw = raw or self._stream.read(_CHUNK)
            if not raw:
                if not self._inflate.eof and self._begun:
                    raise EOFError("the archive ends inside a record")
                return False
            if self._inflate.eof:
                self._inflate, self._begun = zlib.decompressobj(31), False
                raw = raw.lstrip(b"\0")
                if not raw:
                    continue
            self._begun = True
            plain = self._inflate.decompress(raw)
            if plain:
                self.buffer += plain
                return True

    _begun = False

    def upto(self, size: int) -> None:
        while len(self.buffer) < size:
            if not self.more():
                raise EOFError("the archive ends inside a record")

    def take(self, size: int) -> bytes:
        self.upto(size)
        data = bytes(self.buffer[:size])
        del self.buffer[:size]
        return data

    def skip(self, size: int) -> None:
        while size:
            if not self.buffer and not self.more():
                raise EOFError("the archive ends inside a record")
            step = min(size, len(self.buffer))
            del self.buffer[:step]
            size -= step

    def next_record(self) -> bool:
        """Step over line ends to the next record; false at the end."""
        while True:
            gone = len(self.buffer) - len(self.buffer.lstrip(b"\r\n"))
            del self.buffer[:gone]
            if self.buffer:
                break
            if not self.more():
                return False
        self.upto(5)
        if self.buffer[:5] != b"WARC/":
            raise ValueError("no record where one should begin")
        return True

    def head(self, within: int | None = None) -> bytes | None:
        """The bytes before the next blank line; none if ``within`` bytes hold none."""
        limit = _HEAD_LIMIT if within is None else min(within, _HEAD_LIMIT)
        looked = 0
        while (end := self.buffer.find(b"\r\n\r\n", looked, limit)) < 0:
            looked = max(0, len(self.buffer) - 3)
            if len(self.buffer) >= limit:
                if within is None:
                    raise ValueError("a record without the end of its head")
                return None
            if not self.more():
                raise EOFError("the archive ends inside a record")
        return self.take(end + 4)[:-4]


class Streamed:
    """A record of an archive whose members have no lengths; what is not asked for passes by."""

    def __init__(self, plain: _Plain):
        self._plain = plain
        warc = _headers(plain.head())
        length = _length(warc.get("content-length"))
        if length is None:
            raise ValueError("a record without Content-Length")
        self._left, self._chunked, size = length, False, length
        if warc.get("content-type", "").lower().startswith("application/http") and warc.get("warc-type") in ("response", "revisit"):
            head = plain.head(length)
            http = _headers(head) if head is not None else {}
            self._left -= len(head) + 4 if head is not None else 0
            self._chunked = "chunked" in http.get("transfer-encoding", "").lower()
            size = self._left
            if warc["warc-type"] == "revisit":
                size = _length(http.get("content-length"))
        self.fields = _fields(warc, size)

    def payload(self) -> bytes:
        stored, self._left = self._plain.take(self._left), 0
        self.stored = stored
        return _without_chunks(stored) if self._chunked else stored

    def skip(self) -> None:
        self._plain.skip(self._left)
        self._left = 0


def _without_chunks(body: bytes) -> bytes:
    """The payload of a chunked body; a body that is not one, as some writers leave the head unchanged, stays."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or len(size) > 15 or size.strip(b"0123456789abcdefABCDEF"):
            return body
        n = int(size, 16)
        if n == 0:
            return b"".join(parts)
        at = end + 2 + n
        if body[at : at + 2] != b"\r\n":
            return body
        parts.append(body[end + 2 : at])
        at += 2


def read_members(stream) -> Iterator[Member | Streamed]:
    """Records of an archive in order; what a caller leaves unread is stepped over.

    From the first member without its length on, the rest is read as one stream.
    """
    at, size = 0, _GZIP_HEAD.size + _EXTRA.size
    while True:
        stream.seek(at)
        head = stream.read(size)
        if not head:
            return
        if len(head) < size or not head.startswith(_MAGIC):
            break
        extra = _GZIP_HEAD.unpack_from(head)[-1]
        name, _, total, _ = _EXTRA.unpack_from(head, _GZIP_HEAD.size)
        if name != b"sl" or extra != _EXTRA.size:
            break
        yield Member(stream.read, total - len(head) - 8)
        at += total
    stream.seek(at)
    plain = _Plain(stream, head.startswith(_MAGIC[:2]))
    while plain.next_record():
        record = Streamed(plain)
        yield record
        record.skip()


def _agrees(digest: str, payload: bytes) -> bool | None:
    """Whether a payload has the recorded digest; none for digests of other kinds."""
    kind, _, value = digest.rpartition(":")
    made = {"": hashlib.sha256, "sha256": hashlib.sha256, "sha-256": hashlib.sha256, "sha1": hashlib.sha1, "sha-1": hashlib.sha1}
    if kind.lower() not in made:
        return None
    found = made[kind.lower()](payload)
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _verify(member: Member | Streamed, payload: bytes) -> bool:
    digest, size = member.fields["payload_digest"], member.fields["payload_bytes"]
    if isinstance(member, Member):
        return len(payload) == size and _agrees(digest or "", payload) is True
    return not digest or _agrees(digest, payload) is not False or _agrees(digest, member.stored) is True


# --- filters -----------------------------------------------------------------

_TESTS = {
    EqualTo: lambda have, want: have is not None and have == want,
    EqualNullSafe: lambda have, want: have == want,
    In: lambda have, want: have is not None and have in want,
    GreaterThan: lambda have, want: have is not None and have > want,
    GreaterThanOrEqual: lambda have, want: have is not None and have >= want,
    LessThan: lambda have, want: have is not None and have < want,
    LessThanOrEqual: lambda have, want: have is not None and have <= want,
    IsNull: lambda have, _: have is None,
    IsNotNull: lambda have, _: have is not None,
}


def _accepts(filters: list[tuple], fields: dict) -> bool:
    return all(_TESTS[kind](fields[name], want) for kind, name, want in filters)


# --- the data source ---------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = [f.name for f in schema.fields]
        self.path = options["path"]
        self.with_payload = options.get("payload", "full") != "none"
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = getattr(f, "attribute", ())
            if type(f) in _TESTS and len(column) == 1 and column[0] != "payload":
                self.filters.append((type(f), column[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        store, root = pafs.FileSystem.from_uri(self.path)
        below = store.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
        listed = {f.path: f.size for f in below if f.is_file}
        manifests = [p for p in listed if p.rsplit("/", 1)[1].startswith(MANIFEST) and p.rsplit("/", 1)[0] == root.rstrip("/")]
        if manifests:
            named = set()
            for path in manifests:
                with store.open_input_stream(path) as stream:
                    named.update(f"{root.rstrip('/')}/{name}" for name in json.loads(stream.read()))
        else:
            named = {path for path in listed if path.lower().endswith(ENDINGS)}
        files = sorted(((listed[path], path) for path in named), reverse=True)
        packs: list[Files] = []
        room = 0
        for size, path in files:
            if not packs or size > room:
                packs.append(Files([]))
                room = self.partition_bytes
            packs[-1].paths.append(path)
            room -= size
        return packs or [Files([])]

    def read(self, partition):
        store, _ = pafs.FileSystem.from_uri(self.path)
        schema = pa.schema([pa.field(n, t) for n, t in _ARROW if n in self.names])
        rows: dict[str, list] = {n: [] for n in schema.names}
        held = 0
        for path in partition.paths:
            with store.open_input_file(path) as stream:
                for member in read_members(stream):
                    if not _accepts(self.filters, member.fields):
                        continue
                    member.fields["payload"] = None
                    if self.with_payload and member.fields["record_type"] != "revisit":
                        payload = member.payload()
                        if self.verify and not _verify(member, payload):
                            raise ValueError(f"{path}: record {member.fields['record_id']} differs from its digest")
                        member.fields["payload"] = payload
                        held += len(payload)
                    held += 200
                    for name, values in rows.items():
                        values.append(member.fields[name])
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict(rows, schema)
                        rows, held = {n: [] for n in schema.names}, 0
        if held:
            yield pa.RecordBatch.from_pydict(rows, schema)


_ARROW = [
    ("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ("record_id", pa.string()), ("record_date", pa.string()),
]


class WarcWriter(DataSourceArrowWriter):
    """Takes the columns of SCHEMA; nothing of a task is visible before the commit."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        store, root = pafs.FileSystem.from_uri(self.path)
        name, records, stream = f"part-{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if stream is None:
                        store.create_dir(root, recursive=True)
                        stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (row["payload"] or b"") if row["record_type"] == "response" else b""
                    stream.write(encode_record(
                        row["page_id"], row["target_uri"], row["record_type"], row["refers_to"],
                        row["payload_digest"], row["payload_bytes"], payload,
                    ))
                    records += 1
        finally:
            if stream is not None:
                stream.close()
        return Written(name if records else None, records)

    def commit(self, messages):
        store, root = pafs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as stream:
            stream.write(json.dumps([m.name for m in messages if m and m.name]).encode())

    def abort(self, messages):
        store, root = pafs.FileSystem.from_uri(self.path)
        for message in messages:
            if message and message.name:
                store.delete_file(f"{root}/{message.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options)


# --- operators ---------------------------------------------------------------


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """The records of (page_id, url, html): the first of equal payloads is a response, the others revisit it.

    Pages are grouped by digest in one narrow aggregation; adaptive execution
    splits the join back should one payload be most of the pages.  Repeated
    rows of the first page are responses each.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    long = F.col("payload_bytes") >= least_revisit
    first = rows.where(long).groupBy(F.col("payload_digest").alias("f_digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(first.where("n > 1"), F.col("payload_digest") == F.col("f_digest"), "left")
    again = F.col("f_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "target_uri",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
        "payload_digest", "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_archives(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("warc")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)
