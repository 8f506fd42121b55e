"""WARC records in ZIP-packaged archives, read without extraction (operator 6).

Writing: each task packs its rows into ZIP files of the shared folder. A file
holds one stored member ``archive/data.warc.gz`` (every record its own gzip
member) and one stored member ``indexes/index.cdxj`` with a line for each
record: its place within the archive member. Payloads that occur more than
once are stored with the smallest id only; the other records are revisits.

Reading: a task opens a file at its end, parses the end-of-central-directory
record (the ZIP64 one where there is one) and the central directory, finds
from the local headers where the stored members' bytes begin, reads the index
members, and then one byte range for each record. Nothing is extracted.

Files are written under a temporary name and renamed when complete, so a
repeated task leaves whole files only; the reader gets the names that the
writing tasks returned, which Spark publishes once per partition.

Defined results: a null payload is empty. A null id is written as such, comes
back as null, and is never the id that others refer to while a row with an id
has that payload; where none has, all rows are responses. Rows that share the
smallest id of a payload are all responses. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import new_folder
from .tokens import tidy

DATE = "2024-01-01T00:00:00Z"  # records carry no clock, so that a repeated task writes the same bytes
MEMBER_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_uri(page_id) -> str:
    return "<urn:x-page:null>" if page_id is None else f"<urn:x-page:{page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record: a response with the payload, or a revisit with
    the response's headers alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {page_uri(page_id)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {page_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


# --- writing -----------------------------------------------------------------


class PackageWriter:
    """Writes one ZIP package through a file system's output stream."""

    def __init__(self, folder: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.path = f"{root}/part-{uuid.uuid4().hex}.wacz"
        self.out = self.fs.open_output_stream(self.path + ".open")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True)
        self.index, self.size = io.BytesIO(), 0

    def add(self, page_id, url, payload: bytes, digest: str, refers_to) -> None:
        raw = gzip.compress(record(page_id, url, payload, digest, refers_to), 1, mtime=0)
        self.member.write(raw)
        entry = {"url": url, "offset": self.size, "length": len(raw), "filename": "data.warc.gz", "digest": f"sha1:{digest}"}
        self.index.write(f"{page_id} {json.dumps(entry)}\n".encode())
        self.size += len(raw)

    def close(self) -> str:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo("indexes/index.cdxj"), "w", force_zip64=True) as f:
            f.write(self.index.getbuffer())
        self.zip.close()
        self.out.close()
        self.fs.move(self.path + ".open", self.path)
        return self.path


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write a record for each row; returns the folder and the (lazy) table
    (path) of the packages, whose evaluation writes them.

    Payloads of at least ``least_bytes`` bytes are compared by their SHA-1:
    the smallest id of each digest is found by an aggregate, which combines
    before its shuffle, and joined back; a hot digest's rows are split by the
    session's skew handling."""
    folder = folder or new_folder(pages.sparkSession, "packages")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    linked = rows.join(first, "sha", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= least_bytes), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for page_id, url, payload, sha, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or PackageWriter(folder)
                writer.add(page_id, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), refers_to)
                if writer.size >= MEMBER_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.record_batch([pa.array(done, pa.string())], names=["path"])

    return folder, linked.select("id", "url", "payload", "sha", refers.alias("refers_to")).mapInArrow(tidy(run), "path string")


# --- reading -----------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    size: int  # stored bytes
    header: int  # offset of the local header


class Package:
    """Random access to the stored members of a ZIP file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        self.size = source.tell()
        self.members = {m.name: m for m in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        raw = self.source.read(n)
        if len(raw) != n:
            raise ValueError("file ends early")
        return raw

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - 65535)  # a comment may follow
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        count, length, offset = struct.unpack_from("<HII", tail, at + 10)
        if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
            place, = struct.unpack_from("<Q", tail, at - 12)
            raw = self.read(place, 56)
            if raw[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, offset = struct.unpack_from("<QQQ", raw, 32)
        raw, at = self.read(offset, length), 0
        for _ in range(count):
            if raw[at:at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            stored, plain = struct.unpack_from("<II", raw, at + 20)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
            header, = struct.unpack_from("<I", raw, at + 42)
            name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
            stored, header = self._large(extra, plain, stored, header)
            yield Member(name, method, stored, header)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _large(extra: bytes, plain: int, stored: int, header: int) -> tuple[int, int]:
        """Sizes and places that don't fit 32 bits are in the ZIP64 field, in
        this order, and only those that don't fit."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                place = at + 4
                if plain == 0xFFFFFFFF:
                    place += 8
                if stored == 0xFFFFFFFF:
                    stored, = struct.unpack_from("<Q", extra, place)
                    place += 8
                if header == 0xFFFFFFFF:
                    header, = struct.unpack_from("<Q", extra, place)
            at += 4 + n
        return stored, header

    def place(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        m = self.members[name]
        if m.method != 0:
            raise ValueError(f"{name} is compressed, not stored")
        raw = self.read(m.header, 30)
        if raw[:4] != LOCAL:
            raise ValueError("no local header")
        return m.header + 30 + sum(struct.unpack_from("<HH", raw, 26))

    def index_lines(self, name: str) -> Iterator[dict]:
        """Entries of a CDXJ index member, which may be gzipped, or start with
        lines about itself."""
        raw = self.read(self.place(name), self.members[name].size)
        if name.endswith(".gz"):
            raw = gzip.decompress(raw)
        for line in raw.splitlines():
            if b"{" in line and not line.startswith((b"!", b"#")):
                entry = json.loads(line[line.index(b"{"):])
                if "filename" in entry:
                    # the common writers put numbers as text
                    yield {"filename": entry["filename"], "offset": int(entry["offset"]), "length": int(entry["length"])}

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """All records of the index members, each by its own range."""
        for name in sorted(self.members):
            if not name.startswith("indexes/") or not name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
                continue
            starts: dict[str, int] = {}
            for entry in self.index_lines(name):
                member = entry["filename"] if entry["filename"] in self.members else "archive/" + entry["filename"]
                if member not in starts:
                    starts[member] = self.place(member)
                raw = self.read(starts[member] + entry["offset"], entry["length"])
                yield parse_record(zlib.decompress(raw, 31) if member.endswith(".gz") else raw)


def read_packages(paths: DataFrame, folder: str) -> DataFrame:
    """The records of the packages: (page_id, url, record_type, refers_to,
    payload_digest, payload_bytes, payload); a revisit's payload is null, its
    digest and length are those of the full payload."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_file(path) as source:
                    for fields, block in Package(source).records():
                        head, _, payload = block.partition(b"\r\n\r\n")
                        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
                        revisit = fields["warc-type"] == "revisit"
                        rows.append((page_of(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], page_of(fields["warc-refers-to"]) if revisit else None,
                                     fields["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"]), None if revisit else payload))
                        held += len(block)
                        if held > 4 << 20:
                            yield pa.record_batch(list(map(pa.array, zip(*rows), kinds.types)), schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch(list(map(pa.array, zip(*rows), kinds.types)), schema=kinds)

    return paths.mapInArrow(tidy(run), "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")
