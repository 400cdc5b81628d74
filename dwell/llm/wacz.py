"""Web archives in ZIP packages: a writer, and a reader that range-reads records without extraction.

An archive is a ZIP file whose members are stored, not deflated: archive/data.warc.gz holds one gzip member for each
WARC record, indexes/index.cdx one line for each record with its offset and length there, and datapackage.json names
both. The writer streams; the reader takes the file's tail for the end record, follows the ZIP64 locator and end record
where sizes or counts overflow, parses the central directory, finds each stored member's data behind its local header,
and then reads single records by their offsets. Packages of other writers may hold several archive members and indexes
in CDX or CDXJ form, gzipped or not. Whatever is damaged or cut short raises ValueError.

Of records with equal payloads the one with the smallest page id is a response, the others are revisits that refer to
it and hold no payload. Payloads are equal when SHA-1, SHA-256 and length are. The digests combine on the map side; the
rows then meet their winner in a join that adaptive execution splits where a payload is hot. Each task writes archives
of at most ARCHIVE_RECORDS records or ARCHIVE_BYTES bytes to the shared folder under a name of its own; the table of
archives, written there too, names those of the tasks that counted. Reading deals out slices of SLICE records.

Edge cases: a null html is an empty payload; payloads under min_bytes are responses all; rows that tie on the smallest
page id of a payload are responses all; rows without a page id refer to the smallest id that there is and are responses
where there is none; extra columns are not archived; an empty table gives no archive and no record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import filesystem, new_folder, partitions, quoted, small_batches, written

ARCHIVE_RECORDS = 200_000
ARCHIVE_BYTES = 1 << 30
SLICE = 4096
PIECE = 1 << 20
#: Repeated payloads up to which their digests are broadcast (40 bytes each); beyond, pages are joined by shuffle.
BROADCAST_ROWS = 200_000
ARCHIVES = r"archive/[^/]+\.warc(\.gz)?"
INDEXES = r"indexes/[^/]+\.cdxj?(\.gz)?"
MEMBER = "archive/data.warc.gz"
INDEX = "indexes/index.cdx"
PACKAGE = "datapackage.json"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# ---- ZIP ----------------------------------------------------------------------------------------------------------

LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
MOST32, MOST16 = 0xFFFFFFFF, 0xFFFF
DOS_DATE = (2024 - 1980) << 9 | 1 << 5 | 1


class StoredZip:
    """Writes stored members one after the other; sizes and CRC follow the data, so nothing is held back.

    zip64: whether offsets and sizes take the 64-bit form even where they would fit into 32 bits.
    """

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.zip64 = out, 0, zip64
        self.members: list[tuple[bytes, int, int, int]] = []
        self.open: tuple[bytes, int] | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.open, self.size, self.crc = (raw, self.at), 0, 0
        # flag 3: sizes in a descriptor after the data; flag 11: the name is UTF-8; a ZIP64 field makes that descriptor 64-bit
        self._put(LOCAL + struct.pack("<5H3I2H", 45, 1 << 3 | 1 << 11, 0, 0, DOS_DATE, 0, MOST32, MOST32, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(b"PK\7\10" + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.open[0], self.open[1], self.size, self.crc))
        self.open = None

    def add(self, name: str, data: bytes) -> None:
        self.begin(name)
        self.write(data)
        self.end()

    def close(self) -> None:
        start = self.at
        for name, at, size, crc in self.members:
            far, large = self.zip64 or at >= MOST32, self.zip64 or size >= MOST32
            extra = (struct.pack("<2Q", size, size) if large else b"") + (struct.pack("<Q", at) if far else b"")
            extra = struct.pack("<2H", 1, len(extra)) + extra if extra else b""
            shown = MOST32 if large else size
            self._put(CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 1 << 3 | 1 << 11, 0, 0, DOS_DATE, crc, shown, shown, len(name), len(extra), 0, 0, 0, 0, MOST32 if far else at) + name + extra)
        size, n, end = self.at - start, len(self.members), self.at
        if self.zip64 or n >= MOST16 or size >= MOST32 or start >= MOST32:
            self._put(END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, end, 1))
            n, size, start = MOST16, MOST32, MOST32
        self._put(END + struct.pack("<4H2IH", 0, 0, n, n, size, start, 0))


@dataclass(frozen=True)
class Stored:
    name: str
    start: int  # of the data in the file
    size: int


class ZipReader:
    """Members of a ZIP file in a random-access file, by its directories alone."""

    TAIL = 22 + MOST16

    def __init__(self, file):
        self.file, self.size = file, file.size()
        n, size, start = self._end()
        self.members = {m[0]: m[1:] for m in self._directory(self.read(start, size), n)}

    def read(self, at: int, n: int) -> bytes:
        if not 0 <= at <= at + n <= self.size:
            raise ValueError("the archive is cut short")
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the archive is cut short")
        return data

    def _end(self) -> tuple[int, int, int]:
        base = max(0, self.size - self.TAIL)
        tail = self.read(base, self.size - base)
        at = tail.rfind(END)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] > len(tail)):
            at = tail.rfind(END, 0, at)  # these four bytes stood in the comment, or the record is cut short
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        n, size, start = struct.unpack_from("<H2I", tail, at + 10)
        if (n == MOST16 or size == MOST32 or start == MOST32) and base + at >= 20:
            locator = self.read(base + at - 20, 20)
            if locator[:4] == LOCATOR64:
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != END64:
                    raise ValueError("the ZIP64 locator points nowhere")
                n, size, start = struct.unpack_from("<3Q", record, 32)
        return n, size, start

    @staticmethod
    def _directory(data: bytes, n: int) -> Iterator[tuple[str, int, int, int]]:
        at = 0
        for _ in range(n):
            if data[at : at + 4] != CENTRAL or at + 46 > len(data):
                raise ValueError("the central directory is damaged")
            flags, method = struct.unpack_from("<2H", data, at + 8)
            packed_, plain, n_name, n_extra, n_comment = struct.unpack_from("<2I3H", data, at + 20)
            (local,) = struct.unpack_from("<I", data, at + 42)
            name, extra = data[at + 46 : at + 46 + n_name], data[at + 46 + n_name : at + 46 + n_name + n_extra]
            at += 46 + n_name + n_extra + n_comment
            if at > len(data):
                raise ValueError("the central directory is damaged")
            try:
                text = name.decode("utf-8" if flags & 1 << 11 else "cp437")
            except UnicodeDecodeError as e:
                raise ValueError("a member's name is damaged") from e
            wide = [x for x, v in (("plain", plain), ("packed", packed_), ("local", local)) if v == MOST32]
            long = ZipReader._wide(extra, wide) if wide else {}
            yield text, method, long.get("packed", packed_), long.get("local", local)

    @staticmethod
    def _wide(extra: bytes, names: list[str]) -> dict[str, int]:
        """The ZIP64 field holds, in this order, those that overflow; without it the 32-bit values stand as they are."""
        x = 0
        while x + 4 <= len(extra):
            tag, length = struct.unpack_from("<2H", extra, x)
            if tag == 1:
                if length < 8 * len(names) or x + 4 + 8 * len(names) > len(extra):
                    raise ValueError("a ZIP64 field is damaged")
                return dict(zip(names, struct.unpack_from(f"<{len(names)}Q", extra, x + 4)))
            x += 4 + length
        return {}

    def stored(self, name: str) -> Stored:
        if name not in self.members:
            raise ValueError(f"the package has no member {name}")
        method, size, local = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored but compressed by method {method}")
        head = self.read(local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"{name} has no local header")
        n_name, n_extra = struct.unpack_from("<2H", head, 26)
        start = local + 30 + n_name + n_extra
        if start + size > self.size:
            raise ValueError(f"{name} is cut short")
        return Stored(name, start, size)

    def names(self, pattern: str) -> list[str]:
        return sorted(n for n in self.members if re.fullmatch(pattern, n))


# ---- WARC ---------------------------------------------------------------------------------------------------------


def sha1_32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, salt: str = "") -> str:
    """Made from the page id, so that a revisit can name a record that another task writes."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{salt}')}>"


def header(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]+", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), text or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", header(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", "" if page_id is None else str(page_id))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    return fields, rest[: int(length)]


def gzipped(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class ArchiveWriter:
    def __init__(self, uri: str, zip64: bool = False):
        self.uri = uri
        files, path = filesystem(uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(path)
        self.zip = StoredZip(self.out, zip64)
        self.zip.begin(MEMBER)
        self.index: list[str] = []

    def add(self, data: bytes, page_id: int | None, digest: str, kind: str) -> None:
        at, packed_ = self.zip.size, gzipped(data)
        self.zip.write(packed_)
        self.index.append(f"{'' if page_id is None else page_id} {at} {len(packed_)} {digest} {kind}\n")

    def close(self) -> int:
        self.zip.end()
        self.zip.add(INDEX, "".join(self.index).encode())
        about = {"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"name": x.rsplit("/", 1)[1], "path": x} for x in (MEMBER, INDEX)]}
        self.zip.add(PACKAGE, json.dumps(about).encode())
        self.zip.close()
        self.out.close()
        return len(self.index)


def _archived(folder: str):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, writer, made = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns)):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/part-{part}-{k}-{uuid.uuid4().hex}.wacz")
                    k += 1
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                revisit = first is not None and page_id != first
                writer.add(record(page_id, url, payload, digest, first, revisit), page_id, digest, "revisit" if revisit else "response")
                if len(writer.index) >= ARCHIVE_RECORDS or writer.zip.at >= ARCHIVE_BYTES:
                    made.append((writer.uri, writer.close()))
                    writer = None
        if writer is not None:
            made.append((writer.uri, writer.close()))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.int64())], names=["uri", "n_records"])

    return per_partition


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes archives into folder; returns their table (uri, n_records), itself written to the shared folder."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(quoted(html_col)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), F.col(quoted(url_col)).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    wide = rows.withColumn("key", F.struct("sha1", F.sha2("payload", 256).alias("sha2"), F.length("payload").alias("n"))).withColumn("key", F.unhex(F.sha2(F.concat_ws(" ", "key.sha1", "key.sha2", F.col("key.n").cast("string")), 256)))
    # only payloads that repeat need a winner; where every copy lacks an id there is none
    again = wide.where(F.length("payload") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("first").isNotNull()).select("key", "first")
    again = written(again, "repeated")
    # payloads are shuffled only where more of them repeat than may be broadcast
    few = again.count() <= BROADCAST_ROWS
    met = wide.join(F.broadcast(again) if few else again, "key", "left").select("page_id", "url", "payload", "sha1", "first")
    return written(met.mapInArrow(_archived(folder), "uri string, n_records long"), "archives")


def _lines(reader: ZipReader, index: Stored) -> Iterator[bytes]:
    """Lines of an index member, plain or of gzip members, read in pieces."""
    gz = index.name.endswith(".gz")
    z, rest = zlib.decompressobj(31), b""
    for at in range(0, index.size, PIECE):
        data = reader.read(index.start + at, min(PIECE, index.size - at))
        while data:
            out, data = data, b""
            if gz:
                try:
                    out = z.decompress(out)
                except zlib.error as e:
                    raise ValueError(f"{index.name} is damaged") from e
                data = z.unused_data
                if z.eof:
                    z = zlib.decompressobj(31)
            *lines, rest = (rest + out).split(b"\n")
            yield from lines
    if rest:
        yield rest


def _located(line: bytes, only: str | None) -> tuple[str, int, int] | None:
    """Member, offset and length that an index line names: CDXJ, CDX of 11 fields, or this module's own five fields."""
    line = line.strip()
    if not line or line[:1] == b"!" or line.startswith(b"CDX "):
        return None
    try:
        if b"{" in line:
            f = json.loads(line[line.index(b"{") :])
            return f.get("filename") or only, int(f["offset"]), int(f["length"])
        f = line.decode().split(" ")
        if len(f) == 11:
            return f[10], int(f[9]), int(f[8])
        return only, int(f[-4]), int(f[-3])
    except (ValueError, KeyError, IndexError, TypeError) as e:
        raise ValueError(f"the index line {line[:80]!r} cannot be read") from e


def locators(reader: ZipReader) -> Iterator[tuple[str, int, int]]:
    """(archive member, offset, length) of every record that the package's indexes name."""
    members = {n.rsplit("/", 1)[-1]: reader.stored(n) for n in reader.names(ARCHIVES)}
    indexes = reader.names(INDEXES)
    if members and not indexes:
        raise ValueError("the package has no index")
    only = next(iter(members)) if len(members) == 1 else None
    for name in indexes:
        for line in _lines(reader, reader.stored(name)):
            found = _located(line, only)
            if found is None:
                continue
            base, at, size = (found[0] or "").rsplit("/", 1)[-1], found[1], found[2]
            if base not in members:
                raise ValueError(f"the index names an archive member that is not there: {found[0]}")
            if at < 0 or size <= 0 or at + size > members[base].size:
                raise ValueError("the index points beyond the archive member")
            yield members[base].name, at, size


def _sliced(slice_records: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each package's directories and indexes are read once; its records are dealt out by their places."""
        for b in batches:
            for uri in b.column("uri").to_pylist():
                files, path = filesystem(uri)
                with files.open_input_file(path) as f:
                    held: dict[str, list[tuple[int, int]]] = {}
                    for member, at, size in locators(ZipReader(f)):
                        own = held.setdefault(member, [])
                        own.append((at, size))
                        if len(own) == slice_records:
                            yield _slice(uri, member, held.pop(member))
                    for member, own in held.items():
                        yield _slice(uri, member, own)

    return per_partition


def _slice(uri: str, member: str, places: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([member]), pa.array([places[0][0]], pa.int64()), pa.array([np.array(places, "<i8").tobytes()], pa.binary())], names=["uri", "member", "first", "places"])


def _record(reader: ZipReader, data: Stored, at: int, size: int) -> bytes:
    """One record, by a read of its own range."""
    if not data.name.endswith(".gz"):
        return reader.read(data.start + at, size)
    z = zlib.decompressobj(31)
    try:
        out = z.decompress(reader.read(data.start + at, size))
    except zlib.error as e:
        raise ValueError(f"the record at {at} of {data.name} is damaged") from e
    if not z.eof:
        raise ValueError(f"the record at {at} of {data.name} is cut short")
    return out


READ_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string())])
    for b in batches:
        for uri, member, _, places in zip(*(c.to_pylist() for c in b.columns)):
            files, path = filesystem(uri)
            with files.open_input_file(path) as f:
                reader = ZipReader(f)
                data = reader.stored(member)
                rows: list[tuple] = []
                size = 0
                for at, n in np.frombuffer(places, "<i8").reshape(-1, 2).tolist():
                    rows.append(_row(_record(reader, data, at, n)))
                    size += n
                    if len(rows) == 256 or size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), kind)], schema=kind)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), kind)], schema=kind)


def _row(data: bytes) -> tuple:
    """A response or revisit of any writer: what this module's own fields do not say is null, or taken from the block."""
    fields, block = parsed(data)
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields.get("warc-type") == "revisit"
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    if not revisit and length is not None and len(payload) != int(length[1]):
        raise ValueError(f"the payload of {fields.get('warc-record-id')} is damaged")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or (None if revisit else sha1_32(payload))
    if not revisit and sha1_32(payload) != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} is damaged")
    n = len(payload) if not revisit else int(length[1]) if length is not None else None
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return int(page) if page else None, fields.get("warc-target-uri"), None if revisit else payload, n, digest, fields.get("warc-type"), int(refers) if refers else None, fields.get("warc-record-id")


def read_archives(archives: DataFrame, slice_records: int = SLICE) -> DataFrame:
    """One row for each record of the packages in the table (uri). A revisit has no payload of its own."""
    spark = archives.sparkSession
    small_batches(spark)
    n = partitions(spark)
    slices = written(archives.select("uri").repartition(n, "uri").mapInArrow(_sliced(slice_records), "uri string, member string, first long, places binary"), "slices")
    return slices.repartition(n, "uri", "member", "first").mapInArrow(_read, READ_SCHEMA)


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages to archives in the shared folder and back."""
    folder = new_folder(pages.sparkSession, "wacz")
    return read_archives(write_archives(pages, folder, id_col, url_col, html_col, min_bytes))
