"""WARC records in ZIP packages: written by tasks, found by directory and index, range-read."""

from __future__ import annotations

import base64
import gzip
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bitmap, in_bitmap, written
from tallyforge.llm.shared_files import create, fresh_file, open_random
from tallyforge.session import scratch_path

# Fixed values of the ZIP format: signatures and record layouts.
LOCAL, CENTRAL, DESCRIPTOR = 0x04034B50, 0x02014B50, 0x08074B50
END64, LOCATOR64, END = 0x06064B50, 0x07064B50, 0x06054B50
FAR = 0xFFFFFFFF

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORD_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Package:
    """Writes stored members one after the other, all sizes and places in ZIP64 fields."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 1 << 3, 0, 0, 0x21, 0, FAR, FAR, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """The place of ``data`` within its member."""
        member = self.members[-1]
        place = member[2]
        member[2] += len(data)
        member[3] = zlib.crc32(data, member[3])
        self._put(data)
        return place

    def end(self) -> None:
        _, _, size, crc = self.members[-1]
        self._put(struct.pack("<IIQQ", DESCRIPTOR, crc, size, size))

    def close(self) -> None:
        first = self.at
        for raw, place, size, crc in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, place)
            head = struct.pack(
                "<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 1 << 3, 0, 0, 0x21, crc, FAR, FAR, len(raw), len(extra), 0, 0, 0, 0, FAR
            )
            self._put(head + raw + extra)
        last, many = self.at, len(self.members)
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, many, many, last - first, first))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, last, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, FAR, FAR, 0))
        self.out.close()


def members(source) -> dict[str, tuple[int, int]]:
    """Place and size of the stored members of a ZIP file, from its (ZIP64) central directory.

    ``source`` has size() and read_at(bytes, place); only the end, the directory
    and the local headers are read.
    """
    total = source.size()
    tail_at = max(0, total - (1 << 16) - 64)
    tail = source.read_at(total - tail_at, tail_at)
    end = tail.rfind(struct.pack("<I", END))
    if end < 0:
        raise ValueError("no ZIP directory")
    size, first = struct.unpack_from("<II", tail, end + 12)
    many = struct.unpack_from("<H", tail, end + 10)[0]
    if FAR in (size, first) or many == 0xFFFF:
        mark, _, place, _ = struct.unpack_from("<IIQI", tail, end - 20)
        if mark != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = source.read_at(56, place)
        if struct.unpack_from("<I", record)[0] != END64:
            raise ValueError("no ZIP64 directory")
        size, first = struct.unpack_from("<QQ", record, 40)
    directory, at, found = source.read_at(size, first), 0, {}
    while at < len(directory):
        fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if fields[0] != CENTRAL:
            raise ValueError("broken ZIP directory")
        method, packed, full, names, extras, notes, place = *fields[4:5], *fields[8:13], fields[16]
        name = directory[at + 46 : at + 46 + names].decode()
        extra, i = directory[at + 46 + names : at + 46 + names + extras], 0
        while i < len(extra):
            kind, length = struct.unpack_from("<HH", extra, i)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, i + 4))
                full = wide.pop(0) if full == FAR else full
                packed = wide.pop(0) if packed == FAR else packed
                place = wide.pop(0) if place == FAR else place
            i += 4 + length
        if method == 0:  # others can't be read by range
            local = source.read_at(30, place)
            names_here, extras_here = struct.unpack_from("<HH", local, 26)
            found[name] = (place + 30 + names_here + extras_here, packed)
        at += 46 + names + extras + notes
    return found


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that has only the header of the response."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = " ".join((url or "").split())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        done: list[tuple[str, int]] = []

        def finish() -> None:
            package.end()
            package.begin(INDEX)
            for line in index:
                package.write(line)
            package.end()
            package.close()
            done.append((path, len(index)))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page, url, html, sha1, refers_to = row
                if package is None:
                    path, index = fresh_file(folder, ".wacz"), []
                    package = Package(create(path))
                    package.begin(DATA)
                raw = record_bytes(page, url, (html or "").encode(), base32_sha1(sha1), refers_to)
                member = gzip.compress(raw, 3, mtime=0)
                place = package.write(member)
                index.append(json.dumps({"id": page, "offset": place, "length": len(member)}).encode() + b"\n")
                if package.at >= archive_bytes:
                    finish()
                    package = None
        if package is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return run


def _splits(split_bytes: int):
    """Of each archive: runs of whole records of about ``split_bytes``, found through its index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_random(path) as source:
                    found = members(source)
                    place, size = found[INDEX]
                    lines = source.read_at(size, place).splitlines()
                base, parts = found[DATA][0], []
                for line in lines:
                    entry = json.loads(line)
                    if not parts or sum(parts[-1][1]) >= split_bytes:
                        parts.append((base + entry["offset"], []))
                    parts[-1][1].append(entry["length"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(parts)),
                        pa.array([p for p, _ in parts], pa.int64()),
                        pa.array([n for _, n in parts], pa.list_(pa.int64())),
                    ],
                    ["path", "place", "lengths"],
                )

    return run


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, place, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with open_random(path) as source:
                data = source.read_at(sum(lengths), place)
            rows, at = [], 0
            for length in lengths:
                fields, block = parse_record(gzip.decompress(data[at : at + length]))
                at += length
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                kind = fields["WARC-Type"]
                if kind == "response" and len(payload) != size:
                    raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
                target = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((_number(fields["WARC-Record-ID"]), size, digest, kind, target))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    archive_bytes: int = 64 << 20,
    filter_bits: int = 1 << 22,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write each page as a WARC record into ZIP packages; returns the manifest: path, records.

    Of pages with equal payloads of ``min_bytes`` or more, that with the largest id is
    a response and the others revisit it; smaller payloads are all responses.  Payloads that occur once are
    told by a bitmap of fixed size and written where they are read; only the others are
    shuffled, to meet the id they refer to.  A null html is an empty payload, a null url
    an empty target, a null id never a response that others refer to; rows that repeat the id of
    the response are responses too.  An attempt that is lost leaves a file that no manifest names.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    rows = rows.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    key = F.xxhash64("sha1")
    often = written(bitmap(rows.filter(F.octet_length("html") >= min_bytes).select("id", "sha1"), key, filter_bits), "digests")
    marked = in_bitmap(rows, key, often, filter_bits).withColumn("hit", F.col("hit") & (F.octet_length("html") >= min_bytes))
    latest = written(marked.filter("hit").groupBy("sha1").agg(F.max("id").alias("latest")), "latest")
    refers = F.when(~F.col("id").eqNullSafe(F.col("latest")), F.col("latest"))
    columns = ["id", "url", "html", "sha1", "refers_to"]
    single = marked.filter("NOT hit").withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
    several = marked.filter("hit").join(latest, "sha1").withColumn("refers_to", refers).select(*columns)
    return written(single.union(several).mapInArrow(_writer(folder, archive_bytes), "path string, records long"), "manifest")


def read_archives(manifest: DataFrame, split_bytes: int = 4 << 20) -> DataFrame:
    """Read the records of the packages in ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Tasks read the directory and the index of each package, then ranges of whole
    records; no package is extracted.  An empty manifest gives no rows.
    """
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splits = manifest.select("path").repartition(parts).mapInArrow(_splits(split_bytes), "path string, place long, lengths array<long>")
    return splits.repartition(parts).mapInArrow(_reader, RECORD_ROWS)
