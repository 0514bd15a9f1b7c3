"""Web archives in ZIP packages: a writer, and a reader that takes records by their place without extraction.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, a run of WARC records that are compressed
one by one, and ``indexes/index.cdxj``, a line per record with its place in that member. The reader finds the end of
the central directory from the file's tail, follows the ZIP64 locator where sizes or counts need it, parses the central
directory, works out where the bytes of a stored member lie in the package, and reads records by ranges there: neighbouring
records in one range, each inflated on its own.

Equal payloads are stored once: the page with the smallest id holds the response, the others are revisit records that refer to it.

Every task writes packages under names of its own attempt; a manifest, committed by Spark, names those that count.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import batch_rows, filesystem
from tablewright.session import materialise

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"  # records carry no crawl time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Signatures and sizes of the ZIP format.
END, END64_LOCATOR, END64, ENTRY = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02"
END_SIZE, LOCATOR_SIZE, END64_SIZE, ENTRY_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    local: int  # place of the member's local header


class Ranges:
    """Reads of byte ranges of one file."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def read(self, place: int, length: int) -> bytes:
        if place < 0 or length < 0 or place + length > self.size:
            raise ValueError("range outside the file")
        data = self.source.read_at(length, place)
        if len(data) != length:
            raise ValueError("short read")
        return data


def _directory(file: Ranges) -> tuple[int, int, int]:
    """Place, size and number of entries of the central directory."""
    tail_size = min(file.size, END_SIZE + FULL16)
    tail = file.read(file.size - tail_size, tail_size)
    at = tail.rfind(END)
    while at >= 0:  # the signature may occur in the comment: the comment has to end with the file
        if at + END_SIZE <= tail_size and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == tail_size:
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    entries, size, place = struct.unpack_from("<HII", tail, at + 10)
    if entries == FULL16 or size == FULL32 or place == FULL32:
        end_place = file.size - tail_size + at
        if end_place >= LOCATOR_SIZE:
            locator = file.read(end_place - LOCATOR_SIZE, LOCATOR_SIZE)
            if locator[:4] == END64_LOCATOR:
                record = file.read(struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
                if record[:4] != END64:
                    raise ValueError("no ZIP64 directory where the locator points")
                entries, size, place = struct.unpack_from("<QQQ", record, 32)
    return place, size, entries


def members(file: Ranges) -> list[Member]:
    """The entries of the central directory."""
    place, size, entries = _directory(file)
    raw = file.read(place, size)
    found, at = [], 0
    for _ in range(entries):
        if raw[at:at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        local = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + ENTRY_SIZE:at + ENTRY_SIZE + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + ENTRY_SIZE + n_name:at + ENTRY_SIZE + n_name + n_extra]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: the values that do not fit, in this order
                body = extra[4:4 + length]
                if full == FULL32:
                    full, body = struct.unpack_from("<Q", body)[0], body[8:]
                if packed == FULL32:
                    packed, body = struct.unpack_from("<Q", body)[0], body[8:]
                if local == FULL32:
                    local = struct.unpack_from("<Q", body)[0]
            extra = extra[4 + length:]
        found.append(Member(name, method, packed, full, local))
        at += ENTRY_SIZE + n_name + n_extra + n_comment
    return found


def stored_at(file: Ranges, member: Member) -> int:
    """Place of the first byte of a stored member."""
    if member.method != 0 or member.packed != member.size:
        raise ValueError(f"{member.name} is not stored")
    head = file.read(member.local, LOCAL_SIZE)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("damaged local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.local + LOCAL_SIZE + n_name + n_extra


def record(page, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, compressed on its own. A revisit has the response's HTTP head, with its length, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    name = f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    fields = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of one WARC record."""
    end = raw.find(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8").split("\r\n")
    if end < 0 or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    block = raw[end + 4:end + 4 + size]
    if len(block) != size:
        raise ValueError("a WARC record is cut short")
    return fields, block


def _page(field: str | None) -> int | None:
    match = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
    return int(match[1]) if match else None


def page_row(fields: dict[str, str], block: bytes) -> tuple:
    """(page, url, payload or None, payload bytes, digest, type, refers to) of a record; a response's digest is verified."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or length and int(length[1]) != len(payload)):
        raise ValueError("payload does not fit its digest")
    return (_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), payload if kind == "response" else None,
            int(length[1]) if length else len(payload), digest, kind, _page(fields.get("warc-refers-to")))


def write_packages(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 100, package_bytes: int = 64 << 20) -> DataFrame:
    """Write a record per row into packages under ``path``; returns the manifest (``file``, ``bytes``, ``records``).

    Payloads are UTF-8; NULL is empty. Of equal payloads of ``min_bytes`` or more, the smallest id is a response and the others
    revisit it; rows that repeat that smallest id, and rows with a NULL id, are responses too. An empty table writes
    nothing. Digests, not pages, are grouped: a payload that a third of the pages share is a combinable minimum.
    """
    spark = df.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    digested = pages.withColumn("digest", F.sha2("payload", 256))
    large = digested.where(F.octet_length("payload") >= min_bytes).select("id", "digest")
    firsts = large.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last")).where("last > refers_to")
    revisits = large.where("id IS NOT NULL").join(firsts.select("digest", "refers_to"), "digest").where("id != refers_to").distinct()
    fs, root = filesystem(path)
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        done: list[tuple[str, int, int]] = []
        package = None
        for batch in batches:
            columns = [batch.column(c).cast(pa.binary()).to_pylist() if c == "payload" else batch.column(c).to_pylist()
                       for c in ("id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                if package is None:
                    package = _Package(fs, root)
                package.add(*row)
                if package.size > package_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "bytes", "records"])

    batch_rows(spark, 500)
    return materialise(digested.join(revisits, ["id", "digest"], "left").select("id", "url", "payload", "digest", "refers_to")
                       .mapInArrow(run, "file string, bytes long, records long"), "warc-manifest")


class _Package:
    """A package being written; the index is held until the data member ends."""

    def __init__(self, fs, root: str):
        self.name = f"pages-{uuid.uuid4().hex}.zip"
        self.out = fs.open_output_stream(f"{root}/{self.name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines, self.size = [], 0

    def add(self, page, url, payload, digest, refers_to) -> None:
        raw = record(page, url, payload, digest, refers_to)
        self.data.write(raw)
        place = {"offset": self.size, "length": len(raw), "digest": f"sha256:{digest}", "filename": DATA}
        self.lines.append(f"{quote(url or '-', safe='%/:=&?~#+!$,;@()*[]')} {DATE.translate({45: None, 58: None, 84: None, 90: None})} {json.dumps(place)}\n")
        self.size += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(self.lines).encode())
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.name, size, len(self.lines)


def places(file: Ranges) -> Iterator[tuple[int, int]]:
    """(place in the package, length) of every record that the package's indexes name."""
    by_name = {m.name: m for m in members(file)}
    starts: dict[str, int] = {}
    for name, member in by_name.items():
        if name.startswith("indexes/") and name.endswith((".cdxj", ".cdx")):
            for line in io.BytesIO(file.read(stored_at(file, member), member.size)):
                place = json.loads(line[line.index(b"{"):])
                target = place["filename"] if place["filename"] in by_name else f"archive/{place['filename']}"
                if target not in starts:
                    starts[target] = stored_at(file, by_name[target])
                if int(place["offset"]) + int(place["length"]) > by_name[target].size:
                    raise ValueError("the index points outside its member")
                yield starts[target] + int(place["offset"]), int(place["length"])


def records(file: Ranges, span: int = 4 << 20, gap: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """All indexed records by their place; records within ``gap`` bytes of each other share a range of up to ``span`` bytes."""
    wanted = sorted(places(file))
    i = 0
    while i < len(wanted):
        lo, hi, j = wanted[i][0], sum(wanted[i]), i + 1
        while j < len(wanted) and wanted[j][0] <= hi + gap and sum(wanted[j]) - lo <= span:
            hi, j = max(hi, sum(wanted[j])), j + 1
        data = file.read(lo, hi - lo)
        for place, length in wanted[i:j]:
            yield parse_record(zlib.decompress(data[place - lo:place - lo + length], 31))
        i = j


def read_packages(spark: SparkSession, path: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record: ``page_id``, ``url`` (as in the record), ``payload`` (NULL for revisits; absent if not ``payloads``),
    ``payload_bytes`` and ``payload_digest`` of the full payload, ``record_type``, ``refers_to``.

    Packages are spread over tasks; a task reads its packages one after the other, a range at a time.
    """
    names = ["page_id", "url"] + ["payload"] * payloads + ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string()] + [pa.binary()] * payloads + [pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        for batch in batches:
            for name, size in zip(batch.column("file").to_pylist(), batch.column("bytes").to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as source:
                    held = []
                    for fields, block in records(Ranges(source, size)):
                        row = page_row(fields, block)
                        held.append(row if payloads else row[:2] + row[3:])
                        if len(held) == 500:
                            yield batch_of(held)
                            held = []
                    if held:
                        yield batch_of(held)

    schema = "page_id long, url string, " + "payload binary, " * payloads + "payload_bytes long, payload_digest string, record_type string, refers_to long"
    n = manifest.count()
    return manifest.select("file", "bytes").repartition(min(max(n, 1), 20_000)).mapInArrow(run, schema)
