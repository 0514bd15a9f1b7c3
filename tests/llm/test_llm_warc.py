import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from tablewright.llm import warczip

PAGES = "page_id long, url string, html string, digest string, refers_to long, payload string"
BIG = "<html>" + "ä" * 200 + "</html>"


def ranges(data):
    return warczip.Ranges(pa.BufferReader(data), len(data))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "y") for r in rows], PAGES).repartition(3)


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}?a=b c", BIG + str(i % 7)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (None, "n", BIG + "3"), (104, "ü\n", "x" * 100), (105, "v", "x" * 100)]
    rows += [(200, "w", "x" * 300_000), (200, "w", "x" * 300_000)]
    path = str(tmp_path / "w")
    manifest = warczip.write_packages(pages(spark, rows), path, package_bytes=4000)
    assert manifest.count() > 3
    got = warczip.read_packages(spark, path, manifest).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = i is not None and first.get(h, i) != i
        want.append((i, None if again else raw, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                     first[h] if again else None))
    columns = ("page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(bytes(r[c]) if isinstance(r[c], (bytes, bytearray)) else r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)
    assert {r["url"] for r in got if r["page_id"] == 104} == {"%C3%BC%0A"}


def test_empty_table(spark, tmp_path):
    manifest = warczip.write_packages(pages(spark, []), str(tmp_path / "e"))
    assert manifest.count() == 0 and warczip.read_packages(spark, str(tmp_path / "e"), manifest).count() == 0


def package(comment=b"", method=zipfile.ZIP_STORED, n=3):
    data, lines, at = [], [], 0
    for i in range(n):
        raw = warczip.record(i, "http://x", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None)
        lines.append('x 2000 {"offset": "%d", "length": "%d", "filename": "data.warc.gz"}\n' % (at, len(raw)))
        data.append(raw)
        at += len(raw)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("pages/pages.jsonl", "{}")
        z.writestr(zipfile.ZipInfo(warczip.DATA), b"".join(data), compress_type=method)
        z.writestr(warczip.INDEX, "".join(lines))
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"a comment", b"with PK\x05\x06 inside " + bytes(30)])
def test_foreign_package(comment):
    found = [warczip.page_row(*r) for r in warczip.records(ranges(package(comment)))]
    assert [r[0] for r in found] == [0, 1, 2] and found[1][2] == b"payload 1"


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 40)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = package()
    assert warczip.END64 in data and warczip.END64_LOCATOR in data
    assert {m.name: m.size for m in warczip.members(ranges(data))} == {i.filename: i.file_size for i in zipfile.ZipFile(io.BytesIO(data)).infolist()}
    assert len(list(warczip.records(ranges(data)))) == 3


def test_reads_only_ranges():
    class Counting(warczip.Ranges):
        total = 0

        def read(self, place, length):
            self.total += length
            return super().read(place, length)

    data = package(n=4000)
    file = Counting(pa.BufferReader(data), len(data))
    wanted = list(warczip.places(file))
    before = file.total
    place, length = wanted[2000]
    import zlib
    fields, _ = warczip.parse_record(zlib.decompress(file.read(place, length), 31))
    assert fields["warc-record-id"] == "<urn:page:2000>" and file.total - before == length


def test_refusals():
    with pytest.raises(ValueError, match="not stored"):
        list(warczip.records(ranges(package(method=zipfile.ZIP_DEFLATED, n=50))))
    with pytest.raises(ValueError, match="not a ZIP"):
        warczip.members(ranges(b"x" * 100))
    fields, block = warczip.parse_record(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 5\r\n\r\na\r\n\r\n\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        warczip.page_row(fields, block)
