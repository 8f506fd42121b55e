import io
import sys
import zipfile
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))
import llm_cases
from ledgerline.llm import queries, warc_zip
from ledgerline.llm.store import written

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def through(pages, **options):
    folder, paths = warc_zip.write_packages(pages, **options)
    return warc_zip.read_packages(written(paths, "paths"), folder).collect()


def test_round_trip_with_odd_rows(spark):
    rows = [(5, "http://a/ b", "same"), (2, None, "same"), (None, "http://n", "same"), (7, "http://x\r\nEvil: 1", ""), (8, "u", None), (9, "u", "é\r\n\r\nWARC/1.1\r\n" * 300),
            (10, "u", "lone"), (10, "u", "lone"), (None, "u", "no id"), (None, "u", "no id"), (11, "u", "x" * 5_000_000)]
    got = through(llm_cases.clashing(spark.createDataFrame(rows, PAGES).repartition(3)))
    payload = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        least = min((k for k, _, h in rows if (h or "").encode() == raw and k is not None), default=None)
        refers = None if least is None or i == least else least
        want.append((str(i), len(raw), warc_zip.digest_of(raw), "revisit" if refers is not None else "response", refers))
        assert payload[warc_zip.digest_of(raw)] == raw
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted(want, key=key)


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = through(spark.createDataFrame(rows, PAGES), least_bytes=3)
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}


def test_whole_table_comes_back(spark):
    pages = queries.table(spark, SF, "pages")
    got = {r.page_id: r for r in through(pages)}
    for r in pages.collect():
        assert got[r.page_id].payload_digest == warc_zip.digest_of(r.html.encode())
    assert through(pages.limit(0)) == []


def package(comment=b"", records=3, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("datapackage.json", "{}")
        with z.open(zipfile.ZipInfo("archive/data.warc"), "w", force_zip64=True) as f:
            raws = [warc_zip.record(i, "u", b"p%d" % i, warc_zip.digest_of(b"p%d" % i), None) for i in range(records)]
            f.write(b"".join(raws))
        lines, at = [], 0
        for i, raw in enumerate(raws):
            lines.append('%d {"offset": %d, "length": %d, "filename": "data.warc"}' % (i, at, len(raw)))
            at += len(raw)
        z.writestr("indexes/index.cdxj", "\n".join(lines))
        z.comment = comment
    return out.getvalue()


def test_directories_with_and_without_zip64(monkeypatch):
    plain = package(b"a comment with PK\x05\x06 inside" + b"z" * 400)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)  # forces the ZIP64 records
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    large = package()
    assert warc_zip.END64 in large and warc_zip.END64 not in plain
    for raw in (plain, large):
        records = list(warc_zip.Package(io.BytesIO(raw)).records())
        assert [block[-2:] for _, block in records] == [b"p0", b"p1", b"p2"]
        assert all(fields["warc-type"] == "response" for fields, _ in records)


def test_broken_files_are_refused():
    raw = package()
    for bad in (b"", raw[:-30], raw[:100]):
        with pytest.raises(ValueError):
            list(warc_zip.Package(io.BytesIO(bad)).records())
    with pytest.raises(ValueError, match="not stored"):
        list(warc_zip.Package(io.BytesIO(package(method=zipfile.ZIP_DEFLATED))).records())


def test_packages_of_other_writers(tmp_path):
    """Gzipped indexes, numbers as text, lines about the index."""
    import gzip
    import io
    import json
    import zipfile

    body = lambda n: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/{n}\r\nContent-Length: 5\r\n\r\npage{n}\r\n\r\n".encode()
    records = [gzip.compress(body(n)) for n in range(3)]
    lines, at = [b'!meta {"format": "cdxj-gzip-1.0"}'], 0
    for n, r in enumerate(records):
        lines.append(b"com,x)/%d 2024 " % n + json.dumps({"url": f"http://x/{n}", "filename": "data.warc.gz", "offset": str(at), "length": str(len(r))}).encode())
        at += len(r)
    for name, how, raw in (("indexes/index.cdx.gz", zipfile.ZIP_STORED, gzip.compress(b"\n".join(lines))), ("indexes/index.cdxj", zipfile.ZIP_STORED, b"\n".join(lines))):
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            z.writestr("datapackage.json", "{}")
            z.writestr(zipfile.ZipInfo("archive/data.warc.gz"), b"".join(records))
            z.writestr("indexes/index.idx", b"com,x)/0 0 100")
            z.writestr(name, raw, compress_type=how)
        found = list(warc_zip.Package(packed).records())
        assert [f["warc-target-uri"] for f, _ in found] == [f"http://x/{n}" for n in range(3)] and [b for _, b in found] == [b"page%d" % n for n in range(3)]
