import io
import zipfile

import pytest

from saleslake.llm import warc, zip_archive
from saleslake.llm.tables import scratch, stored

PAGES = "page_id long, url string, html string, digest string"
BIG = "<p>é</p>" * 40


def round_trip(spark, rows, package_bytes=warc.PACKAGE_BYTES):
    pages = spark.createDataFrame(rows, PAGES)
    packages = stored(warc.write_packages(warc.classify(pages), scratch(spark), package_bytes))
    assert packages.selectExpr("coalesce(sum(n_records), 0)").first()[0] == len(rows)
    return sorted(warc.read_packages(packages).collect(), key=str)


def test_round_trip(spark):
    rows = [(5, "u", BIG, ""), (3, "v\r\nWARC-Type: x", BIG, ""), (9, None, BIG, ""), (None, "n", BIG, "")]
    rows += [(1, "a", "short", ""), (2, "b", "short", ""), (4, "", None, ""), (6, "", "", ""), (3, "w", BIG, "")]
    rows += [(7, "l", "x" * 6_000_000, ""), (8, "h", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20, "")]
    for package_bytes in (warc.PACKAGE_BYTES, 1):
        got = {(r.page_id, r.url): r for r in round_trip(spark, rows, package_bytes)}
        assert set(got) == {(r[0], r[1]) for r in rows}
        for page_id, url, html, _ in rows:
            r, payload = got[page_id, url], (html or "").encode()
            assert r.payload_bytes == len(payload)
            revisit = html == BIG and page_id != 3
            assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
            assert r.payload == (None if revisit else payload)


def test_no_pages(spark):
    assert round_trip(spark, []) == []


def test_directories():
    def members(raw):
        return zip_archive.directory(lambda at, n: raw[at : at + n], len(raw))

    for wide in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            with z.open("a", "w", force_zip64=wide) as f:
                f.write(b"hello")
            z.writestr("b", b"x" * 100, zipfile.ZIP_DEFLATED)
            z.comment = b"a comment"
        raw = out.getvalue()
        found = members(raw)
        at = zip_archive.data_offset(lambda at, n: raw[at : at + n], found["a"])
        assert raw[at : at + found["a"].size] == b"hello"
        with pytest.raises(zip_archive.BadArchive, match="compressed"):
            zip_archive.data_offset(lambda at, n: raw[at : at + n], found["b"])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:  # more members than 16 bits count
        for i in range(66_000):
            z.writestr(str(i), b"")
    assert len(members(out.getvalue())) == 66_000
    with pytest.raises(zip_archive.BadArchive):
        members(b"no archive")
