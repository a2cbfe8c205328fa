"""Operator 11: the ZIP reader against zipfile, records against their pages."""

from __future__ import annotations

import io
import zipfile

import pytest

from wardflow.llm import warc, zip_package as Z
from wardflow.session import shared_dir


def _write(path, entries, comment=b"", prefix=b"", stream=False):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for name, data, method in entries:
            z.writestr(zipfile.ZipInfo(name), data, method)
        z.comment = comment
    path.write_bytes(prefix + raw.getvalue())
    return Z.RangeFile(f"file://{path}")


ENTRIES = [("archive/a.warc", b"x" * 1000, zipfile.ZIP_STORED), ("indexes/ü.cdxj", b"line\n" * 50, zipfile.ZIP_DEFLATED),
           ("empty", b"", zipfile.ZIP_STORED)]


@pytest.mark.parametrize("comment", [b"", b"a comment", b"PK\5\6 in a comment that looks like an end record"])
@pytest.mark.parametrize("prefix", [b"", b"bytes before the package"])
@pytest.mark.parametrize("wide", [False, True])
def test_directory(tmp_path, monkeypatch, comment, prefix, wide):
    if wide:  # force the 64-bit forms on a small file
        for name in ("ZIP64_LIMIT", "ZIP_FILECOUNT_LIMIT"):
            monkeypatch.setattr(zipfile, name, 1)
    f = _write(tmp_path / "p.zip", ENTRIES, comment, prefix)
    if wide:
        assert b"PK\6\6" in (tmp_path / "p.zip").read_bytes()
    found = Z.members(f)
    assert [(m.name, m.size) for m in found] == [(n, len(d)) for n, d, _ in ENTRIES]
    assert [Z.read_member(f, m) for m in found] == [d for _, d, _ in ENTRIES]
    at = Z.data_start(f, found[0])
    assert f.read(at + 10, 5) == b"xxxxx"


def test_bad_packages(tmp_path):
    good = _write(tmp_path / "g.zip", ENTRIES)
    raw = (tmp_path / "g.zip").read_bytes()
    for name, data in (("short", raw[:-30]), ("none", b"no package at all"), ("empty", b""), ("cut", raw[:200] + raw[-60:])):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Z.PackageError):
            Z.members(Z.RangeFile(f"file://{tmp_path / name}"))
    m = Z.members(good)[0]
    with pytest.raises(Z.PackageError):
        Z.data_start(good, Z.Member(m.name, m.method, Z.ENCRYPTED, m.packed, m.size, m.header))
    with pytest.raises(Z.PackageError):
        Z.data_start(good, Z.Member(m.name, m.method, 0, m.packed, m.size, m.header + 1))
    with pytest.raises(Z.PackageError):
        Z.read_member(good, Z.Member(m.name, 12, 0, m.packed, m.size, m.header))
    empty = _write(tmp_path / "e.zip", [])
    assert Z.members(empty) == []


def test_index_names_missing_member(tmp_path):
    f = _write(tmp_path / "p.zip", [("indexes/i.cdxj", b'k 1 {"filename": "no.warc", "offset": "0", "length": "5"}\n', 0)])
    with pytest.raises(Z.PackageError):
        list(warc.index_entries(f, Z.members(f)))
    f = _write(tmp_path / "q.zip", [("archive/a.warc", b"12345", 0),
                                    ("indexes/i.cdxj", b'k 1 {"filename": "a.warc", "offset": "1", "length": "5"}\n', 0)])
    with pytest.raises(Z.PackageError):
        list(warc.index_entries(f, Z.members(f)))


def test_uncompressed_archive(tmp_path, spark):
    """A plain .warc member, named in the index without its folder."""
    one, _ = warc.build_record(1, "http://a/", b"hello", None, False, "2024-01-01T00:00:00Z")
    two, _ = warc.build_record(2, None, b"hello", 1, True, "2024-01-01T00:00:00Z")
    lines = "".join(f'k 2 {{"filename": "a.warc", "offset": {at}, "length": {n}}}\n' for at, n in ((0, len(one)), (len(one), len(two))))
    _write(tmp_path / "p.wacz", [("archive/a.warc", one + two, 0), ("indexes/i.cdxj", lines.encode(), zipfile.ZIP_DEFLATED)])
    got = warc.read_packages(spark.createDataFrame([(f"file://{tmp_path}/p.wacz",)], "path STRING")).collect()
    assert sorted((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload and bytes(r.payload)) for r in got) == [
        (1, "http://a/", "response", None, 5, b"hello"), (2, None, "revisit", 1, 5, None)]


def test_damaged_record():
    raw, _ = warc.build_record(1, "u", b"hello", None, False, "2024-01-01T00:00:00Z")
    assert warc.parse_record(raw)["payload"] == b"hello"
    for bad in (raw.replace(b"hello", b"hallo"), raw[:-1], b"GARBAGE" + raw):
        with pytest.raises(Z.PackageError):
            warc.parse_record(bad)


PAGES = [(5, "http://a/x y\r\nEvil: 1", "same"), (3, None, "same"), (3, "", "same"), (4, "u", None), (9, "u", ""),
         (None, "n", "same"), (None, None, "only null ids"), (None, "m", "only null ids"), (7, "l", "long é\U0001f600" * 200_000),
         (8, "w", "HTTP/1.1 200 OK\r\n\r\n\r\nWARC/1.1\r\n"), (2, "v", "unique")]
PAGES_DDL = "page_id BIGINT, url STRING, html STRING"


@pytest.mark.parametrize("package_bytes", [1, 1 << 28])
def test_round_trip(spark, package_bytes):
    """Nulls, ties, empty and long payloads, payloads that look like records; any package size."""
    frame = spark.createDataFrame([(*r, "x", 1) for r in PAGES], PAGES_DDL + ", payload STRING, path BIGINT").coalesce(2)
    packages = warc.write_packages(frame, shared_dir(spark, "warc-test"), package_bytes=package_bytes)
    assert packages.agg({"n_records": "sum"}).first()[0] == len(PAGES)
    got = warc.read_packages(packages, run_bytes=100).collect()
    want = []
    for page, url, html in PAGES:
        payload = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "").encode() == payload]
        first = min((p for p in ids if p is not None), default=None)
        revisit = page != first
        want.append((page, len(payload), warc.sha1_base32(payload), "revisit" if revisit else "response",
                     first if revisit else None, None if revisit else payload))

    def key(t):
        return repr(t)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    assert {r.url for r in got} == {"http://a/x%20y%0D%0AEvil:%201", None, "u", "n", "m", "l", "w", "v"}


def test_least_size_and_empty_table(spark):
    frame = spark.createDataFrame(PAGES, PAGES_DDL)
    kinds = {(r.page_id, r.html): r.revisit for r in warc.mark_revisits(frame, min_bytes=5).collect()}
    assert not any(kinds.values())  # "same" has four bytes; the longer equal pair has null ids
    none = warc.write_packages(frame.limit(0), shared_dir(spark, "warc-test"))
    assert none.count() == 0 and warc.read_packages(none).count() == 0
