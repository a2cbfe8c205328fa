"""WARC archives in ZIP packages (operator 11).

A package holds stored WARC members (``archive/*.warc.gz``, a gzip member per
record) and an index of their records (``indexes/*.cdxj``).  Writing tasks
stream records into packages of bounded size; reading tasks parse a package's
directory and index, and fetch runs of records by range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.llm.common import drop_worker_cache, shuffle_partitions, slices
from wardflow.llm.zip_package import STORED, PackageError, RangeFile, data_start, members, read_member, store
from wardflow.session import owned_dir
from wardflow.sources.tables import read_table

ARCHIVE = re.compile(r"\.warc(\.gz)?$")
INDEX = re.compile(r"\.cdxj?$")
_NAME = "archive/data.warc.gz"
_UNFIT = re.compile(r"[\x00-\x20\x7f]")  # characters that can't stand in a header line's URL
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    value = urn[len("<urn:page:"):-1] if urn else "null"
    return None if value == "null" else int(value)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 date: str) -> tuple[bytes, str]:
    """A WARC record and its payload digest; a revisit has the HTTP head of the page but no payload."""
    digest = sha1_base32(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_urn(page_id)}",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url:
        lines.append(f"WARC-Target-URI: {_UNFIT.sub(lambda m: f'%{ord(m[0]):02X}', url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_page_urn(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a response's payload is held against its digest."""
    head, cut, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not cut:
        raise PackageError("no WARC record at this place")
    warc = _headers(head)
    n = int(warc["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise PackageError(f"record {warc.get('warc-record-id')}: its block does not end where its length says")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    n_payload = int(_headers(http)["content-length"])
    digest = warc["warc-payload-digest"].partition(":")[2]
    if not revisit and (len(payload) != n_payload or sha1_base32(payload) != digest):
        raise PackageError(f"record {warc.get('warc-record-id')}: payload and digest differ")
    return {"page_id": _page_id(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
            "payload_bytes": n_payload, "payload_digest": digest, "record_type": warc["warc-type"],
            "refers_to": _page_id(warc.get("warc-refers-to")), "payload": None if revisit else payload}


# ---- writing ----------------------------------------------------------------

def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with refers_to and revisit.

    Rows of equal payload (at least ``min_bytes``) revisit the one with the
    smallest page_id (null last).  Rows that repeat the first one's page_id and payload are all
    responses.  Only ids and digests are grouped by payload, so a frequent payload is
    counted map-side; the html itself meets its mark by (page_id, digest).
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = own.select("*", F.sha2("html", 256).alias("digest"))
    sized = keyed.select("page_id", "digest", F.octet_length("html").alias("size"))
    groups = (sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("size").alias("size"), F.count("*").alias("n"))
              .where(f"n > 1 AND size >= {int(min_bytes)}").select("digest", "first"))
    again = (sized.join(groups, "digest").where("NOT page_id <=> first")
             .select("page_id", "digest", F.col("first").alias("refers_to")).distinct())
    marks = again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to", F.lit(True).alias("revisit"))
    return keyed.join(marks, F.expr("page_id <=> p AND digest = d"), "left").select(
        "page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))


class _Package:
    """One package being written: records stream into a stored member, index lines follow at the end."""

    def __init__(self, uri: str):
        fs, path = store(uri)
        self.uri, self.stream = uri, fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(_NAME, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, raw: bytes, key: str, stamp: str, fields: dict) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self.member.write(packed)
        self.index.append(f"{key} {stamp} " + json.dumps({**fields, "filename": _NAME, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr("indexes/index.cdxj", "\n".join(sorted(self.index)) + "\n")
        self.zip.close()
        self.stream.close()
        return self.uri, self.at, len(self.index)


PACKAGE_DDL = "path STRING, bytes BIGINT, n_records BIGINT"
_PACKAGE = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("n_records", pa.int64())])


def write_packages(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0,
                   package_bytes: int = 256 << 20) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the written packages.

    A null html is an empty payload, a null or empty url has no target line.
    A task closes a package at ``package_bytes``.  Every attempt
    of a task writes files of its own, and the table of packages names only those of the attempts that
    Spark committed: a lost executor leaves unnamed files, never half of a package.  Other columns are not read.
    """
    spark = pages.sparkSession
    store(folder)[0].create_dir(store(folder)[1], recursive=True)
    stamp = re.sub(r"\D", "", date)

    def run(batches):
        drop_worker_cache()
        task, now = TaskContext.get(), None
        tag = f"{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex}"
        done: list[tuple] = []
        for rows in slices(batches, 256):
            for page, url, html, refers, revisit in zip(*(c.to_pylist() for c in rows.columns)):
                raw, digest = build_record(page, url, html.encode(), refers, revisit, date)
                now = now or _Package(f"{folder}/part-{tag}-{len(done)}.wacz")
                now.add(raw, _UNFIT.sub("_", url or "-"), stamp,
                        {"url": url, "digest": f"sha1:{digest}", "mime": "warc/revisit" if revisit else "text/html", "status": "200"})
                if now.at >= package_bytes:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [[]] * 3, _PACKAGE)],
                                         schema=_PACKAGE)
    written = mark_revisits(pages, min_bytes).mapInArrow(run, PACKAGE_DDL)
    written.write.parquet(f"{folder}/packages")
    return spark.read.schema(PACKAGE_DDL).parquet(f"{folder}/packages")


# ---- reading ----------------------------------------------------------------

def index_entries(f: RangeFile, found: list) -> Iterator[tuple[int, int, bool]]:
    """(place in the package, length, packed) of every record that the package's indexes name."""
    archives = {m.name: (data_start(f, m), m) for m in found if m.method == STORED and ARCHIVE.search(m.name)}
    short = {name.rpartition("/")[2]: name for name in archives}
    for m in found:
        if not INDEX.search(m.name):
            continue
        for line in read_member(f, m).decode().splitlines():
            if not line.strip():
                continue
            entry = json.loads(line[line.index("{"):])
            name = entry["filename"] if entry["filename"] in archives else short.get(entry["filename"].rpartition("/")[2])
            if name is None:
                raise PackageError(f"{f.uri}: no stored member {entry['filename']}")
            start, archive = archives[name]
            at, n = int(entry["offset"]), int(entry["length"])
            if at + n > archive.size:
                raise PackageError(f"{f.uri}: a record of {n} bytes at {at} lies beyond {name}")
            yield start + at, n, name.endswith(".gz")


_RUN = pa.schema([("path", pa.string()), ("start", pa.int64()), ("sizes", pa.list_(pa.int64())), ("packed", pa.bool_())])
_RUN_DDL = "path STRING, start BIGINT, sizes ARRAY<BIGINT>, packed BOOLEAN"


def _runs(path: str, run_bytes: int) -> list[tuple]:
    """Adjacent records of a package, gathered to runs that one range request fetches."""
    f = RangeFile(path)
    try:
        out, end, size = [], None, 0
        for at, n, packed in sorted(set(index_entries(f, members(f)))):
            if at != end or size + n > run_bytes or out[-1][3] != packed:
                out.append((path, at, [], packed))
                size = 0
            out[-1][2].append(n)
            end, size = at + n, size + n
        return out
    finally:
        f.close()


RECORD_DDL = ("page_id BIGINT, url STRING, payload_bytes BIGINT, payload_digest STRING, record_type STRING, "
              "refers_to BIGINT, payload BINARY")
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_packages(packages: DataFrame, run_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """Every record of ``packages`` (path): its fields and, unless ``payloads`` is false, its payload.

    One task a package parses its directory and index; the runs of records it names
    are dealt to all tasks, so a large package is read by many.  A revisit has a null payload.
    """
    spark = packages.sparkSession

    def locate(batches):
        for rows in slices(batches, 16):
            for path in rows.column(0).to_pylist():
                found = _runs(path, run_bytes)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _RUN)], schema=_RUN)

    def fetch(batches):
        held: dict[str, RangeFile] = {}
        for rows in slices(batches, 1):
            (path,), (start,), (sizes,), (packed,) = (c.to_pylist() for c in rows.columns)
            if path not in held:
                for f in held.values():
                    f.close()
                held = {path: RangeFile(path)}
            raw, at, out = held[path].read(start, sum(sizes)), 0, []
            for n in sizes:
                one = raw[at:at + n]
                out.append(parse_record(zlib.decompress(one, 31) if packed else one))
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if f.name == "payload" and not payloads else r[f.name] for r in out], f.type) for f in _RECORD],
                schema=_RECORD)
    n = shuffle_partitions(spark)
    runs = packages.select("path").repartition(n, "path").mapInArrow(locate, _RUN_DDL)
    return runs.repartition(n, "path", "start").mapInArrow(fetch, RECORD_DDL)


def op11_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records in ZIP packages and read back by range: one row per page."""
    packages = write_packages(read_table(spark, sf_dir, "pages"), owned_dir(spark, "llm-warc"))
    return read_packages(packages, payloads=False).drop("url", "payload")


# Base 32 of a hex digest: eight groups of five hex digits give four letters each.
_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP11_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, hex, octet_length(encode(html)) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS owner FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {" || ".join(
    f"substr({_BASE32}, CAST((CAST('0x' || substr(hex, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31 AS BIGINT) + 1, 1)"
    for g in range(8) for s in (15, 10, 5, 0))} AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM d
"""
