"""ZIP packages read by ranges: the directory, the stored members, and nothing else.

The reader parses the end record, its ZIP64 form, and the central directory,
and finds where a stored member's bytes lie.  Bytes come from a ``RangeFile``,
so a package of any size is never read or extracted as a whole.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

# Record layouts and signatures of the ZIP format (fixed values).
_END = struct.Struct("<4s4H2LH")
_END64_LOCATOR = struct.Struct("<4sLQL")
_END64 = struct.Struct("<4sQ2H2L4Q")
_CENTRAL = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")
_END_SIG, _LOCATOR_SIG, _END64_SIG, _CENTRAL_SIG, _LOCAL_SIG = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
_ZIP64_EXTRA, _FULL32, _FULL16 = 0x0001, 0xFFFFFFFF, 0xFFFF
_MAX_COMMENT = 0xFFFF
STORED, DEFLATED, ENCRYPTED = 0, 8, 1


class PackageError(ValueError):
    """A file that is no readable ZIP package."""


class RangeFile:
    """Random access to a file of any store that pyarrow opens (a shared folder, HDFS, an object store)."""

    def __init__(self, uri: str):
        self.uri = uri
        fs, path = store(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, at: int, n: int) -> bytes:
        got = self.file.read_at(n, at)
        if len(got) != n:
            raise PackageError(f"{self.uri}: {n} bytes at {at} lie beyond the end")
        return got

    def close(self) -> None:
        self.file.close()


def store(uri: str):
    """The pyarrow file system of ``uri`` and the path in it."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    packed: int  # bytes in the package
    size: int    # bytes of the content
    header: int  # where its local header starts


@dataclass(frozen=True)
class _End:
    entries: int
    size: int
    offset: int
    shift: int  # bytes that precede the package in its file


def _find_end(f: RangeFile) -> _End:
    """The place of the central directory, from the end record or its ZIP64 form."""
    n = min(f.size, _END.size + _MAX_COMMENT)
    tail = f.read(f.size - n, n)
    at = len(tail) - _END.size
    while at >= 0:  # a comment can hold the signature, too: its length must lead to the file's end
        at = tail.rfind(_END_SIG, 0, at + 4)
        if at < 0:
            break
        if at + _END.size <= len(tail):
            _, disk, first_disk, here, entries, size, offset, comment = _END.unpack_from(tail, at)
            if at + _END.size + comment == len(tail):
                break
        at -= 1
    if at < 0:
        raise PackageError(f"{f.uri}: no end record")
    end_at = f.size - n + at
    directory_end = end_at
    if end_at >= _END64_LOCATOR.size:
        raw = f.read(end_at - _END64_LOCATOR.size, _END64_LOCATOR.size)
        sig, _, where, disks = _END64_LOCATOR.unpack(raw)
        if sig == _LOCATOR_SIG:
            if disks > 1:
                raise PackageError(f"{f.uri}: a package of several files")
            directory_end, wide = _end64(f, where, end_at - _END64_LOCATOR.size)
            disk, first_disk, here, entries, size, offset = wide
    if disk or first_disk or here != entries:
        raise PackageError(f"{f.uri}: a package of several files")
    shift = directory_end - size - offset
    if shift < 0:
        raise PackageError(f"{f.uri}: a directory of {size} bytes at {offset} does not fit")
    return _End(entries, size, offset, shift)


def _end64(f: RangeFile, where: int, locator_at: int):
    """(place, fields) of the ZIP64 end record; it precedes its locator where bytes were put before the package."""
    for at in (where, locator_at - _END64.size):
        if 0 <= at <= f.size - _END64.size:
            sig, _, _, _, disk, first_disk, here, entries, size, offset = _END64.unpack(f.read(at, _END64.size))
            if sig == _END64_SIG:
                return at, (disk, first_disk, here, entries, size, offset)
    raise PackageError(f"{f.uri}: no ZIP64 end record")


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """Fields that a 32-bit entry leaves to its ZIP64 extra field, in the order size, packed size, offset."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_EXTRA:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return tuple(next(values, v) if v == _FULL32 else v for v in (size, packed, header))
        at += 4 + n
    return size, packed, header


def members(f: RangeFile) -> list[Member]:
    """Every member of the central directory, in its order."""
    end = _find_end(f)
    raw = f.read(end.offset + end.shift, end.size)
    out, at = [], 0
    while at + _CENTRAL.size <= len(raw) and raw[at:at + 4] == _CENTRAL_SIG:
        (_, _, _, flags, method, _, _, _, packed, size, n_name, n_extra, n_comment, _, _, _,
         header) = _CENTRAL.unpack_from(raw, at)
        at += _CENTRAL.size
        name = raw[at:at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        size, packed, header = _wide(raw[at + n_name:at + n_name + n_extra], size, packed, header)
        out.append(Member(name, method, flags, packed, size, header + end.shift))
        at += n_name + n_extra + n_comment
    if len(out) & _FULL16 != end.entries & _FULL16:
        raise PackageError(f"{f.uri}: {len(out)} members in the directory of {end.entries}")
    return out


def data_start(f: RangeFile, m: Member) -> int:
    """Where a member's bytes start: its local header has a name and extra field of its own."""
    if m.flags & ENCRYPTED:
        raise PackageError(f"{f.uri}: {m.name} is encrypted")
    sig, *_, n_name, n_extra = _LOCAL.unpack(f.read(m.header, _LOCAL.size))
    if sig != _LOCAL_SIG:
        raise PackageError(f"{f.uri}: no local header of {m.name}")
    return m.header + _LOCAL.size + n_name + n_extra


def read_member(f: RangeFile, m: Member) -> bytes:
    """A whole (small) member: an index, stored or deflated."""
    raw = f.read(data_start(f, m), m.packed)
    if m.method == STORED:
        return raw
    if m.method == DEFLATED:
        return zlib.decompress(raw, -15)
    raise PackageError(f"{f.uri}: {m.name} is packed by method {m.method}")
