"""Blocked gzip: gzip members of at most 64 KB that carry their own compressed size.

Any gzip program reads such a file as one stream. Here the sizes let a task begin in the middle: the next member is found by its
header, and taken only if it inflates with a right checksum and another member (or the end of the file) follows it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: Bytes of text in a member, and of a whole member, at most.
TEXT, MEMBER = 65_280, 1 << 16
#: Header up to the extra field's length, and the subfield that holds the member's size less one (fixed values of the format).
_HEAD, _SIZE = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
_START = _HEAD + b"\x00\x00\x00\x00\x00\xff\x06\x00" + _SIZE
#: The empty member that ends a file.
END = _START + struct.pack("<H", 27) + b"\x03\x00" + bytes(8)
#: How much is read at once.
READ = 4 << 20


def member(text: bytes, level: int = 6) -> bytes:
    """One member of at most `TEXT` bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(text) + packer.flush()
    if len(packed) > MEMBER - 26:
        return member(text, 0) if level else member(text[: len(text) // 2], 0) + member(text[len(text) // 2:], 0)
    return _START + struct.pack("<H", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(text), len(text))


def members(text: bytes, level: int = 6) -> bytes:
    return b"".join(member(text[at:at + TEXT], level) for at in range(0, len(text), TEXT))


def size_at(data: bytes, at: int = 0) -> int | None:
    """Size of the member that begins at `at`, as its header says; None if none does or the header is cut off."""
    if data[at:at + 4] != _HEAD or len(data) < at + 12:
        return None
    extra = data[at + 12:at + 12 + struct.unpack_from("<H", data, at + 10)[0]]
    while len(extra) >= 6:
        if extra[:4] == _SIZE:
            return struct.unpack_from("<H", extra, 4)[0] + 1
        extra = extra[4 + struct.unpack_from("<H", extra, 2)[0]:]
    return None


def inflated(data: bytes) -> bytes:
    """The text of one whole member, with its checksum tested."""
    opened = zlib.decompressobj(31)
    text = opened.decompress(data)
    if not opened.eof or opened.unused_data:
        raise zlib.error("not one member")
    return text


def is_blocked(file) -> bool:
    """Whether a file (with `read_at(count, place)` and `size()`) begins with a member that says its size."""
    return size_at(file.read_at(64, 0)) is not None


def _is_member(file, at: int, total: int) -> int | None:
    """The size of the member at `at` if one is there for certain."""
    size = size_at(file.read_at(64, at))
    if size is None or at + size > total:
        return None
    try:
        inflated(file.read_at(size, at))
    except zlib.error:
        return None
    return size if at + size == total or size_at(file.read_at(64, at + size)) is not None else None


def first_member(file, start: int, stop: int) -> int | None:
    """Where the first member at or behind `start` begins; None if that is not before `stop`."""
    total = file.size()
    while start < stop:
        data = file.read_at(MEMBER + len(_HEAD), start)
        at = data.find(_HEAD)
        while at >= 0:
            if start + at >= stop:
                return None
            if _is_member(file, start + at, total) is not None:
                return start + at
            at = data.find(_HEAD, at + 1)
        if len(data) <= MEMBER:
            return None
        start += MEMBER
    return None


def byte_before(file, at: int) -> bytes:
    """The last byte of text before the member at `at`; empty at the start of the file."""
    while at > 0:
        first = max(0, at - MEMBER)
        data = file.read_at(at - first, first)
        found = data.rfind(_HEAD)
        while found >= 0 and (size_at(data, found) != len(data) - found or _is_member(file, first + found, file.size()) is None):
            found = data.rfind(_HEAD, 0, found)
        if found < 0:
            raise ValueError("a member is not preceded by another one")
        text = inflated(data[found:])
        if text:
            return text[-1:]
        at = first + found
    return b""


def read(file, start: int, at_once: int = READ) -> Iterator[tuple[int, bytes]]:
    """Place and text of each member from the one at `start` on; a damaged member is an error. The file is read `at_once` bytes at a time."""
    held, base = b"", start
    while True:
        more = file.read_at(at_once, base + len(held))
        held += more
        if not held:
            return
        at = 0
        while at < len(held):
            size = size_at(held, at)
            if size is None or at + size > len(held):
                break
            text = inflated(held[at:at + size])
            if text:
                yield base + at, text
            at += size
        if at == 0 and not more:
            raise ValueError(f"no whole member at byte {base}")
        held, base = held[at:], base + at
