"""Members of a ZIP file by its directories, read by ranges; ZIP64 too. Nothing is extracted."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

# Fixed values of the format: signatures, sizes of the fixed parts, and the marks for "see ZIP64".
END, END64, LOCATOR, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_SIZE, LOCATOR_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 56, 20, 46, 30
MOST_COMMENT = 0xFFFF
IN_64, IN_64_SHORT, EXTRA_64 = 0xFFFFFFFF, 0xFFFF, 1
STORED, DEFLATED = 0, 8

Read = Callable[[int, int], bytes]  # (offset, length) -> bytes


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int

    def begin(self, read: Read) -> int:
        """Where the bytes of the member begin: behind its local header, whose name and extra fields have sizes of their own."""
        head = read(self.header, LOCAL_SIZE)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header at {self.header} for {self.name}")
        name, extra = struct.unpack_from("<HH", head, 26)
        return self.header + LOCAL_SIZE + name + extra

    def content(self, read: Read) -> bytes:
        """The whole member, for small ones such as indexes."""
        packed = read(self.begin(read), self.packed)
        if self.method == STORED:
            return packed
        if self.method == DEFLATED:
            return zlib.decompress(packed, -zlib.MAX_WBITS)
        raise ValueError(f"{self.name} is packed by method {self.method}")


def members(read: Read, size: int) -> list[Member]:
    """The members that the central directory lists, in its order. `size`: of the whole file."""
    tail_at = max(0, size - END_SIZE - MOST_COMMENT - LOCATOR_SIZE)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and not (at + END_SIZE <= len(tail) and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(END, 0, at)  # the mark may turn up within the comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HLL", tail, at + 10)
    locator = tail[at - LOCATOR_SIZE:at] if at >= LOCATOR_SIZE else b""
    if locator[:4] == LOCATOR:
        end64 = read(struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory where the locator points")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    elif count == IN_64_SHORT or IN_64 in (length, start):
        raise ValueError("the directory needs ZIP64 fields, and the file has no locator")
    directory, found, at = read(start, length), [], 0
    while len(found) < count:
        if directory[at:at + 4] != CENTRAL:
            raise ValueError(f"the central directory breaks off after {len(found)} of {count} members")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, size_, name_n, extra_n, comment_n = struct.unpack_from("<LLHHH", directory, at + 20)
        header = struct.unpack_from("<L", directory, at + 42)[0]
        name = directory[at + CENTRAL_SIZE:at + CENTRAL_SIZE + name_n]
        extra = directory[at + CENTRAL_SIZE + name_n:at + CENTRAL_SIZE + name_n + extra_n]
        size_, packed, header = wide(extra, size_, packed, header)
        found.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, packed, size_, header))
        at += CENTRAL_SIZE + name_n + extra_n + comment_n
    return found


def wide(extra: bytes, *values: int) -> list[int]:
    """The values, those that are marked as too large taken from the ZIP64 extra field, in this order."""
    at, field = 0, b""
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA_64:
            field = extra[at + 4:at + 4 + n]
        at += 4 + n
    out, at = [], 0
    for value in values:
        if value == IN_64:
            if at + 8 > len(field):
                raise ValueError("a ZIP64 value is missing")
            value = struct.unpack_from("<Q", field, at)[0]
            at += 8
        out.append(value)
    return out
