"""Reading ZIP packages by ranges: directories are parsed, stored members are located, nothing is
extracted. Layout numbers are those of the public ZIP format, ZIP64 included."""

import struct
from collections.abc import Callable
from dataclasses import dataclass

ReadAt = Callable[[int, int], bytes]  # offset, length

# Signatures of the format.
END = b"PK\x05\x06"
END64 = b"PK\x06\x06"
LOCATOR64 = b"PK\x06\x07"
ENTRY = b"PK\x01\x02"
LOCAL = b"PK\x03\x04"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


class BadArchive(ValueError):
    pass


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


def directory(read_at: ReadAt, size: int) -> dict[str, Member]:
    """Members by name, from the central directory."""
    tail_at = max(0, size - 22 - FULL16 - 20)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0 or end + 22 > len(tail):
        raise BadArchive("no end of central directory")
    count, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    locator = tail[max(0, end - 20) : end]
    if locator[:4] == LOCATOR64 and (count == FULL16 or FULL32 in (length, at)):
        head = read_at(struct.unpack("<Q", locator[8:16])[0], 56)
        if head[:4] != END64:
            raise BadArchive("no ZIP64 end of central directory")
        count, length, at = struct.unpack("<QQQ", head[32:56])
    listing, members, here = read_at(at, length), {}, 0
    for _ in range(count):
        if listing[here : here + 4] != ENTRY or here + 46 > len(listing):
            raise BadArchive("broken central directory")
        method = struct.unpack("<H", listing[here + 10 : here + 12])[0]
        packed, full, names, extras, notes = struct.unpack("<IIHHH", listing[here + 20 : here + 34])
        header_at = struct.unpack("<I", listing[here + 42 : here + 46])[0]
        name = listing[here + 46 : here + 46 + names].decode("utf-8", "replace")
        extra = listing[here + 46 + names : here + 46 + names + extras]
        wide = _wide_fields(extra)
        if full == FULL32:
            full, wide = wide[0], wide[1:]
        if packed == FULL32:
            packed, wide = wide[0], wide[1:]
        if header_at == FULL32:
            header_at = wide[0]
        members[name] = Member(name, method, packed, header_at)
        here += 46 + names + extras + notes
    return members


def _wide_fields(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            return list(struct.unpack(f"<{length // 8}Q", extra[at + 4 : at + 4 + length // 8 * 8]))
        at += 4 + length
    return []


def data_offset(read_at: ReadAt, member: Member) -> int:
    """Where the bytes of a stored member start."""
    if member.method != 0:
        raise BadArchive(f"{member.name} is compressed, not stored")
    head = read_at(member.header_at, 30)
    if head[:4] != LOCAL:
        raise BadArchive(f"no local header for {member.name}")
    names, extras = struct.unpack("<HH", head[26:30])
    return member.header_at + 30 + names + extras
