"""One named stream of a compound file (the container of older office and Hangul documents)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

# Fixed values of the format: signature, first reserved sector number, entry size, entry kinds.
SIGNATURE = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
RESERVED = 0xFFFFFFFA
ENTRY_BYTES = 128
STREAM, ROOT = 2, 5


def _integers(data: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(data) // 4}I", data[: len(data) // 4 * 4])


def _chain(start: int, table: tuple[int, ...]) -> Iterator[int]:
    """Sector numbers from ``start`` on; a damaged table cannot make it loop."""
    for _ in range(len(table)):
        if start >= RESERVED:
            return
        yield start
        start = table[start]


def read_stream(content: bytes, wanted: str) -> bytes | None:
    """Bytes of a stream of the root storage; null when there is none of that name."""
    if content[:8] != SIGNATURE:
        raise ValueError("not a compound file")
    shift, mini_shift = struct.unpack_from("<HH", content, 30)
    first_entry, _, cutoff, first_mini, _, first_list, _ = struct.unpack_from("<7I", content, 48)
    width, mini_width = 1 << shift, 1 << mini_shift

    def sector(number: int) -> bytes:
        return content[(number + 1) * width : (number + 2) * width]

    tables = list(_integers(content[76:512]))
    seen = 0
    while first_list < RESERVED and seen < len(content) // width:
        *more, first_list = _integers(sector(first_list))
        tables += more
        seen += 1
    fat = _integers(b"".join(sector(n) for n in tables if n < RESERVED))

    def read(start: int, size: int) -> bytes:
        return b"".join(sector(n) for n in _chain(start, fat))[:size]

    directory = read(first_entry, len(content))
    root = found = None
    for at in range(0, len(directory) - ENTRY_BYTES + 1, ENTRY_BYTES):
        length, kind = struct.unpack_from("<HB", directory, at + 64)
        start, size = struct.unpack_from("<IQ", directory, at + 116)
        name = directory[at : at + max(length - 2, 0)].decode("utf-16le", errors="ignore")
        if kind == ROOT:
            root = (start, size)
        elif kind == STREAM and name == wanted:
            found = (start, size)
    if found is None:
        return None
    start, size = found
    if size >= cutoff or root is None:
        return read(start, size)
    small = read(*root)
    mini_fat = _integers(read(first_mini, len(content)))
    parts = (small[n * mini_width : (n + 1) * mini_width] for n in _chain(start, mini_fat))
    return b"".join(parts)[:size]
