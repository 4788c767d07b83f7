"""Byte ranges of files inside tasks: zip directories, zip entries, image headers.

A file is opened where its scheme says (``pyarrow.fs``: local, hdfs, s3, gs,
abfs) and only the asked-for ranges are read.
"""

from __future__ import annotations

import codecs
import io
import struct
import zlib
from collections.abc import Iterator

from pyarrow import fs

CHUNK = 1 << 20
_END, _END64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def open_file(path: str):
    """A seekable reader of *path* (as Spark's listing names it)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def write_file(path: str, data: bytes) -> None:
    """*data* as the file *path*, whose folder is made if it is missing."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, inner = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(inner) as out:
        out.write(data)


def _at(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    return f.read(size)


def _directory_place(f, length: int) -> tuple[int, int, int]:
    """(offset, size, shift) of the central directory; shift is what stands before the archive proper."""
    tail = _at(f, max(0, length - 65_557), min(length, 65_557))
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no zip directory")
    end = max(0, length - 65_557) + at
    size, offset = struct.unpack("<LL", tail[at + 12:at + 20])
    entries = struct.unpack("<H", tail[at + 10:at + 12])[0]
    if 0xFFFF in (entries,) or 0xFFFFFFFF in (size, offset):
        locator = _at(f, end - 20, 20)
        if locator[:4] == _LOCATOR64:
            place = struct.unpack("<Q", locator[8:16])[0]
            record = _at(f, place, 56)
            if record[:4] != _END64:
                raise ValueError("no zip64 directory")
            size, offset = struct.unpack("<QQ", record[40:56])
            end = place
    return offset, size, end - size - offset


def zip_directory(f, length: int) -> Iterator[tuple[str, int, int, int, int, int, int]]:
    """(name, offset, compressed, size, method, flags, crc) of every entry, the directory being read piece by piece."""
    offset, left, shift = _directory_place(f, length)
    f.seek(offset + shift)
    held, at = b"", 0

    def need(n: int) -> None:
        nonlocal held, at, left
        while len(held) - at < n:
            more = f.read(min(CHUNK, left)) if left else b""
            if not more:
                raise ValueError("zip directory ends early")
            left -= len(more)
            held, at = held[at:] + more, 0

    while left or at < len(held):
        need(46)
        if held[at:at + 4] != b"PK\x01\x02":
            break
        flags, method = struct.unpack("<HH", held[at + 8:at + 12])
        crc, compressed, size, n, x, c = struct.unpack("<LLLHHH", held[at + 16:at + 34])
        place = struct.unpack("<L", held[at + 42:at + 46])[0]
        need(46 + n + x + c)
        name = held[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437", "replace")
        extra = held[at + 46 + n:at + 46 + n + x]
        at += 46 + n + x + c
        while len(extra) >= 4:  # zip64: the sizes that did not fit, in this order
            kind, k = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[4:4 + k // 8 * 8]))
                size = next(wide) if size == 0xFFFFFFFF else size
                compressed = next(wide) if compressed == 0xFFFFFFFF else compressed
                place = next(wide) if place == 0xFFFFFFFF else place
            extra = extra[4 + k:]
        yield name, place + shift, compressed, size, method, flags, crc


def zip_entry(f, offset: int, compressed: int, method: int, flags: int, crc: int) -> Iterator[bytes]:
    """The bytes of one entry, piece by piece; a wrong checksum, encryption or an unknown method is an error."""
    if flags & 1 or method not in (0, 8):
        raise ValueError(f"zip entry with flags {flags} and method {method} cannot be read")
    n, x = struct.unpack("<HH", _at(f, offset + 26, 4))
    f.seek(offset + 30 + n + x)
    inflate, seen, left = zlib.decompressobj(-15), 0, compressed
    while left:
        raw = f.read(min(CHUNK, left))
        if not raw:
            raise ValueError("zip entry ends early")
        left -= len(raw)
        while raw:
            piece = raw if method == 0 else inflate.decompress(raw, CHUNK)
            raw = b"" if method == 0 else inflate.unconsumed_tail
            seen = zlib.crc32(piece, seen)
            if piece:
                yield piece
    if method == 8:
        piece = inflate.flush()
        seen = zlib.crc32(piece, seen)
        if piece:
            yield piece
    if seen != crc:
        raise ValueError("zip entry has a wrong checksum")


def text_lines(pieces: Iterator[bytes]) -> Iterator[str]:
    """Lines of UTF-8 *pieces*, ended by \\n, \\r\\n or \\r as the line reader has it (no line after a last end)."""
    decode = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder("utf-8")("replace"), translate=True)
    held = ""
    for piece in pieces:
        *lines, held = (held + decode.decode(piece)).split("\n")
        yield from lines
    *lines, held = (held + decode.decode(b"", final=True)).split("\n")
    yield from lines
    if held:
        yield held


def image_header(f, length: int) -> tuple[int, int, int] | None:
    """(width, height, channels) from a JPEG, PNG, BMP or GIF header; None for anything else."""
    head = _at(f, 0, 64)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and head[12:16] == b"IHDR":
        width, height, _, kind = struct.unpack(">LLBB", head[16:26])
        return width, height, {0: 1, 2: 3, 4: 1, 6: 4}.get(kind) or _palette_channels(f, length)
    if head[:2] == b"BM" and len(head) >= 30:
        width, height, _, bits = struct.unpack("<llHH", head[18:30])
        return width, abs(height), 4 if bits == 32 else 3
    if head[:6] in (b"GIF87a", b"GIF89a"):
        width, height = struct.unpack("<HH", head[6:10])
        return width, height, 3
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 4 <= length:  # from marker to marker
            mark = _at(f, at, 10)
            if len(mark) < 4 or mark[0] != 0xFF:
                return None
            if mark[1] == 0xFF or mark[1] == 0x01 or 0xD0 <= mark[1] <= 0xD8:
                at += 1 if mark[1] == 0xFF else 2
            elif 0xC0 <= mark[1] <= 0xCF and mark[1] not in (0xC4, 0xC8, 0xCC):
                height, width, parts = struct.unpack(">HHB", mark[5:10])
                return width, height, parts
            elif mark[1] in (0xD9, 0xDA):
                return None
            else:
                at += 2 + struct.unpack(">H", mark[2:4])[0]
    return None


def _palette_channels(f, length: int) -> int:
    """4 if a palette PNG has a transparency chunk before its data, else 3."""
    at = 8
    while at + 8 <= length:
        n, kind = struct.unpack(">L4s", _at(f, at, 8))
        if kind in (b"tRNS", b"IDAT"):
            return 4 if kind == b"tRNS" else 3
        at += 12 + n
    return 3
