"""Compressed bundles of files: header, block list and directory, unpacked block by block.

Layout (fixed values of the format): the text UnityFS and a zero, then big-endian: int32 format, two texts, int64 size, uint32 packed and
plain size of the index, uint32 flags. Flags: the low six bits name the packing of the index (0 plain, 1 LZMA, 2 and 3 LZ4), 0x80 puts
the index at the end, 0x200 aligns the blocks. Formats from 7 up align the index to 16 bytes. The index holds 16 bytes of digest, the
blocks (uint32 plain and packed size, uint16 flags) and the directory (int64 offset and size, uint32 flags, text path).
"""

from __future__ import annotations

import lzma
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

MAGIC, LZMA_HEAD = b"UnityFS\0", 5
#: Unpacked bytes kept in memory; a larger bundle goes to a file in the task's temporary folder.
IN_MEMORY = 100 << 20


class BundleError(ValueError):
    """Bytes that hold no readable bundle."""


def lz4_block(data: bytes, size: int) -> bytes:
    """A plain LZ4 block of a known size."""
    out, at = bytearray(), 0

    def count(n: int) -> int:
        nonlocal at
        while n >= 15 and (more := data[at]) is not None:
            at += 1
            n += more
            if more < 255:
                break
        return n

    try:
        while at < len(data):
            token = data[at]
            at += 1
            n = count(token >> 4)
            out += data[at : at + n]
            at += n
            if at >= len(data):
                break
            back = data[at] | data[at + 1] << 8
            at += 2
            n = count(token & 15) + 4
            start = len(out) - back
            if not 0 < back <= len(out):
                raise BundleError("a copy from before the block")
            while n > 0:  # a copy may run into what it writes
                piece = out[start : start + n]
                out += piece
                n -= len(piece)
    except IndexError:
        raise BundleError("the block ends too early") from None
    if len(out) != size:
        raise BundleError(f"{len(out)} bytes in place of {size}")
    return bytes(out)


def unpacked(data: bytes, kind: int, size: int) -> bytes:
    if kind == 0:
        out = data
    elif kind == 1:
        props, window = data[0], struct.unpack("<I", data[1:LZMA_HEAD])[0]
        lc, lp, pb = props % 9, props // 9 % 5, props // 45
        chosen = [{"id": lzma.FILTER_LZMA1, "dict_size": max(window, 4096), "lc": lc, "lp": lp, "pb": pb}]
        out = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=chosen).decompress(data[LZMA_HEAD:], size)
    elif kind in (2, 3):
        return lz4_block(data, size)
    else:
        raise BundleError(f"unknown packing {kind}")
    if len(out) != size:
        raise BundleError(f"{len(out)} bytes in place of {size}")
    return out


@dataclass(frozen=True)
class Entry:
    path: str
    offset: int
    size: int
    flags: int


def _text(raw: bytes, at: int) -> tuple[str, int]:
    end = raw.find(b"\0", at)
    if end < 0:
        raise BundleError("a text without its end")
    return raw[at:end].decode("utf-8", "replace"), end + 1


class Bundle:
    """One bundle: its directory at once, its bytes unpacked on demand, one block in memory at a time."""

    def __init__(self, raw: bytes):
        if not raw.startswith(MAGIC):
            raise BundleError("no bundle magic")
        try:
            (self.format,) = struct.unpack_from(">i", raw, len(MAGIC))
            self.version, at = _text(raw, len(MAGIC) + 4)
            self.revision, at = _text(raw, at)
            size, packed, plain, flags = struct.unpack_from(">qIII", raw, at)
            at += 20
            if size > len(raw):
                raise BundleError("the bundle is cut off")
            if self.format >= 7:
                at = -(-at // 16) * 16
            place = size - packed if flags & 0x80 else at
            index = unpacked(raw[place : place + packed], flags & 0x3F, plain)
            at = at if flags & 0x80 else at + packed
            if flags & 0x200:
                at = -(-at // 16) * 16
            self._read_index(index)
        except struct.error:
            raise BundleError("the bundle is cut off") from None
        self.raw, self.start = raw, at
        self.size = sum(b[0] for b in self.blocks)
        if any(e.offset < 0 or e.offset + e.size > self.size for e in self.entries):
            raise BundleError("an entry outside the bundle")

    def _read_index(self, index: bytes) -> None:
        (n,) = struct.unpack_from(">i", index, 16)
        self.blocks = list(struct.iter_unpack(">IIH", index[20 : 20 + 10 * n]))
        at = 20 + 10 * n
        (n,) = struct.unpack_from(">i", index, at)
        at += 4
        self.entries = []
        for _ in range(n):
            offset, size, flags = struct.unpack_from(">qqI", index, at)
            path, at = _text(index, at + 20)
            self.entries.append(Entry(path, offset, size, flags))

    def unpack(self, into: BinaryIO) -> None:
        at = self.start
        for plain, packed, flags in self.blocks:
            into.write(unpacked(self.raw[at : at + packed], flags & 0x3F, plain))
            at += packed

    def files(self) -> Iterator[tuple[Entry, bytes]]:
        """Every entry with its bytes, read one by one from a file that leaves memory once it is large."""
        with tempfile.SpooledTemporaryFile(max_size=IN_MEMORY) as held:
            self.unpack(held)
            for e in self.entries:
                held.seek(e.offset)
                yield e, held.read(e.size)


def entries(content: bytes) -> Iterator[tuple[str, int, str]]:
    """(path, place in the directory, kind) of a bundle's files, as frames.index_assets takes them."""
    for i, e in enumerate(Bundle(content).entries):
        yield e.path, i, "serialized" if e.flags & 4 else "raw"


def packed_bundle(files: list[tuple[str, bytes]], kind: int = 0, block: int = 1 << 17, format: int = 6, at_end: bool = False) -> bytes:
    """A bundle of files, plain (0), by LZMA (1) or as literal runs of LZ4 (2)."""
    body = b"".join(b for _, b in files)
    blocks, data = [], b""
    for i in range(0, len(body), block):
        piece = body[i : i + block]
        if kind == 1:
            head = struct.pack("<BI", 93, 1 << 20)
            own = head + lzma.compress(piece, lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA1, "dict_size": 1 << 20, "lc": 3, "lp": 0, "pb": 2}])
        elif kind == 2:
            more = len(piece) - 15
            own = bytes([min(len(piece), 15) << 4]) + (b"\xff" * (more // 255) + bytes([more % 255]) if more >= 0 else b"") + piece
        else:
            own = piece
        blocks.append((len(piece), len(own), kind))
        data += own
    index = bytes(16) + struct.pack(">i", len(blocks)) + b"".join(struct.pack(">IIH", *b) for b in blocks) + struct.pack(">i", len(files))
    at = 0
    for path, content in files:
        index += struct.pack(">qqI", at, len(content), 4) + path.encode() + b"\0"
        at += len(content)
    head = MAGIC + struct.pack(">i", format) + b"5.x.x\0" + b"1\0"
    flags = 0x40 | (0x80 if at_end else 0)
    long = len(head) + 20
    pad = bytes(-long % 16) if format >= 7 else b""
    size = long + len(pad) + len(index) + len(data)
    head += struct.pack(">qIII", size, len(index), len(index), flags) + pad
    return head + (data + index if at_end else index + data)
