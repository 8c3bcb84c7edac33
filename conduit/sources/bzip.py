"""Decompressing one bzip2 object in many tasks: its blocks stand for themselves.

A block begins with a mark of 48 bits at any bit, and needs nothing of the blocks before
it. A task gets a range of the packed bytes, looks for the marks that begin in it, and
unpacks each block up to the next mark, as a stream of that one block, with the block's
own checksum. Bits of a block may look like a mark; then the block does not end there,
and it is tried up to the next one. Every task says where its first block begins and
where the block after its last one must begin; only if these agree from the first byte
to the last is the object whole. Several streams laid end to end are read through.
"""

from __future__ import annotations

import bz2
from collections.abc import Callable, Iterator
from typing import NamedTuple

# Fixed values of the format: what a block begins with, what a stream ends with, the
# bits of a checksum, and of the header before a stream's first block.
BLOCK = 0x314159265359
END = 0x177245385090
_MARK_BITS, _SUM_BITS, _HEADER_BITS = 48, 32, 32
# No packed block of 900,000 bytes is longer than this.
LONGEST = 1 << 21
_END_OF_OBJECT = -1
_STEP = 1 << 23  # bits looked through at a time


class Part(NamedTuple):
    """What a range's blocks are: bits where the first begins and the next one must begin, plain bytes."""

    first: int
    following: int
    length: int


class Window:
    """Bytes of an object from an offset on, read as they are asked for."""

    def __init__(self, read: Callable[[int, int], bytes], offset: int, size: int):
        self._read, self.offset, self.size = read, offset, size
        self.data = b""

    def reach(self, upto: int) -> None:
        """Hold the bytes up to an offset of the object, or to its end."""
        upto = min(upto, self.size)
        have = self.offset + len(self.data)
        if upto > have:
            more = self._read(have, max(upto - have, 1 << 20))
            if len(more) < upto - have:
                raise OSError(f"object ended {upto - have - len(more)} bytes early")
            self.data += more

    def drop(self, before: int) -> None:
        """Forget the bytes before an offset of the object."""
        if before - self.offset > LONGEST:
            self.data, self.offset = self.data[before - self.offset :], before

    def bits(self, begin: int, count: int) -> int | None:
        """Bits of the object as a number; None where it ends before."""
        first, last = begin // 8, (begin + count + 7) // 8
        if last > self.size:
            return None
        self.reach(last)
        held = int.from_bytes(self.data[first - self.offset : last - self.offset], "big")
        return (held >> (last * 8 - begin - count)) & ((1 << count) - 1)

    def marks(self, begin: int, end: int) -> list[int]:
        """Bits in ``[begin, end)`` at which a mark of either kind begins, in order."""
        self.reach((end + _MARK_BITS + 7) // 8 + 1)
        found = []
        low, high = begin // 8 - self.offset, (end + 7) // 8 - self.offset + 8
        for mark in (BLOCK, END):
            for shift in range(8):  # five bytes are whole, whatever the shift
                whole = ((mark << (8 - shift)) >> 8 & ((1 << 40) - 1)) if shift else mark >> 8
                whole = whole.to_bytes(5, "big")
                at = self.data.find(whole, max(low, 0), high)
                while at >= 0:
                    bit = (self.offset + at) * 8 - (8 - shift if shift else 0)
                    if begin <= bit < end and self.bits(bit, _MARK_BITS) == mark:
                        found.append(bit)
                    at = self.data.find(whole, at + 1, high)
        return sorted(found)


def _one_block(window: Window, begin: int, end: int) -> bytes | None:
    """The plain bytes of the block over these bits; None if they are no whole block."""
    body = window.bits(begin, end - begin)
    checksum = (body >> (end - begin - _MARK_BITS - _SUM_BITS)) & ((1 << _SUM_BITS) - 1)
    held = (body << (_MARK_BITS + _SUM_BITS)) | (END << _SUM_BITS) | checksum
    bits = end - begin + _MARK_BITS + _SUM_BITS
    stream = b"BZh9" + (held << (-bits % 8)).to_bytes((bits + 7) // 8, "big")
    unpacker = bz2.BZ2Decompressor()
    try:
        plain = unpacker.decompress(stream)
    except OSError:
        return None
    return plain if unpacker.eof else None


def _header(window: Window, begin: int) -> bool:
    head = window.bits(begin, _HEADER_BITS)
    return head is not None and head >> 8 == 0x425A68 and 0x31 <= head & 0xFF <= 0x39


def _first_of_stream(window: Window, begin: int) -> int:
    """Bit of the first block at or behind a stream's header; -1 where no stream begins.

    Streams without blocks are passed over, and so is whatever follows the last stream.
    """
    while _header(window, begin):
        begin += _HEADER_BITS
        if window.bits(begin, _MARK_BITS) != END:
            return begin
        begin = -(-(begin + _MARK_BITS + _SUM_BITS) // 8) * 8
    return _END_OF_OBJECT


def unpacked(read: Callable[[int, int], bytes], size: int, offset: int, length: int) -> Iterator[bytes | Part]:
    """The plain bytes of the blocks that begin in a range, then what they are.

    ``read(offset, n)`` gives up to n bytes of the object. Of a range in which no block
    begins there is no :class:`Part`.
    """
    window = Window(read, offset, size)
    if offset == 0 and size and not _header(window, 0):
        raise OSError("not a bzip2 object")
    at, stop = offset * 8, (offset + length) * 8
    first, total = None, 0
    if offset == 0:
        at = _first_of_stream(window, 0)
    else:
        at = _first_block(window, at, stop)
    while at != _END_OF_OBJECT and at < stop:
        plain, end = _block_from(window, at)
        if plain is None:
            raise OSError(f"damaged block at bit {at}")
        yield plain
        first = at if first is None else first
        total += len(plain)
        at = end
        if window.bits(end, _MARK_BITS) == END:
            at = _first_of_stream(window, -(-(end + _MARK_BITS + _SUM_BITS) // 8) * 8)
        window.drop(end // 8)
    if first is not None:
        yield Part(first, at, total)


def _first_block(window: Window, at: int, stop: int) -> int:
    """Bit of the first block that begins in a range; -1 if there is none.

    What looks like a mark may lie within a block of an earlier range; then no block can
    be read from it.
    """
    while at < stop:
        upto = min(at + _STEP, stop)
        for mark in window.marks(at, upto):
            if window.bits(mark, _MARK_BITS) == BLOCK and _block_from(window, mark)[0] is not None:
                return mark
        at = upto
        window.drop(at // 8)
    return _END_OF_OBJECT


def _block_from(window: Window, begin: int) -> tuple[bytes | None, int]:
    """The block at a bit and the bit of the mark it ends at."""
    if window.bits(begin, _MARK_BITS) != BLOCK:
        return None, begin
    at, limit = begin + _MARK_BITS, min(begin + 8 * LONGEST, 8 * window.size)
    while at < limit:
        upto = min(at + _STEP, limit)
        for end in window.marks(at, upto):
            plain = _one_block(window, begin, end)
            if plain is not None:
                return plain, end
        at = upto
    return None, begin
