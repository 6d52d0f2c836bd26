"""Seekable compressed texts: independent zstandard frames beside the cumulative counts of their units.

A unit is a run of ASCII letters or any other single character.  A text is stored as frames of at most
``frame_bytes`` UTF-8 bytes, cut between characters; a unit belongs to the frame it starts in.  ``units``,
``chars`` and ``sizes`` (bytes) hold the totals up to the end of each frame, so a place given in units is found
by a search in ``units`` and the decompression of one frame.  Frames are independent and end where the next
begins: any sequence of them, joined, is a zstandard stream.

Defined cases: a NULL text is stored as the empty text, and an empty text has no frames.  Unit counts and places
take a text as a whole: a run of letters that is longer than a frame is one unit.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import zstandard

FRAME_BYTES = 1 << 16
LEVEL = 1


def unit_starts(data: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Which bytes of joined UTF-8 texts start a unit; ``breaks`` are the offsets at which texts begin."""
    folded = data | 0x20
    letter = (folded >= 97) & (folded <= 122)
    start = (data & 0xC0) != 0x80
    joined = letter[1:] & letter[:-1]
    start[1:] &= ~joined
    inside = breaks[breaks < len(data)]
    start[inside] = True
    return start


def cut_points(data: bytes | memoryview, frame_bytes: int) -> list[int]:
    """Byte offsets at which the frames of a text end, each between two characters."""
    out, at, n = [], 0, len(data)
    while at < n:
        end = min(at + frame_bytes, n)
        while end < n and end > at and data[end] & 0xC0 == 0x80:
            end -= 1
        if end == at:  # a frame holds one character at least
            end = min(at + frame_bytes, n)
            while end < n and data[end] & 0xC0 == 0x80:
                end += 1
        out.append(end)
        at = end
    return out


class Packer:
    """Compresses frames with one reused compressor."""

    def __init__(self) -> None:
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)

    def __call__(self, data: bytes | memoryview) -> bytes:
        return self._compressor.compress(data)


class Reader:
    """Reads single frames, or streams any sequence of frames."""

    def __init__(self) -> None:
        self._decompressor = zstandard.ZstdDecompressor()

    def frame(self, frame: bytes) -> bytes:
        return self._decompressor.decompress(frame)

    def stream(self, frames: list[bytes], start: int = 0, stop: int | None = None) -> Iterator[memoryview]:
        """The bytes from ``start`` to ``stop`` of the text that ``frames`` hold, a piece a frame."""
        at = 0
        for frame in frames:
            size = zstandard.frame_content_size(frame)
            if at + size > start and (stop is None or at < stop):
                data = memoryview(self._decompressor.decompress(frame))
                yield data[max(0, start - at):size if stop is None else min(size, stop - at)]
            at += size
            if stop is not None and at >= stop:
                return


def seek(reader: Reader, frames: list[bytes], units: list[int], chars: list[int], sizes: list[int],
         unit: int) -> tuple[int, int, int]:
    """(frame, byte in the frame, characters before it in the whole text) of the start of a unit.

    Unit ``units[-1]`` is the end of the text.  Only the frame that holds the place is decompressed."""
    total = units[-1] if units else 0
    if unit >= total:
        return len(frames), 0, chars[-1] if chars else 0
    k = bisect.bisect_right(units, unit)
    before, passed = (units[k - 1], chars[k - 1]) if k else (0, 0)
    data = np.frombuffer(reader.frame(frames[k]), np.uint8)
    starts = np.flatnonzero(unit_starts(data, np.zeros(1, np.int64)))
    if len(starts) > units[k] - before:  # the frame's first letters belong to a unit of the frame before
        starts = starts[1:]
    at = int(starts[unit - before])
    return k, at, passed + int(np.count_nonzero((data[:at] & 0xC0) != 0x80))
