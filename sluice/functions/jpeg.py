"""Baseline JPEG files: block cosines, quantisation and Huffman codes made for each picture, as numpy kernels."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np

#: The quantisers of brightness and colour at quality 50, rows of eight.
BRIGHTNESS = (
    16, 11, 10, 16, 24, 40, 51, 61,
    12, 12, 14, 19, 26, 58, 60, 55,
    14, 13, 16, 24, 40, 57, 69, 56,
    14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77,
    24, 35, 55, 64, 81, 104, 113, 92,
    49, 64, 78, 87, 103, 121, 120, 101,
    72, 92, 95, 98, 112, 100, 103, 99,
)
COLOUR = (
    17, 18, 24, 47, 99, 99, 99, 99,
    18, 21, 26, 66, 99, 99, 99, 99,
    24, 26, 56, 99, 99, 99, 99, 99,
    47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99,
)
#: Brightness and the two colour differences, of red, green and blue.
WEIGHTS = ((0.299, 0.587, 0.114), (-0.168736, -0.331264, 0.5), (0.5, -0.418688, -0.081312))
#: Fixed value: the quality that pictures and frames are written with.
QUALITY = 95
LONGEST_CODE = 16
#: Blocks whose codes are laid out at once.
STRIP = 1024

_WAVES = np.cos(np.outer(np.arange(8), 2 * np.arange(8) + 1) * np.pi / 16) / 2
_WAVES[0] /= np.sqrt(2)
#: Places of a block along its diagonals, to and fro.
_DIAGONAL = np.array(sorted(range(64), key=lambda at: (at // 8 + at % 8, at // 8 if (at // 8 + at % 8) % 2 else at % 8)))


def _quantisers(quality: int) -> np.ndarray:
    """The two tables at a quality of 1 to 100."""
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array([BRIGHTNESS, COLOUR]) * scale + 50) // 100, 1, 255)


def _levels(shown: np.ndarray, quantisers: np.ndarray) -> np.ndarray:
    """(blocks, 3, 64): quantised waves along the diagonals, the first of each component as its difference to the block before."""
    height, width, _ = shown.shape
    padded = np.pad(shown[..., ::-1], ((0, -height % 8), (0, -width % 8), (0, 0)), mode="edge")
    high, wide = padded.shape[0] // 8, padded.shape[1] // 8
    out = np.empty((high * wide, 3, 64), np.int16)
    for part, weights in enumerate(WEIGHTS):
        plane = padded @ np.array(weights, np.float32) - (128 if part == 0 else 0)
        blocks = plane.reshape(high, 8, wide, 8).swapaxes(1, 2).reshape(-1, 8, 8)
        waves = (_WAVES @ blocks @ _WAVES.T).reshape(-1, 64) / quantisers[min(part, 1)]
        out[:, part] = np.rint(waves)[:, _DIAGONAL]
    out[1:, :, 0] -= out[:-1, :, 0].copy()
    return out


def _symbols(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(table, symbol, value, bits) in the order of the file, of the blocks given.

    Tables are 0 and 1 for first waves and 2 and 3 for the others, each of
    brightness and of colour. A symbol of the others is how many zeros come
    before a level and how many bits it has; 16 zeros are a symbol of their own,
    and so is the end of a block whose last levels are zeros.
    """
    units = levels.reshape(-1, 64).astype(np.int32)
    kind = np.minimum(np.arange(len(units)) % 3, 1)
    unit, place = np.nonzero(units[:, 1:])
    place += 1
    fresh = np.ones(len(unit), bool)
    fresh[1:] = unit[1:] != unit[:-1]
    zeros = place - 1 - np.where(fresh, 0, np.roll(place, 1))
    value = units[unit, place]
    long_runs = np.repeat(np.arange(len(unit)), zeros >> 4)
    last = np.zeros(len(units), np.int64)
    np.maximum.at(last, unit, place)
    ended = np.flatnonzero(last < 63)

    sizes = lambda levels: np.frexp(np.abs(levels))[1]
    first, none = units[:, 0], lambda some: np.zeros(len(some), np.int32)
    every = np.arange(len(units))
    order = np.concatenate([every * 256, unit[long_runs] * 256 + place[long_runs] * 2, unit * 256 + place * 2 + 1, ended * 256 + 255])
    table = np.concatenate([kind, kind[unit[long_runs]] + 2, kind[unit] + 2, kind[ended] + 2])
    symbol = np.concatenate([sizes(first), none(long_runs) + 0xF0, (zeros & 15) << 4 | sizes(value), none(ended)])
    levels = np.concatenate([first, none(long_runs), value, none(ended)])
    at = np.argsort(order, kind="stable")
    table, symbol, levels = table[at], symbol[at], levels[at]
    bits = sizes(levels)
    return table, symbol, np.where(levels < 0, levels + (1 << bits) - 1, levels), bits


def code_lengths(counts: dict[int, int]) -> dict[int, int]:
    """The lengths, 16 at most, that make the shortest file, by merging packages. One code more, the longest, stays free."""
    leaves = sorted([(0, [-1])] + [(n, [symbol]) for symbol, n in counts.items()])
    packages: list[tuple[int, list[int]]] = []
    for _ in range(LONGEST_CODE):
        merged = sorted(leaves + packages, key=lambda p: p[0])
        packages = [(a + b, left + right) for (a, left), (b, right) in zip(merged[::2], merged[1::2])]
    lengths = dict.fromkeys([-1, *counts], 0)
    for _, symbols in packages[: len(leaves) - 1]:
        for symbol in symbols:
            lengths[symbol] += 1
    return lengths


def _codes(counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(the table as a file has it, code of each symbol, its length)."""
    lengths = code_lengths({int(s): int(counts[s]) for s in np.flatnonzero(counts)} or {0: 1})
    lengths.pop(-1)
    ordered = sorted(lengths, key=lambda s: (lengths[s], s))
    code, size = np.zeros(256, np.int64), np.zeros(256, np.int64)
    following, before = 0, 0
    for symbol in ordered:
        following <<= lengths[symbol] - before
        before = lengths[symbol]
        code[symbol], size[symbol] = following, before
        following += 1
    numbers = bytes(sum(n == length for n in lengths.values()) for length in range(1, LONGEST_CODE + 1))
    return numbers + bytes(ordered), code, size


def _scan(levels: np.ndarray, codes: list[tuple[bytes, np.ndarray, np.ndarray]]) -> Iterator[bytes]:
    code, size = np.stack([c for _, c, _ in codes]), np.stack([s for *_, s in codes])
    left = np.zeros(0, np.uint8)
    for at in range(0, len(levels), STRIP):
        table, symbol, value, bits = _symbols(levels[at : at + STRIP])
        word = code[table, symbol] << bits | value
        length = size[table, symbol] + bits
        ends = np.cumsum(length)
        shift = np.repeat(ends, length) - 1 - np.arange(ends[-1])
        laid = np.concatenate([left, (np.repeat(word, length) >> shift & 1).astype(np.uint8)])
        whole = len(laid) // 8 * 8
        left = laid[whole:]
        yield np.packbits(laid[:whole]).tobytes()
    if len(left):
        yield np.packbits(np.concatenate([left, np.ones(8 - len(left), np.uint8)])).tobytes()


def jpeg(shown: np.ndarray, quality: int = QUALITY) -> bytes:
    """A picture of blue, green and red (65,535 each way at most) as a JPEG file; colours have the picture's own resolution."""
    height, width, _ = shown.shape
    if not (0 < height < 1 << 16 and 0 < width < 1 << 16):
        raise ValueError(f"a JPEG file can't hold {width} x {height}")
    quantisers = _quantisers(quality)
    levels = _levels(shown, quantisers)
    counts = np.zeros((4, 256), np.int64)
    for at in range(0, len(levels), STRIP):
        table, symbol, _, _ = _symbols(levels[at : at + STRIP])
        counts += np.bincount(table * 256 + symbol, minlength=1024).reshape(4, 256)
    codes = [_codes(c) for c in counts]

    def segment(mark: int, data: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, mark, len(data) + 2) + data

    parts = [b"\xff\xd8", segment(0xE0, b"JFIF\0" + struct.pack(">BBBHHBB", 1, 1, 0, 1, 1, 0, 0))]
    parts += [segment(0xDB, bytes([n]) + bytes(q[_DIAGONAL].tolist())) for n, q in enumerate(quantisers)]
    parts.append(segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1])))
    parts += [segment(0xC4, bytes([number]) + held) for number, (held, _, _) in zip((0x00, 0x01, 0x10, 0x11), codes)]
    parts.append(segment(0xDA, bytes([3, 1, 0x00, 2, 0x11, 3, 0x11, 0, 63, 0])))
    parts.append(b"".join(_scan(levels, codes)).replace(b"\xff", b"\xff\0"))
    return b"".join(parts) + b"\xff\xd9"


def complete_jpeg(content: bytes) -> bool:
    """Whether a JPEG file is whole: segment after segment, a frame of some size, and levels up to the end mark. Levels aren't decoded."""
    content = bytes(content)
    at, sized = 2, False
    while content[:2] == b"\xff\xd8" and at + 4 <= len(content) and content[at] == 0xFF:
        mark, size = content[at + 1], struct.unpack(">H", content[at + 2 : at + 4])[0]
        if mark == 0xFF:  # filling
            at += 1
            continue
        if mark == 0xD9 or size < 2 or at + 2 + size > len(content):
            return False
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC) and size >= 8:
            sized = all(struct.unpack(">HH", content[at + 5 : at + 9]))
        at += 2 + size
        if mark == 0xDA:  # levels follow: the next mark that isn't a byte of theirs or a restart
            found = re.compile(rb"\xff+[^\x00\xd0-\xd7\xff]", re.DOTALL).search(content, at)
            if not found:
                return False
            if found[0][-1] == 0xD9:
                return sized and found.start() > at
            at = found.end() - 2
    return False
