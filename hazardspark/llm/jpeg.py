"""Progressive JPEG media columns.

Payload bytes are stored losslessly as the quantised coefficients (the format's unit) of 4:2:0 progressive JPEG files:
byte b is coefficient b - 128, 64 bytes to a block, luma blocks first. The decoder accumulates spectral-selection and
successive-approximation scans into coefficient arrays, inverse-transforms them in numpy, repeats chroma samples to the
full resolution and gives RGB tensors. Its arithmetic is exact in whole numbers, so equal texts give equal values
whatever else is in a batch.

Entropy-coded segments (between restart markers) are independent, so all segments of a group of files are coded and
decoded side by side: a step of the decoder reads one symbol of every segment at once. A group holds about ``GROUP``
bytes of payload, a long file is a group of its own.

Defined results: a null or empty text is one unit of padding; repeated rows give repeated results; rows without an id
are treated like any other; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hazardspark.llm.common import bounded_batches, id_and_text, record

UNIT, MCU, RESTART, GROUP = 576, 384, 8, 1 << 21
#: Scans of a file: components, first and last coefficient, high and low bit of the approximation.
SCRIPT = (
    ((0, 1, 2), 0, 0, 0, 1), ((0, 1, 2), 0, 0, 1, 0),
    *(((c,), 1, 5, 0, 1) for c in range(3)), *(((c,), 6, 63, 0, 0) for c in range(3)), *(((c,), 1, 5, 1, 0) for c in range(3)),
)
SAMPLING = ((2, 2), (1, 1), (1, 1))


def zigzag() -> np.ndarray:
    """Place in the 8x8 block (row by row) of each coefficient in zigzag order."""
    order = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in order])


def code_lengths() -> tuple[dict[int, int], dict[int, int]]:
    """Lengths of the codes of DC sizes and of AC (run, size) symbols: short for the values that text has."""
    dc = {size: 4 for size in range(12)}
    ac = {0x05: 2, 0x07: 2, 0x04: 3, 0x06: 4, 0x03: 4, 0x02: 5, 0x01: 5, 0x00: 6, 0x08: 6, 0x11: 7}
    for run in range(16):
        for size in range(11):
            symbol = run << 4 | size
            if symbol not in ac and (size or run == 15 or run < 8):
                ac[symbol] = 12 if size <= 8 else 16
    return dc, ac


class Codes:
    """A canonical Huffman code: code and length by symbol, and symbol by the next 16 bits."""

    def __init__(self, lengths: dict[int, int]):
        self.symbols = sorted(lengths, key=lambda s: (lengths[s], s))
        self.counts = [sum(n == k for n in lengths.values()) for k in range(1, 17)]
        self.code, self.length = np.zeros(256, np.uint64), np.zeros(256, np.int64)
        self.table = np.zeros(1 << 16, np.int64)
        code, before = 0, 0
        for s in self.symbols:
            n = lengths[s]
            code <<= n - before
            if code >> n:
                raise ValueError("too many short codes")
            self.code[s], self.length[s] = code, n
            self.table[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | s
            code, before = code + 1, n

    @classmethod
    def read(cls, counts: bytes, symbols: bytes) -> Codes:
        lengths, at = {}, 0
        for k, n in enumerate(counts):
            for s in symbols[at : at + n]:
                lengths[s] = k + 1
            at += n
        return cls(lengths)


DC, AC = (Codes(x) for x in code_lengths())
_SIZE = np.array([int(v).bit_length() for v in range(4096)], np.int64)
_ONE = np.uint64(1)


def layout(size: int) -> tuple[int, int]:
    """Columns and rows of 16x16 units that hold ``size`` bytes."""
    units = -(-size // MCU)
    across = max(1, int(np.ceil(np.sqrt(units))))
    return across, -(-units // across)


@lru_cache(maxsize=256)
def mcu_order(across: int, down: int) -> np.ndarray:
    """Blocks of a file in the order of an interleaved scan, a row per unit."""
    n = across * down
    row, col = np.divmod(np.arange(n), across)
    luma = [(2 * row + a) * 2 * across + 2 * col + b for a in (0, 1) for b in (0, 1)]
    return np.column_stack([*luma, 4 * n + np.arange(n), 5 * n + np.arange(n)])


def pack(values: np.ndarray, bits: np.ndarray, segment: np.ndarray, marker: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all segments, stuffed, and where each begins (and the last ends).

    Items (at most 32 bits) come in order, ``segment`` says whose they are; a segment ends with ones up to a byte and,
    where ``marker`` is 0 to 7, with that restart marker.
    """
    n = len(marker)
    total = np.bincount(segment, bits, n).astype(np.int64)
    whole = -(-total // 8)
    begin = np.concatenate(([0], np.cumsum(whole + 2 * (marker >= 0))))
    before = np.cumsum(bits) - bits
    first = np.concatenate(([0], np.cumsum(total)))[:-1]
    place = before - first[segment] + 8 * begin[segment]
    word, offset = place >> 5, place & 31
    put = values << (64 - offset - bits).astype(np.uint64)
    put[bits == 0] = 0
    words = np.bincount(word, (put >> np.uint64(32)).astype(float), int(begin[-1] // 4) + 3)
    words[1:] += np.bincount(word, (put & np.uint64(0xFFFFFFFF)).astype(float), len(words))[:-1]
    data = words.astype(np.uint32).astype(">u4").view(np.uint8)[: begin[-1]].copy()
    spare = 8 * whole - total
    some = whole > 0
    data[(begin[:-1] + whole - 1)[some]] |= ((1 << spare) - 1).astype(np.uint8)[some]
    marked = np.zeros(len(data), bool)
    at = (begin[:-1] + whole)[marker >= 0]
    data[at], data[at + 1] = 0xFF, 0xD0 + marker[marker >= 0]
    marked[at] = True
    stuffed = (data == 255) & ~marked
    shift = np.concatenate(([0], np.cumsum(stuffed)))
    out = np.zeros(len(data) + int(shift[-1]), np.uint8)
    out[np.arange(len(data)) + shift[:-1]] = data
    return out, begin + shift[begin]


def signed_bits(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The extra bits of a value of that size."""
    return np.where(v < 0, v + (1 << size) - 1, v).astype(np.uint64)


def code_dc(coefficients: np.ndarray, order: np.ndarray, segment: np.ndarray, high: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of an interleaved scan of first coefficients; ``order`` has a row of blocks per unit."""
    values = coefficients[order, 0].astype(np.int64) >> low
    if high:
        return (values.ravel() & 1).astype(np.uint64), np.ones(values.size, np.int64), np.repeat(segment, order.shape[1])
    fresh = np.concatenate(([True], segment[1:] != segment[:-1]))
    last = np.where(fresh[:, None], 0, np.concatenate((np.zeros((1, 3), np.int64), values[:-1, 3:6])))
    before = np.column_stack([last[:, 0], values[:, 0], values[:, 1], values[:, 2], last[:, 1], last[:, 2]])
    diff = (values - before).ravel()
    size = _SIZE[np.abs(diff)]
    return DC.code[size] << size.astype(np.uint64) | signed_bits(diff, size), DC.length[size] + size, np.repeat(segment, order.shape[1])


def code_ac(coefficients: np.ndarray, segment: np.ndarray, first: int, last: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of a first scan of a band: run and size of each value, then the end of the block."""
    band = coefficients[:, first : last + 1].astype(np.int64)
    size = np.abs(band) >> low
    there = np.concatenate((size > 0, (size[:, -1:] == 0)), axis=1)
    block, k = np.nonzero(there)
    end = k > last - first
    before = np.where(np.concatenate(([False], block[1:] == block[:-1])), np.concatenate(([0], k[:-1])), -1)
    run = np.where(end, 0, k - before - 1)
    at = np.where(end, 0, k)
    value = np.where(end, 0, np.sign(band[block, at]) * size[block, at])
    n = _SIZE[np.abs(value)]
    symbol = (run & 15) << 4 | n
    items, bits, owner = AC.code[symbol] << n.astype(np.uint64) | signed_bits(value, n), AC.length[symbol] + n, segment[block]
    if (run > 15).any():
        again = 1 + (run >> 4)
        place = np.cumsum(again) - 1
        more = np.full(int(again.sum()), AC.code[0xF0]), np.full(int(again.sum()), AC.length[0xF0]), np.repeat(owner, again)
        more[0][place], more[1][place] = items, bits
        return more
    return items, bits, owner


def refine_ac(coefficients: np.ndarray, segment: np.ndarray, first: int, last: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of a refining scan of a band of at most 15 coefficients: at each new value its code, sign and the bits passed."""
    band = coefficients[:, first : last + 1].astype(np.int64)
    n, width = band.shape
    values, bits = np.zeros((n, width + 1), np.uint64), np.zeros((n, width + 1), np.int64)
    run, passed, held = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for k in range(width):
        size = np.abs(band[:, k]) >> low
        new, old = size == 1, size > 1
        symbol = run << 4 | 1
        code = (AC.code[symbol] << _ONE | (band[:, k] > 0).astype(np.uint64)) << held.astype(np.uint64) | passed
        values[:, k] = np.where(new, code, 0)
        bits[:, k] = np.where(new, AC.length[symbol] + 1 + held, 0)
        run = np.where(new, 0, run + ~old)
        passed = np.where(new, np.uint64(0), np.where(old, passed << _ONE | (size & 1).astype(np.uint64), passed))
        held = np.where(new, 0, held + old)
    open_ = (run > 0) | (held > 0)
    values[:, width] = np.where(open_, AC.code[0] << held.astype(np.uint64) | passed, 0)
    bits[:, width] = np.where(open_, AC.length[0] + held, 0)
    return values.ravel(), bits.ravel(), np.repeat(segment, width + 1)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_TABLES = (
    _segment(0xDB, bytes([0]) + bytes([1] * 64))
    + b"".join(_segment(0xC4, bytes([kind << 4, *t.counts, *t.symbols])) for kind, t in ((0, DC), (1, AC)))
    + _segment(0xDD, struct.pack(">H", RESTART))
)


def encode(payloads: list[bytes]) -> list[bytes]:
    """A progressive JPEG file for each payload."""
    shapes = [layout(len(p)) for p in payloads]
    sizes = np.array([6 * a * d for a, d in shapes])
    start = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.full(int(start[-1]) * 64, 128, np.uint8)
    for p, s in zip(payloads, start):
        flat[64 * s : 64 * s + len(p)] = np.frombuffer(p, np.uint8)
    blocks = flat.reshape(-1, 64).astype(np.int16) - 128
    # Runs of blocks (each file's components) and of units, cut into segments.
    runs = np.array([r for (a, d), s in zip(shapes, start) for r in ((s, 4 * a * d), (s + 4 * a * d, a * d), (s + 5 * a * d, a * d))])
    order = np.concatenate([mcu_order(a, d) + s for (a, d), s in zip(shapes, start)])
    by_block, block_marker, block_first = _cut(runs[:, 1])
    by_unit, unit_marker, unit_first = _cut(np.array([a * d for a, d in shapes]))
    parts = []
    for components, first, last, high, low in SCRIPT:
        if last == 0:
            parts.append((pack(*code_dc(blocks, order, by_unit, high, low), unit_marker), unit_first, None))
        elif components == (0,):
            items = (refine_ac if high else lambda *x: code_ac(*x))(blocks, by_block, first, last, low)
            packed = pack(*items, block_marker)
            parts.append((packed, block_first, 0))
        else:
            parts.append((packed, block_first, components[0]))
    out = []
    for i, (p, (a, d)) in enumerate(zip(payloads, shapes)):
        head = [b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(p))), _TABLES, _segment(
            0xC2, struct.pack(">BHHB", 8, 16 * d, 16 * a, 3) + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(SAMPLING))
        )]
        for (components, first, last, high, low), ((data, begin), firsts, c) in zip(SCRIPT, parts):
            j = i if c is None else 3 * i + c
            head.append(_segment(0xDA, bytes([len(components), *(x for k in components for x in (k + 1, 0)), first, last, high << 4 | low])))
            head.append(data[begin[firsts[j]] : begin[firsts[j + 1]]].tobytes())
        out.append(b"".join([*head, b"\xff\xd9"]))
    return out


def _cut(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each member of the runs, the restart marker after each segment (-1: none), each run's first segment."""
    segments = -(-lengths // RESTART)
    firsts = np.concatenate(([0], np.cumsum(segments)))
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = np.repeat(firsts[:-1], lengths) + within // RESTART
    place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], segments)
    marker = np.where(place + 1 < np.repeat(segments, segments), place % 8, -1)
    return own, marker, firsts


# Decoding: files are taken apart, segments of like scans are decoded together.
_NEXT = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTARTS = re.compile(rb"\xff[\xd0-\xd7]")


@lru_cache(maxsize=64)
def quantisers(body: bytes) -> dict[int, np.ndarray]:
    """Quantisation tables of a segment by number."""
    out = {}
    while body:
        n = 128 if body[0] >> 4 else 64
        out[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if n == 128 else np.uint8).astype(float)
        body = body[1 + n :]
    return out


@lru_cache(maxsize=64)
def code_specs(body: bytes) -> dict[int, tuple[bytes, bytes]]:
    """Huffman codes of a segment by class and number: how many codes of each length, and their symbols."""
    out = {}
    while body:
        n = sum(body[1:17])
        out[body[0]] = (body[1:17], body[17 : 17 + n])
        body = body[17 + n :]
    return out


class File:
    """What a file's markers say, and its coefficients (zigzag) by component."""

    def __init__(self, data: bytes, at: int):
        self.at, self.comment, self.restart, self.scans, self.quant = at, b"", 0, [], {}
        codes: dict[int, tuple[bytes, bytes]] = {}
        pos = 2
        while pos < len(data):
            marker = data[pos + 1]
            if marker == 0xD9:
                break
            size = struct.unpack_from(">H", data, pos + 2)[0]
            body = data[pos + 4 : pos + 2 + size]
            pos += 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                self.quant |= quantisers(body)
            elif marker == 0xC4:
                codes |= code_specs(body)
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xC2:
                _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                self.parts = {body[6 + 3 * i]: (i, body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
                self.place()
            elif marker == 0xDA:
                n = body[0]
                chosen = [(self.parts[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(n)]
                first, last, bits = body[1 + 2 * n : 4 + 2 * n]
                tables = tuple(codes.get(t >> 4 if not first else 16 | t & 15) for _, t in chosen)
                end = _NEXT.search(data, pos)
                stop = end.start() if end else len(data)
                pieces = [p.replace(b"\xff\x00", b"\xff") for p in _RESTARTS.split(data[pos:stop])]
                self.scans.append(((first, last, bits >> 4, bits & 15, tables), [p[0] for p, _ in chosen], pieces, self.restart))
                pos = stop
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("only progressive files with Huffman codes are decoded")

    def place(self) -> None:
        """Size in blocks of each component, in whole units, and where its blocks begin."""
        parts = sorted(self.parts.values())
        self.h, self.v = max(p[1] for p in parts), max(p[2] for p in parts)
        across, down = -(-self.width // (8 * self.h)), -(-self.height // (8 * self.v))
        self.grid = (across, down)
        self.shape = [(down * v, across * h) for _, h, v, _ in parts]
        self.first = np.concatenate(([0], np.cumsum([a * b for a, b in self.shape]))) + self.at
        self.inside = [(-(-(-(-self.height * v // self.v)) // 8), -(-(-(-self.width * h // self.h)) // 8)) for _, h, v, _ in parts]
        self.n_blocks = int(self.first[-1]) - self.at

    def blocks(self, components: list[int]) -> np.ndarray:
        """Blocks in scan order, a row per unit of the scan."""
        sampling = tuple((h, v) for _, h, v, _ in sorted(self.parts.values()))
        return scan_blocks(tuple(components), sampling, self.grid, tuple(self.inside)) + self.at


@lru_cache(maxsize=256)
def scan_blocks(components: tuple[int, ...], sampling: tuple[tuple[int, int], ...], grid: tuple[int, int], inside: tuple) -> np.ndarray:
    """Blocks of a scan counted from the file's first; a plain scan has the blocks inside the picture only."""
    across, down = grid
    first = np.concatenate(([0], np.cumsum([across * h * down * v for h, v in sampling])))
    if len(components) == 1:
        c = components[0]
        rows, cols = inside[c]
        return (np.arange(rows)[:, None] * (across * sampling[c][0]) + np.arange(cols)).reshape(-1, 1) + first[c]
    row, col = np.divmod(np.arange(across * down), across)
    columns = []
    for c in components:
        h, v = sampling[c]
        columns += [(v * row + a) * (across * h) + h * col + b + first[c] for a in range(v) for b in range(h)]
    return np.column_stack(columns)


def windows(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64 bits from every byte on, and the bit at which each piece begins."""
    data = np.frombuffer(b"".join(pieces) + b"\xff" * 16, np.uint8)
    n = len(data) - 8
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out |= data[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    begin = np.cumsum([0, *map(len, pieces)])[:-1]
    return out, begin * 8


def _peek(view: np.ndarray, p: np.ndarray) -> np.ndarray:
    return view[np.minimum(p >> 3, len(view) - 1)] << (p & 7).astype(np.uint64)


def _take(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The first n bits of x, n from 0 on."""
    return ((x >> _ONE) >> (63 - n).astype(np.uint64)).astype(np.int64)


def _value(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(v < (1 << np.maximum(n, 1) >> 1), v - (1 << n) + 1, v)


def read_dc(out: np.ndarray, view, p, members: list[np.ndarray], pattern: list[int], high: int, low: int, table: np.ndarray) -> None:
    """An interleaved or plain scan of first coefficients; members: the blocks of each segment, a row per unit."""
    width = len(pattern)
    steps = np.array([m.size for m in members])
    if high:
        for k in range(int(steps.max())):
            on = np.flatnonzero(steps > k)
            bit = _take(_peek(view, p[on] + k), np.ones(len(on), np.int64))
            where = np.fromiter((members[i].flat[k] for i in on), np.int64, len(on))
            out[where, 0] |= (bit << low).astype(np.int16)
        return
    diffs = np.zeros((len(members), -(-int(steps.max()) // width) * width), np.int64)
    for k in range(int(steps.max())):
        on = np.flatnonzero(steps > k)
        x = _peek(view, p[on])
        entry = table[(x >> np.uint64(48)).astype(np.int64)]
        n, size = entry >> 8, entry & 255
        diffs[on, k] = _value(_take(x << n.astype(np.uint64), size), size)
        p[on] += n + size
    diffs = diffs.reshape(len(members), -1, width)
    for c in set(pattern):
        at = [i for i, x in enumerate(pattern) if x == c]
        diffs[:, :, at] = np.cumsum(diffs[:, :, at].reshape(len(members), -1), axis=1).reshape(len(members), -1, len(at))
    for i, m in enumerate(members):
        out[m.ravel(), 0] = (diffs[i].ravel()[: m.size] << low).astype(np.int16)


def read_ac(out: np.ndarray, view, p, blocks: np.ndarray, cur: np.ndarray, end: np.ndarray, first: int, last: int, low: int, table: np.ndarray) -> None:
    """A first scan of a band: one symbol of every open segment at a step. ``blocks[cur]`` is a segment's block."""
    flat, k = out.reshape(-1), np.full(len(p), first)
    while len(p):
        x = _peek(view, p)
        entry = table[(x >> np.uint64(48)).astype(np.int64)]
        n, symbol = entry >> 8, entry & 255
        run, size = symbol >> 4, symbol & 15
        extra = np.where((size == 0) & (run < 15), run, size)
        v = _take(x << n.astype(np.uint64), extra)
        p = p + n + extra
        valued = size > 0
        if valued.all():
            k = k + run
            flat[blocks[cur] * 64 + np.minimum(k, 63)] = _value(v, size) << low
            k = k + 1
        else:
            at = k + run
            w = np.flatnonzero(valued)
            flat[blocks[cur[w]] * 64 + np.minimum(at[w], 63)] = _value(v[w], size[w]) << low
            ends = ~valued & (run < 15)
            cur = cur + np.where(ends, (1 << np.where(ends, run, 0)) - 1 + v, 0)
            k = np.where(ends, last + 1, at + 1)
        done = k > last
        if done.any():
            cur, k = cur + done, np.where(done, first, k)
            on = cur < end
            if not on.all():
                p, cur, end, k = p[on], cur[on], end[on], k[on]


def read_ac_refining(out: np.ndarray, view, p, blocks: np.ndarray, cur: np.ndarray, end: np.ndarray, first: int, last: int, low: int, table: np.ndarray) -> None:
    """A refining scan of a band: at a step, every open segment reads a symbol or passes one coefficient."""
    flat = out.reshape(-1)
    k, skip, rest = np.full(len(p), first), np.full(len(p), -1), np.zeros(len(p), np.int64)
    new = np.zeros(len(p), np.int64)
    one = np.int64(1) << low
    while len(p):
        x = _peek(view, p)
        reads = (skip < 0) & (rest == 0)
        entry = table[(x >> np.uint64(48)).astype(np.int64)]
        n, symbol = entry >> 8, entry & 255
        run, size = symbol >> 4, symbol & 15
        ends = reads & (size == 0) & (run < 15)
        extra = np.where(ends, run, size)
        v = _take(x << n.astype(np.uint64), extra)
        where = blocks[cur] * 64 + k
        old = flat[where].astype(np.int64)
        passes = ~reads
        correct = passes & (old != 0)
        bit = (x >> np.uint64(63)).astype(np.int64)
        changed = old + np.where(correct & (bit > 0) & (np.abs(old) & one == 0), np.sign(old) * one, 0)
        lands = passes & (old == 0) & (rest == 0) & (skip == 0)
        flat[where] = np.where(lands, new, changed)
        p = p + np.where(reads, n + extra, np.where(correct, 1, 0))
        skip = np.where(reads & ~ends, run, np.where(passes & (old == 0) & (rest == 0), skip - 1, skip))
        new = np.where(reads & ~ends, np.where(size > 0, np.where(v > 0, one, -one), 0), new)
        rest = np.where(ends, (1 << np.where(ends, run, 0)) + v, rest)
        k = k + passes
        done = k > last
        if done.any():
            cur, k = cur + done, np.where(done, first, k)
            rest = np.where(done & (rest > 0), rest - 1, rest)
            skip = np.where(done, -1, skip)
            on = cur < end
            if not on.all():
                p, cur, end, k, skip, rest, new = (a[on] for a in (p, cur, end, k, skip, rest, new))


def basis() -> np.ndarray:
    """Inverse transform of coefficients in zigzag order to the 64 samples of a block, in 2^-16."""
    x = np.arange(8)
    c = np.where(np.arange(8) == 0, np.sqrt(1 / 8), 0.5)[:, None] * np.cos((2 * x[None, :] + 1) * np.arange(8)[:, None] * np.pi / 16)
    full = np.einsum("uy,vx->uvyx", c, c).reshape(64, 64)
    return np.rint(full[zigzag()] * 65536)


_BASIS = basis()
_READ: dict[tuple[bytes, bytes], Codes] = {}


def _codes(spec: tuple[bytes, bytes]) -> Codes:
    if spec not in _READ:
        if len(_READ) > 64:
            _READ.clear()
        _READ[spec] = Codes.read(*spec)
    return _READ[spec]


def decode(media: list[bytes]) -> list[tuple[bytes, np.ndarray, np.ndarray]]:
    """Of each file: its comment, its coefficients (a row per block) and its RGB tensor (height, width, 3)."""
    files, at = [], 0
    for data in media:
        files.append(File(data, at))
        at += files[-1].n_blocks
    out = np.zeros((at, 64), np.int16)
    rounds: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for f in files:
        # The scans of a component come in order; like scans in one round are decoded together.
        met: dict[int, int] = defaultdict(int)
        for key, components, pieces, restart in f.scans:
            turn = max(met[c] for c in components)
            met.update(dict.fromkeys(components, turn + 1))
            pattern = [c for c in components for _ in range(1 if len(components) == 1 else next(p[1] * p[2] for p in f.parts.values() if p[0] == c))]
            pattern = pattern if key[0] == 0 else [0]
            rounds[turn][key, tuple(pattern)].append((f.blocks(components), pieces, restart))
    for turn in sorted(rounds):
        for ((first, last, high, low, tables), pattern), jobs in rounds[turn].items():
            pieces = [p for _, ps, _ in jobs for p in ps]
            view, p = windows(pieces)
            if first == 0:
                members = [b[i * r : (i + 1) * r] if r else b for b, ps, r in jobs for i in range(len(ps))]
                if not high and len(set(tables)) > 1:
                    raise ValueError("scans with several DC codes are not decoded")
                read_dc(out, view, p, members, list(pattern), high, low, None if high else _codes(tables[0]).table)
                continue
            blocks = np.concatenate([b.ravel() for b, _, _ in jobs])
            begin, cur, end = 0, [], []
            for b, ps, r in jobs:
                n = len(b)
                edges = [min(i * r, n) for i in range(len(ps))] + [n] if r else [0, n]
                cur += [begin + e for e in edges[:-1]]
                end += [begin + e for e in edges[1:]]
                begin += n
            reader = read_ac_refining if high else read_ac
            reader(out, view, p, blocks, np.array(cur), np.array(end), first, last, low, _codes(tables[0]).table)
    values = samples(files, out)
    return [(f.comment, out[f.at : f.at + f.n_blocks], tensor(f, values)) for f in files]


def samples(files: list[File], coefficients: np.ndarray) -> np.ndarray:
    """The 64 samples of every block: dequantised, inverse-transformed in whole numbers, a few thousand blocks at a time."""
    scale = None
    if any((f.quant[q] != 1).any() for f in files for _, _, _, q in f.parts.values()):
        scale = np.concatenate([np.broadcast_to(f.quant[q], (n, 64)) for f in files for n, q in zip(np.diff(f.first), (p[3] for p in sorted(f.parts.values())))])
    out = np.empty(coefficients.shape, np.uint8)
    for k in range(0, len(out), 4096):
        part = coefficients[k : k + 4096].astype(float)
        if scale is not None:
            part *= scale[k : k + 4096]
        part = part @ _BASIS
        part += 32768 + (128 << 16)
        np.floor_divide(part, 65536, out=part)
        out[k : k + 4096] = part.clip(0, 255, out=part)
    return out


def tensor(f: File, values: np.ndarray) -> np.ndarray:
    """Full-resolution RGB of a file from its blocks' samples; chroma samples are repeated, in whole numbers throughout."""
    planes = []
    for i, h, v, _ in sorted(f.parts.values()):
        rows, cols = f.shape[i]
        plane = values[f.first[i] : f.first[i + 1]].reshape(rows, cols, 8, 8).swapaxes(1, 2).reshape(8 * rows, 8 * cols)
        planes.append((plane, f.v // v, f.h // h))
    if len(planes) == 1:
        return planes[0][0][: f.height, : f.width, None].repeat(3, axis=2)
    # Colour differences are reckoned before they are repeated.
    if planes[1][1:] != planes[2][1:]:
        planes[1:] = [(p.repeat(v, axis=0).repeat(h, axis=1), 1, 1) for p, v, h in planes[1:]]
    luma, down, across = planes[0]
    luma = luma.repeat(down, axis=0).repeat(across, axis=1).astype(np.int32) if down * across > 1 else luma.astype(np.int32)
    cb, cr = planes[1][0].astype(np.int32) - 128, planes[2][0].astype(np.int32) - 128
    _, down, across = planes[1]
    luma = luma.reshape(len(cb), down, cb.shape[1], across)
    rgb = np.empty((*luma.shape, 3), np.uint8)
    for c, difference in enumerate((91881 * cr + 32768 >> 16, -(22554 * cb + 46802 * cr + 32768 >> 16), 116130 * cb + 32768 >> 16)):
        full = luma + difference[:, None, :, None]
        rgb[..., c] = full.clip(0, 255, out=full)
    return rgb.reshape(len(cb) * down, cb.shape[1] * across, 3)[: f.height, : f.width]


def padded(text: str) -> bytes:
    """UTF-8 of a text and bytes 255 up to a positive multiple of the unit."""
    data = text.encode()
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def groups(sizes: list[int]) -> Iterator[slice]:
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > GROUP:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if sizes:
        yield slice(start, len(sizes))


_COLUMNS = "doc_id long, n_bytes long, media binary, payload binary, height int, width int, rgb binary, feature string"
_MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
_READ_BACK = pa.schema([*_MEDIA, *(
    ("payload", pa.binary()), ("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary()), ("feature", pa.string())
)])


def _encoded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
    for s in groups([len(t) for t in texts]):
        yield record(_MEDIA, ids[s], [len(t.encode()) for t in texts[s]], encode([padded(t) for t in texts[s]]))


def _decoded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    files = batch.column("media").to_pylist()
    kept = [batch.column(c).to_pylist() for c in ("doc_id", "n_bytes")]
    for s in groups([len(f) for f in files]):
        got = decode(files[s])
        payloads = [(c.ravel() + 128).astype(np.uint8).tobytes()[: struct.unpack(">Q", note)[0]] for note, c, _ in got]
        tensors = [t for _, _, t in got]
        yield record(
            _READ_BACK, *(k[s] for k in kept), files[s], payloads, [t.shape[0] for t in tensors], [t.shape[1] for t in tensors],
            [t.tobytes() for t in tensors], [feature(t) for t in tensors],
        )


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (of the text), media (a progressive JPEG file of the padded text)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _encoded(batch)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def from_media(media: DataFrame) -> DataFrame:
    """media with payload (the stored bytes), height, width, rgb (the tensor, row by row) and feature (its statistics)."""
    bounded_batches(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _decoded(batch)

    return media.mapInArrow(run, _COLUMNS)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """from_media(to_media(docs)) in one pass of a worker: the files do not travel to Spark and back in between."""
    bounded_batches(docs.sparkSession, mb=4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stored in _encoded(batch):
                yield from _decoded(stored)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _COLUMNS)


def feature(rgb: np.ndarray) -> str:
    """Size, and mean and standard deviation of each channel."""
    flat = rgb.reshape(-1, 3).astype(np.int64)
    n, sums, squares = len(flat), flat.sum(axis=0), (flat * flat).sum(axis=0)
    spread = np.sqrt((n * squares - sums * sums).astype(float)) / n
    return f"{rgb.shape[0]}x{rgb.shape[1]} " + " ".join(f"{s / n:.3f}+-{d:.3f}" for s, d in zip(sums.tolist(), spread.tolist()))
