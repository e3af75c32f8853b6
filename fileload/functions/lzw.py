"""Helper used inside Arrow stages: the Unix ``compress`` (.Z) byte format.

Work is done on whole blocks of codes with numpy: bits are unpacked for a
stretch of equal-width codes at once, table entries are derived for a block at
once, and all phrases of a block are written out together, one byte position
per step.  The table is a few flat arrays of at most 65536 entries, so memory
does not depend on how long the phrases get.

A payload is bytes in memory or an open file, read a few megabytes ahead.  CLEAR
starts a table with nothing of the old one, so the stretch from one CLEAR to the next
can be decoded alone; ``survey`` finds the stretches.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Fixed values of the .Z format.
MAGIC = b"\x1f\x9d"
WIDTH_MASK = 0x1F
BLOCK_FLAG = 0x80
MIN_WIDTH = 9
MAX_WIDTH = 16
CLEAR = 256
HEADER = 3
CHECK_GAP = 10000

# Codes handled together; a multiple of 8, the group size of the format.
_BLOCK = 1 << 16


def read_header(payload) -> tuple[str, int | None, bool | None]:
    """``(status, code width, block mode)`` from the first three bytes."""
    head = bytes(payload[:3])
    if len(head) < 3 or head[:2] != MAGIC:
        return "bad_magic", None, None
    width, block = head[2] & WIDTH_MASK, bool(head[2] & BLOCK_FLAG)
    status = "ok" if MIN_WIDTH <= width <= MAX_WIDTH else "bad_width"
    return status, width, block


class Held:
    """A payload in memory."""

    def __init__(self, payload):
        self.data = np.frombuffer(payload, np.uint8)
        self.size = len(self.data)

    def take(self, pos: int, count: int) -> np.ndarray:
        return self.data[pos : pos + count]


class Opened:
    """A payload in an open file (``read_at(count, pos)``) of ``size`` bytes."""

    def __init__(self, file, size: int, ahead: int = 4 << 20):
        self.file, self.size, self.ahead = file, size, ahead
        self.start, self.data = 0, np.empty(0, np.uint8)

    def take(self, pos: int, count: int) -> np.ndarray:
        count = min(count, self.size - pos)
        if pos < self.start or pos + count > self.start + len(self.data):
            self.data = np.frombuffer(self.file.read_at(max(count, self.ahead), pos), np.uint8)
            self.start = pos
            if len(self.data) < count:
                raise EOFError(f"the file ends {count - len(self.data)} bytes early")
        return self.data[pos - self.start : pos - self.start + count]


def _source(payload) -> Held | Opened:
    return payload if hasattr(payload, "take") else Held(payload)


def _first_free(block: bool) -> int:
    return CLEAR + 1 if block else CLEAR


def _widest(max_bits: int) -> int:
    # A file flagged 9 still moves to 10-bit codes once its 512 entries are used.
    return max(max_bits, MIN_WIDTH + 1)


def _unpack(raw: np.ndarray, count: int, width: int) -> np.ndarray:
    """``count`` little-endian ``width``-bit codes, eight codes per row."""
    groups = -(-count // 8)
    rows = np.zeros((groups, width + 4), np.uint8)
    flat = np.zeros(groups * width, np.uint8)
    flat[: len(raw)] = raw
    rows[:, :width] = flat.reshape(groups, width)
    codes = np.empty((groups, 8), np.int32)
    for k in range(8):
        byte, shift = divmod(k * width, 8)
        word = rows[:, byte].astype(np.int32)
        word |= rows[:, byte + 1].astype(np.int32) << 8
        word |= rows[:, byte + 2].astype(np.int32) << 16
        codes[:, k] = (word >> shift) & ((1 << width) - 1)
    return codes.ravel()[:count]


def _pack(codes: np.ndarray, width: int) -> bytes:
    out = []
    for start in range(0, len(codes), _BLOCK):
        pairs = codes[start : start + _BLOCK].astype("<u2").view(np.uint8).reshape(-1, 2)
        bits = np.unpackbits(pairs, axis=1, bitorder="little")
        out.append(np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def code_runs(
    payload, max_bits: int, block: bool, start: int = HEADER, stop: int | None = None
) -> Iterator[tuple[np.ndarray, int, bool, int]]:
    """Yield ``(codes, free, fresh, at)``: codes in reading order, the next free
    table entry before them, whether they open a new table (the first code of a table
    defines no entry), and the byte where the table begins.  CLEAR codes are consumed
    here.  ``start`` is where some table begins, ``stop`` where a later one does."""
    source = _source(payload)
    limit, top = 1 << max_bits, _widest(max_bits)
    size = source.size if stop is None else stop
    first = _first_free(block)
    pos, width, free, fresh, at = start, MIN_WIDTH, first, True, start
    held: list[np.ndarray] = []
    held_from = (free, fresh, at)
    while True:
        growing = width < top
        # The width changes as soon as the next free entry does not fit in it.
        want = (1 << width) - free + fresh if growing else _BLOCK
        take = max(0, min(want, (size - pos) * 8 // width))
        codes = _unpack(source.take(pos, (take * width + 7) // 8), take, width)
        cleared = np.flatnonzero(codes == CLEAR)[:1] if block else codes[:0]
        if cleared.size:
            place = int(cleared[0])
            # A CLEAR where a literal must stand is left in, to be rejected.
            codes = codes[: place or int(fresh)]
        if codes.size:
            held.append(codes)
        if cleared.size or take < want or not growing:
            if held:
                yield np.concatenate(held), *held_from
                held = []
        if cleared.size:
            # The rest of the group of eight codes is padding.
            pos += (place // 8 + 1) * width
            width, free, fresh, at = MIN_WIDTH, first, True, pos
            held_from = (free, fresh, at)
            continue
        if take < want:
            return
        free = min(free + take - fresh, limit)
        fresh = False
        pos += -(-take // 8) * width
        width += growing
        if not held:
            held_from = (free, fresh, at)


def _codes_sound(codes: np.ndarray, free: int, fresh: bool, limit: int) -> bool:
    """Whether every code refers to an entry that exists when it is read."""
    if fresh and codes[0] >= CLEAR:
        return False
    rest = codes[int(fresh) :]
    return not (rest > np.minimum(np.arange(free, free + len(rest)), limit - 1)).any()


def is_sound(payload, max_bits: int, block: bool) -> bool:
    """True when every code of the payload is sound."""
    return all(_codes_sound(codes, free, fresh, 1 << max_bits) for codes, free, fresh, _ in code_runs(payload, max_bits, block))


class _Table:
    """Phrases by code: the phrase before the last byte, that byte, the first byte,
    the length."""

    def __init__(self, max_bits: int):
        self.limit = limit = 1 << max_bits
        self.prefix = np.zeros(limit, np.int32)
        self.suffix = np.zeros(limit, np.uint8)
        self.lead = np.zeros(limit, np.uint8)
        self.length = np.zeros(limit, np.int64)
        self.suffix[:256] = self.lead[:256] = np.arange(256)
        self.length[:256] = 1
        self.last = 0

    def learn(self, codes: np.ndarray, free: int, fresh: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Enter the phrases that a run of codes makes.  Returns of each new one the
        number of the first old phrase under it, and for each doubling of the stride
        which of the new ones took which step; nothing when none is new."""
        before = np.concatenate([codes[:1] if fresh else [self.last], codes[:-1]])
        made = slice(int(fresh), int(fresh) + self.limit - free)
        parents, seen = before[made], codes[made]
        self.last = int(codes[-1])
        if not len(parents):
            return None
        new = slice(free, free + len(parents))
        # Follow parents that lie in this run, doubling the stride.
        root, steps, hops = parents.copy(), np.ones(len(parents), np.int64), []
        while (inner := np.flatnonzero(root >= free)).size:
            hop = root[inner] - free
            steps[inner] += steps[hop]
            root[inner] = root[hop]
            hops.append((inner, hop))
        self.prefix[new] = parents
        self.length[new] = self.length[root] + steps
        self.lead[new] = self.lead[root]
        self.suffix[new] = self.lead[seen]
        return new, root, hops


def decode(
    payload, max_bits: int, block: bool, chunk: int = 1 << 22, start: int = HEADER, stop: int | None = None
) -> Iterator[bytes]:
    """Decode a sound payload, or a stretch of it, yielding pieces of about ``chunk`` bytes."""
    table = _Table(max_bits)
    length = table.length
    for codes, free, fresh, _ in code_runs(payload, max_bits, block, start, stop):
        table.learn(codes, free, fresh)
        ends = np.cumsum(length[codes])
        begin, done = 0, 0
        while begin < len(codes):
            end = max(begin + 1, int(np.searchsorted(ends, done + chunk)))
            yield _phrases(codes[begin:end], ends[begin:end] - done, table.prefix, table.suffix)
            begin, done = end, int(ends[end - 1])


@dataclass(frozen=True)
class Stretch:
    """Bytes ``start`` to ``stop`` of a payload, and how many newlines come before."""

    start: int
    stop: int
    newlines: int


@dataclass(frozen=True)
class Survey:
    sound: bool
    stretches: list[Stretch]
    n_lines: int
    n_bytes: int


def survey(payload, max_bits: int, block: bool, least: int) -> Survey:
    """Check a payload and cut it at CLEARs into stretches of at least ``least`` bytes,
    in one pass that counts bytes and newlines phrase by phrase and writes none out."""
    source = _source(payload)
    table, newlines = _Table(max_bits), np.zeros(1 << max_bits, np.int64)
    newlines[10] = 1
    starts, lines, size, last = [(HEADER, 0)], 0, 0, 10
    for codes, free, fresh, at in code_runs(source, max_bits, block):
        if not _codes_sound(codes, free, fresh, table.limit):
            return Survey(False, [], 0, 0)
        if fresh and at - starts[-1][0] >= least:
            starts.append((at, lines))
        learned = table.learn(codes, free, fresh)
        if learned:
            new, root, hops = learned
            grown = (table.suffix[new] == 10).astype(np.int64)
            for inner, hop in hops:
                grown[inner] += grown[hop]
            newlines[new] = newlines[root] + grown
        lines += int(newlines[codes].sum())
        size += int(table.length[codes].sum())
        last = int(table.suffix[codes[-1]])
    stops = [at for at, _ in starts[1:]] + [source.size]
    stretches = [Stretch(at, stop, before) for (at, before), stop in zip(starts, stops)]
    return Survey(True, stretches, lines + (last != 10), size)


def stretch_lines(payload, max_bits: int, block: bool, stretch: Stretch) -> Iterator[bytes]:
    """Bytes of the lines that begin in a stretch, or where it stops.  Its first bytes
    up to a newline belong to a line of the stretch before, and the last line is
    read to its end in the stretches after."""
    source = _source(payload)
    pieces = decode(source, max_bits, block, start=stretch.start, stop=stretch.stop)
    if stretch.start > HEADER:
        for piece in pieces:
            cut = piece.find(b"\n") + 1
            if cut:
                yield piece[cut:]
                break
        else:
            return
    yield from pieces
    if stretch.stop < source.size:
        for piece in decode(source, max_bits, block, chunk=1 << 16, start=stretch.stop):
            cut = piece.find(b"\n") + 1
            yield piece[:cut] if cut else piece
            if cut:
                return


def _phrases(codes, ends, prefix, suffix) -> bytes:
    """All phrases of ``codes``, each written backwards from its end."""
    out = np.empty(int(ends[-1]), np.uint8)
    at = ends - 1
    while True:
        out[at] = suffix[codes]
        deeper = np.flatnonzero(codes >= CLEAR)
        if not deeper.size:
            return out.tobytes()
        codes = prefix[codes[deeper]]
        at = at[deeper] - 1


def _spans(count: int, first_free: int, top: int) -> Iterator[tuple[int, int, int]]:
    """``(start, stop, width)`` of each equal-width stretch of a table's codes."""
    start, stop, width = 0, (1 << MIN_WIDTH) - first_free + 1, MIN_WIDTH
    while start < count:
        if width == top:
            stop = count
        yield start, min(stop, count), width
        start, stop, width = stop, stop + (1 << width), width + 1


def _packed(codes: array, first_free: int, top: int, cleared: bool) -> bytes:
    flat = np.frombuffer(codes, np.uint16)
    out = []
    for start, stop, width in _spans(len(flat), first_free, top):
        raw = _pack(flat[start:stop], width)
        # Readers take codes in groups of eight; a new width starts a new group.
        if stop < len(flat) or cleared:
            raw = raw.ljust(-(-(stop - start) // 8) * width, b"\0")
        out.append(raw)
    return b"".join(out)


class Encoder:
    """``.Z`` bytes of text that comes in pieces; the table is cleared when it stops
    paying.  Only codes and what they were packed to are held, not the text."""

    def __init__(self, max_bits: int = MAX_WIDTH, block: bool = True):
        if not MIN_WIDTH <= max_bits <= MAX_WIDTH:
            raise ValueError(f"code width must be {MIN_WIDTH}..{MAX_WIDTH}, not {max_bits}")
        self.first, self.top, self.limit, self.block = _first_free(block), _widest(max_bits), 1 << max_bits, block
        self.out = [MAGIC + bytes((max_bits | (BLOCK_FLAG if block else 0),))]
        self.read, self.written, self.rest = 0, 3, b""
        self._clear()

    def _clear(self) -> None:
        # (phrase code << 8 | next byte) -> code of the longer phrase
        self.table: dict[int, int] = {}
        self.free, self.phrase, self.codes, self.best = self.first, -1, array("H"), 0.0

    def add(self, data: bytes) -> None:
        """Encode more text, as far as it fills stretches after which the ratio is checked."""
        data = self.rest + data
        whole = len(data) // CHECK_GAP * CHECK_GAP
        for start in range(0, whole, CHECK_GAP):
            self._encode(data[start : start + CHECK_GAP])
        self.rest = data[whole:]

    def _encode(self, piece: bytes) -> None:
        table, free, phrase, limit = self.table, self.free, self.phrase, self.limit
        put, get = self.codes.append, table.get
        for byte in piece:
            key = phrase << 8 | byte
            longer = get(key)
            if longer:
                phrase = longer
                continue
            if phrase >= 0:
                put(phrase)
                if free < limit:
                    table[key] = free
                    free += 1
            phrase = byte
        self.free, self.phrase = free, phrase
        self.read += len(piece)
        if self.block and free == limit:
            bits = sum((stop - begin) * width for begin, stop, width in _spans(len(self.codes), self.first, self.top))
            ratio = self.read / (self.written + bits / 8)
            if ratio > self.best:
                self.best = ratio
                return
            self.codes.extend((phrase, CLEAR))
            self.out.append(_packed(self.codes, self.first, self.top, True))
            self.written += len(self.out[-1])
            self._clear()

    def close(self) -> bytes:
        """The whole payload."""
        if self.rest:
            self._encode(self.rest)
        if self.phrase >= 0:
            self.codes.append(self.phrase)
        self.out.append(_packed(self.codes, self.first, self.top, False))
        return b"".join(self.out)


def encode(data: bytes, max_bits: int = MAX_WIDTH, block: bool = True) -> bytes:
    """``.Z`` bytes for ``data``."""
    encoder = Encoder(max_bits, block)
    encoder.add(data)
    return encoder.close()
