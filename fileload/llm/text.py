"""Texts in Arrow batches as flat numpy arrays: words, hashes, windows.

Shared by the operators that work inside tasks.  A batch is cut into slices of
bounded size, so that memory follows the slice (or one long text), not the batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words parted by ASCII white space, and of words of letters and digits.
SPACED = ~_SPACE
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_U = np.uint64
# Byte values and odd multipliers of two independent hash functions.
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_STEPS = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)


def process_cache(name: str) -> dict:
    """A dict that lives as long as this Python process.  It hangs on a module that
    is pickled by name, so what the driver puts in never travels with a closure, and
    a worker's tasks share it although each unpickles this package anew."""
    return sys.__dict__.setdefault("_fileload_caches", {}).setdefault(name, {})


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Powers of a base that a process keeps.
KEPT_POWERS = 1 << 18


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    known = process_cache("powers")
    if n <= KEPT_POWERS and base in known:
        return known[base][:n]
    steps = np.full(max(n, KEPT_POWERS), base, np.uint64)
    steps[:1] = 1
    made = np.cumprod(steps)
    if n <= KEPT_POWERS:
        made.flags.writeable = False
        known[base] = made
    return made[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[s:e] for every range, from one running sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(base, n), out=sums[1:])
    inverse = _power(pow(base, -1, 2**64), n + 1)
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a slice of texts.  ``first[d]:first[d+1]`` are those of text d."""

    def __init__(self, texts: pa.Array, table: np.ndarray = SPACED, lower: bool = False):
        offsets, data = text_bytes(texts)
        if lower:
            data = _LOWER[data]
        self.data, self.offsets = data, offsets
        word = table[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        before[edge[:-1]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        after[edge[1:]] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return range_hash(_VALUES[which][self.data], self.starts, self.ends, _BASES[which])

    def docs(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, hashes: np.ndarray, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of n words inside one text, and their hashes."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        at = np.flatnonzero(left >= n)
        return at, range_hash(hashes, at, at + n, _STEPS[which])

    def joined(self, first: int, end: int) -> bytes:
        """Words first..end-1 with one space between."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[first:end], self.ends[first:end]))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and UTF-8 bytes of string texts; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    if where is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(where, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, or of one longer text."""
    offsets, _ = text_bytes(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0]..+lengths[0], starts[1]..+lengths[1], ... as one index array."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def without(columns: list[str], names: list[str]) -> list[str]:
    """Columns that do not clash with result columns; Spark ignores case."""
    taken = {name.lower() for name in names}
    return [c for c in columns if c.lower() not in taken]


def col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def map_texts(
    df: DataFrame,
    text_col: str,
    fields: StructType,
    fn: Callable[[pa.Array], list[pa.Array]],
    inputs: tuple[str, ...] = (),
    slice_bytes: int = SLICE_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """Columns of ``df`` beside result columns that ``fn`` makes from slices of texts.

    ``fn`` gets the texts and then the ``inputs`` columns, and returns an array for
    each of ``fields``.  Result columns replace input columns of the same name.
    """
    keep = without(df.columns, fields.names if keep_text else [*fields.names, text_col])
    given = [text_col, *inputs]
    source = df.select(
        *(col(c) for c in keep),
        *((col(c).cast("string") if c == text_col else col(c)).alias(f"__in{i}") for i, c in enumerate(given)),
    )
    schema = StructType([*(source.schema[i] for i in range(len(keep))), *fields])
    n, names = len(keep), schema.names

    def run(batches):
        for batch in batches:
            texts = batch.column(n)
            for lo, hi in slices(texts, slice_bytes):
                part = batch.slice(lo, hi - lo)
                made = fn(part.column(n), *(part.column(n + 1 + i) for i in range(len(inputs))))
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *made], names=names)

    return source.mapInArrow(run, schema)


def emit_texts(
    df: DataFrame,
    text_col: str,
    inputs: list[str],
    schema: StructType,
    fn: Callable[..., list[pa.Array]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Any number of rows of ``schema`` from slices of texts and ``inputs`` columns."""
    source = df.select(col(text_col).cast("string"), *(col(c) for c in inputs))
    names = schema.names

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(0), slice_bytes):
                made = fn(*batch.slice(lo, hi - lo).columns)
                if made is not None and len(made[0]):
                    yield pa.RecordBatch.from_arrays(made, names=names)

    return source.mapInArrow(run, schema)


#: Stands for a null id, after all others.
LAST_ID = 2**63 - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__id`` and ``__th``, which tell rows apart by id and text.
    Rows equal in both count as one document listed more than once."""
    return docs.withColumns(
        {
            "__id": F.coalesce(col(id_col).cast("long"), F.lit(LAST_ID)),
            "__th": F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit(""))),
        }
    )
