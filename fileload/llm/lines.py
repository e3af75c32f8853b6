"""Line dedup: windows of three lines that an earlier document has are removed.

Every window of three consecutive lines is hashed to 128 bits and its smallest
document id found globally.  A window is a later occurrence if a document with a
smaller id has it, or the same document has it further up.  The lines of all later
occurrences go; overlapping windows merge into one run of covered lines.

Cases: lines end at ``\\n`` and are compared unchanged; windows without any word do
not count; a document of fewer than three lines has none; a null text stays null
(no lines), an empty one has one empty line; null ids come after all others; rows
that share an id do not count against each other, and equal rows get one result;
input columns named like a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from fileload.llm.text import SPACED, col, emit_texts, keyed, map_texts, range_hash, text_bytes, without

LINES = 3

_WINDOW = StructType(
    [
        StructField("h1", LongType()),
        StructField("h2", LongType()),
        StructField("id", LongType()),
        StructField("th", LongType()),
        StructField("line", IntegerType()),
    ]
)
RESULT = StructType([StructField("deduped", StringType()), StructField("n_lines", LongType()), StructField("n_removed", LongType())])
_VALUES = np.random.default_rng(77).integers(1, 2**63, (2, 256), np.uint64)
_BASES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class LineWindows:
    """Lines of a slice of texts and the hashes of their windows."""

    def __init__(self, texts: pa.Array, size: int):
        offsets, self.data = text_bytes(texts)
        # A line feed or a text's end closes a line.
        feeds = np.flatnonzero(self.data == 0x0A)
        doc = np.searchsorted(offsets, feeds, "right") - 1
        n = len(offsets) - 1
        self.counts = np.bincount(doc, minlength=n) + 1
        if texts.null_count:
            self.counts -= texts.is_null().to_numpy(zero_copy_only=False)
        self.first = np.r_[0, np.cumsum(self.counts)]
        last = self.first[1:][self.counts > 0] - 1
        self.ends = np.empty(self.first[-1], np.int64)
        inner = np.ones(len(self.ends), bool)
        inner[last] = False
        self.ends[inner] = feeds
        self.ends[last] = offsets[1:][self.counts > 0]
        self.starts = np.r_[0, self.ends[:-1] + 1][: len(self.ends)]
        self.starts[self.first[:-1][self.counts > 0]] = offsets[:-1][self.counts > 0]
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.ends))
        seen = np.r_[0, np.cumsum(SPACED[self.data])]
        worded = seen[self.ends] > seen[self.starts]
        some = np.r_[0, np.cumsum(worded)]
        at = np.flatnonzero(left >= size)
        self.at = at[some[at + size] > some[at]]
        self.doc = np.searchsorted(self.first, self.at, "right") - 1
        self.h1, self.h2 = (self._hash(k, size) for k in range(2))

    def _hash(self, k: int, size: int) -> np.ndarray:
        line = range_hash(_VALUES[k][self.data], self.starts, self.ends, _BASES[k][0])
        return range_hash(line, self.at, self.at + size, _BASES[k][1]).astype(np.int64)

    def firsts(self) -> np.ndarray:
        """Whether a window is the first of its kind in its text."""
        order = np.lexsort((self.at, self.h2, self.h1, self.doc))
        new = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        new[1:] = (self.h1[a] != self.h1[b]) | (self.h2[a] != self.h2[b]) | (self.doc[a] != self.doc[b])
        first = np.empty(len(order), bool)
        first[order] = new
        return first


def line_dedup(docs: DataFrame, size: int = LINES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``deduped`` (the text without covered lines), ``n_lines`` and
    ``n_removed``.

    One row for each different window of a document is shuffled, as hashes; a hot
    window is counted before the shuffle.  Only documents' ids come back to be joined.
    """

    def windows(texts, ids, ths):
        lines = LineWindows(texts, size)
        first = lines.firsts()
        doc, at = lines.doc[first], lines.at[first]
        return [
            pa.array(lines.h1[first]),
            pa.array(lines.h2[first]),
            ids.take(pa.array(doc)),
            ths.take(pa.array(doc)),
            pa.array((at - lines.first[doc]).astype(np.int32)),
        ]

    rows = keyed(docs, id_col, text_col)
    found = emit_texts(rows, text_col, ["__id", "__th"], _WINDOW, windows)
    shared = found.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").drop("hi")
    later = found.join(shared, ["h1", "h2"]).where("id > lo")
    covered = later.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set("line").alias("__later"))
    joined = rows.join(covered, ["__id", "__th"], "left").drop("__id", "__th")

    def remove(texts, later):
        lines = LineWindows(texts, size)
        gone = ~lines.firsts()
        flat = later.flatten().to_numpy(zero_copy_only=False)
        counts = later.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), counts)
        gone[np.searchsorted(lines.at, lines.first[owner] + flat)] = True
        cover = np.zeros(len(lines.ends) + 1, np.int32)
        np.add.at(cover, lines.at[gone], 1)
        np.add.at(cover, lines.at[gone] + size, -1)
        keep = np.cumsum(cover[:-1]) == 0
        removed = lines.counts - np.add.reduceat(np.r_[keep, 0].astype(np.int64), lines.first[:-1]) * (lines.counts > 0)
        kept = []
        for d, text in enumerate(texts.to_pylist()):
            if removed[d]:
                s, e = lines.first[d], lines.first[d + 1]
                own = np.flatnonzero(keep[s:e]) + s
                text = b"\n".join([lines.data[lines.starts[i] : lines.ends[i]].tobytes() for i in own]).decode()
            kept.append(text)
        return [pa.array(kept, pa.string()), pa.array(lines.counts.astype(np.int64)), pa.array(removed)]

    return map_texts(joined, text_col, RESULT, remove, ("__later",)).drop("__later")


def remove_lines(docs: DataFrame, size: int = LINES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, in their own columns, with the deduped text; documents that lost all
    of their lines are copies of earlier ones and go."""
    rows = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("row"), col(id_col).alias("id"), col(text_col).alias("text"))
    found = line_dedup(rows, size, id_col="id", text_col="text")
    left = found.where(~((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))))
    rest = without(docs.columns, [text_col])
    return left.select(*(F.col("row").getField(c).alias(c) if c in rest else F.col("deduped").alias(c) for c in docs.columns))
