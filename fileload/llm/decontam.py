"""Benchmark decontamination: a broadcast set of test n-grams, found in documents.

Cases: a null or empty text has no words, no hit and stays; an item without words
has no window; items and documents may repeat, each row is judged by itself; item
ids are compared as strings, a null id is no item; input columns named like a
result column are replaced; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fileload.llm.text import ALNUM, Words, col, emit_texts, lists, map_texts, without
from fileload.session import stage_table

#: Windows and bytes of one broadcast block; a larger benchmark takes more passes.
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 32 << 20

SPAN = StructType([StructField("first", IntegerType()), StructField("end", IntegerType())])
RESULT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("hit_spans", ArrayType(SPAN)),
        StructField("hit_items", ArrayType(StringType())),
    ]
)
_WINDOW = StructType(
    [
        StructField("item", StringType()),
        StructField("n", IntegerType()),
        StructField("hash", LongType()),
        StructField("words", StringType()),
    ]
)
_SPAN_ARROW = pa.struct([("first", pa.int32()), ("end", pa.int32())])


def test_windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of each item: n consecutive words, or all of a shorter item."""

    def windows(texts, items):
        words = Words(texts, ALNUM, lower=True)
        hashes = words.hashes()
        found: dict[str, list] = {"item": [], "n": [], "hash": [], "words": []}
        for size in {n, *np.unique(words.counts[(words.counts > 0) & (words.counts < n)]).tolist()}:
            at, keys = words.windows(hashes, size)
            doc = np.searchsorted(words.first, at, "right") - 1
            fits = np.full(len(at), True) if size == n else words.counts[doc] == size
            for i, key, d in zip(at[fits].tolist(), keys[fits].astype(np.int64).tolist(), doc[fits].tolist()):
                found["item"].append(items[d].as_py())
                found["n"].append(size)
                found["hash"].append(key)
                found["words"].append(words.joined(i, i + size).decode("utf-8", "replace"))
        return [pa.array(found[f.name], t) for f, t in zip(_WINDOW, (pa.string(), pa.int32(), pa.int64(), pa.string()))]

    named = benchmark.where(col(id_col).isNotNull()).select(col(id_col).cast("string").alias("item"), col(text_col).alias("text"))
    return emit_texts(named, "text", ["item"], _WINDOW, windows).distinct()


class WindowSet:
    """A block of windows as sorted hashes, with the words and items to verify hits."""

    def __init__(self, rows):
        by_hash: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        for item, n, key, words in rows:
            by_hash.setdefault((n, key), {}).setdefault(words.encode(), []).append(item)
        self.texts: dict[int, list[dict[bytes, list[str]]]] = {}
        self.hashes: dict[int, np.ndarray] = {}
        for n, key in sorted(by_hash):
            self.texts.setdefault(n, []).append(by_hash[n, key])
        for n in self.texts:
            self.hashes[n] = np.array([k for m, k in sorted(by_hash) if m == n], np.int64)
        self.bits = {n: self._bits(keys) for n, keys in self.hashes.items()}

    @staticmethod
    def _bits(keys: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 22, bool)
        bits[keys & (len(bits) - 1)] = True
        return bits

    def find(self, words: Words):
        """(window length, first word, items) of every verified window."""
        hashes = words.hashes()
        for n, known in self.hashes.items():
            at, keys = words.windows(hashes, n)
            keys = keys.astype(np.int64)
            near = self.bits[n][keys & ((1 << 22) - 1)]
            at, keys = at[near], keys[near]
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            same = known[place] == keys
            for i, p in zip(at[same].tolist(), place[same].tolist()):
                items = self.texts[n][p].get(words.joined(i, i + n))
                if items:
                    yield n, i, items


def _scan(docs: DataFrame, text_col: str, block, first_pass: bool) -> DataFrame:
    def find(texts, old_spans=None, old_items=None):
        words = Words(texts, ALNUM, lower=True)
        hit = np.zeros(len(words) + 1, np.int32)
        items: list[set] = [set() for _ in range(len(texts))]
        doc_of = words.docs()
        for n, i, found in block.value.find(words):
            hit[i] += 1
            hit[i + n] -= 1
            items[doc_of[i]].update(found)
        if old_spans is not None:
            for d, (spans, more) in enumerate(zip(old_spans.to_pylist(), old_items.to_pylist())):
                items[d].update(more)
                for s in spans:
                    hit[words.first[d] + s["first"]] += 1
                    hit[words.first[d] + s["end"]] -= 1
        covered = np.cumsum(hit[:-1]) > 0
        before = np.zeros(len(words), bool)
        before[1:] = covered[:-1]
        starts_text = words.first[:-1][words.counts > 0]
        before[starts_text] = False
        begins = np.flatnonzero(covered & ~before)
        after = np.zeros(len(words), bool)
        after[:-1] = covered[1:]
        after[words.first[1:][words.counts > 0] - 1] = False
        ends = np.flatnonzero(covered & ~after) + 1
        doc = doc_of[begins]
        base = words.first[doc]
        spans = pa.StructArray.from_arrays(
            [pa.array((begins - base).astype(np.int32)), pa.array((ends - base).astype(np.int32))], fields=list(_SPAN_ARROW)
        )
        return [
            pa.array(words.counts.astype(np.int64)),
            lists(spans, np.bincount(doc, minlength=len(texts))),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        ]

    return map_texts(docs, text_col, RESULT, find, () if first_pass else ("hit_spans", "hit_items"))


def find_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, *, text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (ranges of words inside a test window)
    and ``hit_items`` (sorted ids of the items whose windows occur).

    Words are runs of ASCII letters, digits and all non-ASCII characters, in lower
    case.  The windows are broadcast in blocks of bounded size, one pass over the
    documents for each; documents are never shuffled.
    """
    spark = docs.sparkSession
    windows = stage_table(test_windows(benchmark, n, item_col, item_text), "windows")
    rows, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_WINDOWS), -(-size // BLOCK_BYTES))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("item", "hash"), F.lit(blocks)))
    for k in range(blocks):
        found = WindowSet(windows.where(F.col("block") == k).drop("block").toLocalIterator())
        docs = _scan(docs, text_col, spark.sparkContext.broadcast(found), k == 0)
        if k < blocks - 1:
            docs = stage_table(docs, "hits")
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "spans", *, text_col: str = "text", **columns) -> DataFrame:
    """``docs`` without what ``find_hits`` finds, in their own columns.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` cuts the hit
    words, with what stands between them, out of the text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    found = find_hits(docs.select(F.struct(*(col(c) for c in docs.columns)).alias("row"), col(text_col).alias("text")), benchmark, n, **columns)
    if remove == "documents":
        return found.where(F.size("hit_items") == 0).select("row.*")

    def cut(texts, spans):
        words = Words(texts, ALNUM)
        kept = []
        for d, (text, ranges) in enumerate(zip(texts.to_pylist(), spans.to_pylist())):
            if ranges:
                at, raw, parts = 0, text.encode(), []
                for s in ranges:
                    parts.append(raw[at : words.starts[words.first[d] + s["first"]] - words.offsets[d]])
                    at = words.ends[words.first[d] + s["end"] - 1] - words.offsets[d]
                text = b"".join([*parts, raw[at:]]).decode()
            kept.append(text)
        return [pa.array(kept, pa.string())]

    cleaned = map_texts(found, "text", StructType([StructField("__clean", StringType())]), cut, ("hit_spans",))
    rest = without(docs.columns, [text_col])
    return cleaned.select(*(F.col("row").getField(c).alias(c) if c in rest else F.col("__clean").alias(c) for c in docs.columns))
