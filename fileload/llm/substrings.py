"""Substring dedup: suffix automata of reference shards, documents streamed past them.

A window of SPAN consecutive words goes if a document with a smaller id has it too.
Which texts need looking at is found by minimizers: the smallest hash of the
GRAM-word groups inside a window depends on the window alone, so equal windows of two
documents share it.  Minimizers of one document only are dropped.  A run of windows
with one minimizer is a segment; a segment that many documents have is kept once,
with its smallest id.

The minimizers deal the segments out to shards.  Of each shard's segments, in the
order of their ids, a task builds a suffix automaton over words, streams the same
segments through it for their matching statistics, cut at SPAN words, and so learns
where a window's words first occurred.  Where a crowd of different segments has one
minimizer, no automaton holds them: each different one, not each document's, is cut into
windows (named by 128-bit hashes), and the smallest first id of a window tells.

Sending automata of all shards to all tasks, as broadcasts would, costs shards times
documents; dealt by minimizer, each part of a document meets only the one shard that
can hold its match.

Cases: words are parted by ASCII white space; a null or empty text has none; null ids
are larger than all others; rows that share an id do not count against each other and
equal rows get equal results; input columns named like a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fileload.llm.text import Words, col, emit_texts, keyed, map_texts, ragged
from fileload.session import stage_table

SPAN, GRAM = 50, 10
#: Different segments of one minimizer, beyond which they are cut into windows.
CROWD = 500

_MARKS = StructType([StructField("mark", LongType()), StructField("id", LongType()), StructField("th", LongType())])
_SEGMENTS = StructType(
    [
        StructField("shard", LongType()),
        StructField("id", LongType()),
        StructField("th", LongType()),
        StructField("starts", ArrayType(IntegerType())),
        StructField("n", IntegerType()),
        StructField("words", StringType()),
    ]
)
_OWN = StructType(
    [
        StructField("shard", LongType()),
        StructField("words", LongType()),
        StructField("places", ArrayType(IntegerType())),
    ]
)
_WINDOWS = StructType(
    [
        *(StructField(name, LongType()) for name in ("one", "two", "shard", "key", "first")),
        StructField("at", IntegerType()),
    ]
)
RESULT = StructType([StructField("deduped", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())])


def _minimizers(words: Words, hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window of ``span`` words, and the smallest hash of the
    GRAM-word groups inside it."""
    at, low = words.windows(hashes, min(GRAM, span))
    # Over all positions: groups of different texts don't mix, since windows don't.
    whole = np.full(len(words) + 1, np.uint64(2**64 - 1))
    whole[at] = low
    width = span - min(GRAM, span) + 1
    size, best = 1, whole
    while size * 2 <= width:
        best = np.minimum(best[: len(best) - size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size :])
    starts, _ = words.windows(hashes, span)
    return starts, best[starts]


class SuffixAutomaton:
    """Of strings of word numbers; every state knows where its words first ended."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def add(self, string: list[int], at: int) -> None:
        """Add a string whose first word has the place ``at``, larger than all before."""
        nexts, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for place, c in enumerate(string, at):
            known = nexts[last].get(c)
            if known is not None:  # only at the start of a string met before
                if length[known] == length[last] + 1:
                    last = known
                    continue
                last = self._split(last, c, known)
                continue
            state = len(nexts)
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            first.append(place)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = state
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[state] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = state

    def _split(self, p: int, c: int, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        clone = len(nexts)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        self.first.append(self.first[q])
        link[q] = clone
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def statistics(self, string: list[int], most: int):
        """For every word: the longest match that ends there, up to ``most`` words, and
        the place where it first ended."""
        nexts, link, length, first = self.next, self.link, self.length, self.first
        state = size = 0
        for c in string:
            while state and c not in nexts[state]:
                state = link[state]
                size = length[state]
            state = nexts[state].get(c, 0)
            size = size + 1 if state else 0
            if size > most:
                size = most
            while state and length[link[state]] >= size:
                state = link[state]
            yield size, first[state]


def _shard(rows: list[tuple[int, str, int]], span: int):
    """Of one minimizer's segments (smallest id, words, key), by id: for each that has
    windows of a smaller id, its key and those windows."""
    automaton, number = SuffixAutomaton(), {}
    strings, owner = [], []
    for doc, words, _ in rows:
        string = [number.setdefault(w, len(number)) for w in words.split(" ")]
        automaton.add(string, len(owner))
        owner += [doc] * len(string)
        strings.append(string)
    for (doc, _, key), string in zip(rows, strings):
        places = [i - span + 1 for i, (size, end) in enumerate(automaton.statistics(string, span)) if size >= span and owner[end] < doc]
        if places:
            yield key, places


def earlier_spans(docs: DataFrame, span: int, id_col: str, text_col: str) -> DataFrame:
    """``__id, __th, __spans``: ranges (first word and end, flat) of words to remove."""
    rows = keyed(docs, id_col, text_col)

    def marks(texts, ids, ths):
        words = Words(texts)
        at, low = _minimizers(words, words.hashes(), span)
        doc = np.searchsorted(words.first, at, "right") - 1
        order = np.lexsort((low, doc))
        low, doc = low[order], doc[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
        owner = pa.array(doc[new])
        return [pa.array(low[new].astype(np.int64)), ids.take(owner), ths.take(owner)]

    found = emit_texts(rows, text_col, ["__id", "__th"], _MARKS, marks)
    shared = found.groupBy("mark").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("mark")
    wanted = found.join(shared, "mark").groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set("mark").alias("__marks"))

    def segments(texts, ids, ths, marks):
        words = Words(texts)
        hashes = words.hashes()
        at, low = _minimizers(words, hashes, span)
        low = low.astype(np.int64)
        doc = np.searchsorted(words.first, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(at)])
        head, mark, owner = at[first], low[first], doc[first]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        # A segment that a document repeats is one row with all of its places.
        places: dict[tuple, list[int]] = {}
        for d in range(len(texts)):
            lo, hi = bounds[d], bounds[d + 1]
            some = np.isin(mark[lo:hi], np.asarray(marks[d].values))
            for i in (lo + np.flatnonzero(some)).tolist():
                n = int(count[i]) + span - 1
                key = (int(mark[i]), d, n, words.joined(head[i], head[i] + n))
                places.setdefault(key, []).append(int(head[i] - words.first[d]))
        out = [list(x) for x in zip(*places)] or [[], [], [], []]
        of = pa.array(out[1], pa.int64())
        return [
            pa.array(out[0], pa.int64()),
            ids.take(of),
            ths.take(of),
            pa.array(list(places.values()), pa.list_(pa.int32())),
            pa.array(out[2], pa.int32()),
            pa.array([x.decode() for x in out[3]], pa.string()),
        ]

    near = rows.select("__id", "__th", col(text_col).alias("__text")).join(wanted, ["__id", "__th"])
    cut = stage_table(emit_texts(near, "__text", ["__id", "__th", "__marks"], _SEGMENTS, segments), "segments")
    return _match(cut, span)


def _windows(once: DataFrame, span: int) -> DataFrame:
    """Windows of different segments, named by 128 bits, with their place in the segment."""

    def run(texts, shards, keys, firsts):
        words = Words(texts)
        (at, one), (_, two) = (words.windows(words.hashes(k), span, k) for k in range(2))
        doc = np.searchsorted(words.first, at, "right") - 1
        of, names = pa.array(doc), [pa.array(x.astype(np.int64)) for x in (one, two)]
        return [*names, shards.take(of), keys.take(of), firsts.take(of), pa.array((at - words.first[doc]).astype(np.int32))]

    return emit_texts(once, "words", ["shard", "key", "first"], _WINDOWS, run)


def _crowded(once: DataFrame, span: int) -> DataFrame:
    """As ``_OWN``, of segments too many for an automaton: of each different one, the
    windows that a segment with a smaller first id has too."""
    windows = stage_table(_windows(once, span), "windows")
    least = windows.groupBy("one", "two").agg(F.min("first").alias("lo"), F.max("first").alias("hi")).where("lo < hi")
    later = windows.join(least.drop("hi"), ["one", "two"]).where("first > lo")
    return later.groupBy("shard", F.col("key").alias("words")).agg(F.collect_set("at").alias("places"))


def _once(cut: DataFrame) -> DataFrame:
    """Each different segment with its smallest and largest id."""
    found = cut.groupBy("shard", "words", "n").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    return stage_table(found.withColumn("key", F.xxhash64("words", "n")), "once")


def _match(cut: DataFrame, span: int) -> DataFrame:
    once = _once(cut)
    crowds = stage_table(once.groupBy("shard").count().where(F.col("count") > CROWD).select("shard"), "crowds")
    some = not crowds.isEmpty()
    few = once.join(crowds, "shard", "left_anti") if some else once
    # Only a shard with several segments can tell more than ids do.
    by_shard = few.repartition("shard").sortWithinPartitions("shard", "first").select("shard", "first", "words", "key")

    def match(batches):
        shard, rows = None, []

        def close():
            found = list(_shard(rows, span)) if len(rows) > 1 else []
            return [(shard, k, p) for k, p in found]

        done = []
        for batch in batches:
            for s, first, words, k in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    done += close()
                    shard, rows = s, []
                rows.append((first, words, k))
            if done:
                yield _own_batch(done)
                done = []
        done += close()
        if done:
            yield _own_batch(done)

    own = by_shard.mapInArrow(match, _OWN)
    if some:
        own = own.union(_crowded(once.join(crowds, "shard", "left_semi"), span))
    told = once.select("shard", F.col("key").alias("words"), "first", "last").join(own, ["shard", "words"], "left")
    told = told.where("last > first or places is not null").drop("last")
    pieces = cut.select("shard", "id", "th", "starts", "n", F.xxhash64("words", "n").alias("words"))
    found = pieces.join(told, ["shard", "words"])
    # Behind the smallest id a whole segment is a copy; at it, the places found.
    whole = F.transform("starts", lambda s: F.struct(s.alias("first"), (s + F.col("n")).alias("end")))
    parts = F.flatten(
        F.transform("starts", lambda s: F.transform("places", lambda p: F.struct((s + p).alias("first"), (s + p + span).alias("end"))))
    )
    spans = found.withColumn("s", F.when(F.col("id") > F.col("first"), whole).otherwise(parts)).where("s is not null")
    return spans.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(
        F.flatten(F.transform(F.flatten(F.collect_set("s")), lambda s: F.array(s["first"], s["end"]))).alias("__spans")
    )


def _own_batch(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_OWN.names)


def substring_dedup(docs: DataFrame, span: int = SPAN, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``deduped`` (the words kept, with one space between), ``n_words``
    and ``n_removed``."""
    spans = earlier_spans(docs, span, id_col, text_col)
    rows = keyed(docs, id_col, text_col).join(spans, ["__id", "__th"], "left").drop("__id", "__th")

    def remove(texts, spans):
        words = Words(texts)
        counts = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // 2
        flat = spans.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
        base = np.repeat(words.first[:-1], counts)
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, base + flat[:, 0], 1)
        np.add.at(cover, base + flat[:, 1], -1)
        keep = np.cumsum(cover[:-1]) == 0
        left = np.r_[0, np.cumsum(keep)][words.first]
        kept_counts = np.diff(left)
        # Words and the blanks between them, copied in one go.
        s, e = words.starts[keep], words.ends[keep]
        sizes = e - s + 1
        data = np.full(int(sizes.sum()), 0x20, np.uint8)
        to = np.cumsum(sizes) - sizes
        data[ragged(to, sizes - 1)] = words.data[ragged(s, sizes - 1)]
        ends = np.r_[0, np.cumsum(sizes)][left]
        raw = data.tobytes()
        texts_left = [raw[a : b - 1].decode() if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [pa.array(texts_left, pa.string()), pa.array(words.counts.astype(np.int64)), pa.array(words.counts - kept_counts)]

    return map_texts(rows, text_col, RESULT, remove, ("__spans",)).drop("__spans")
