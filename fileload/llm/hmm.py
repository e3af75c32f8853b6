"""Language-model scoring with a hidden Markov model over words.

States emit symbols.  The OWN most frequent training words are symbols of their own;
all others share CLASSES symbols by their last letters, and the end of a text is one.
A word in a class then has the add-one share of its count in that class, so the model
is a distribution over all words, seen or not, however large the vocabulary grows.
Baum-Welch counts are made in tasks and summed by Spark; each round only has as many
sums as the model has parameters.  Every round runs over all training texts, whose
symbols are made once and kept as a table.  Scores are exact: a scaled forward
recursion over whole texts.

Word counts stay a table.  Of it, at most KNOWN words, the most frequent, are
broadcast; other words of a text meet their counts in a join.

Cases: a null or empty text is its end alone; texts and ids may repeat, each row gets
its own result; a document without id is trained on; without training texts all words
are unknown and all states alike.  The result has the id and the scores only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from fileload.llm.text import LAST_ID, Words, _BASES, _VALUES, col, emit_texts, keyed, mix64, ragged, range_hash, slices
from fileload.session import conf_scope, stage_table

STATES = 8
OWN, CLASSES = 4096, 1024
KNOWN = 1 << 19
#: Rounds over all training texts, and one more.
ROUNDS = 14
#: Pseudo-counts of the overall distribution in each state's.
SMOOTHING = 50.0
SLICE = 6 << 20
#: Bytes of text hashed at a time: for each there are several arrays of 64-bit numbers.
HASHED = 1 << 17
#: Forward values are scaled after so many steps; a step takes some twenty decimal
#: places at most, and a double has three hundred.
SCALED = 8
#: Symbols of texts that are counted together (or of one longer text): so many, and more
#: where texts are so long that a step would have few of them.
SLICE_SYMBOLS, MOST_SYMBOLS, STEP_TEXTS = 1 << 19, 1 << 21, 2048
#: Symbols whose texts are put in order by length, and partitions that one task reads for that.
ORDERED, TOGETHER = 1 << 24, 4
#: Symbols whose emissions are added up at a time, or a step more.
ADDED = 1 << 13
#: Slices in a stored file: one task of the JVM holds a file's more than once.
FILE_SLICES = 4
#: As all slices that a task reads would be one batch otherwise.
_ROUND_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

_COUNTS = StructType([StructField("h", LongType()), StructField("class", IntegerType()), StructField("c", LongType())])
_STEPS = StructType([StructField("symbols", BinaryType()), StructField("going", BinaryType())])
_PARTS = StructType(
    [
        StructField("id", LongType()),
        StructField("th", LongType()),
        StructField("h", LongType()),
        StructField("kind", IntegerType()),
        StructField("tf", LongType()),
        StructField("n_tokens", LongType()),
        StructField("n_known", LongType()),
        StructField("base", DoubleType()),
        StructField("model", DoubleType()),
    ]
)


def held_out(id_col: str):
    """Rows that are never trained on."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes and their classes."""
    words = Words(texts, lower=True)
    return words, _hashes(words), _classes(words)


def _hashes(words: Words) -> np.ndarray:
    """As ``words.hashes()``, made of some words at a time."""
    made, lo = np.empty(len(words), np.int64), 0
    while lo < len(words):
        first = words.starts[lo]
        hi = max(lo + 1, int(np.searchsorted(words.ends, first + HASHED, "right")))
        starts, ends = words.starts[lo:hi] - first, words.ends[lo:hi] - first
        found = range_hash(_VALUES[0][words.data[first : first + ends[-1]]], starts, ends, _BASES[0])
        made[lo:hi] = found.view(np.int64)
        lo = hi
    return made


def _classes(words: Words) -> np.ndarray:
    """Classes by the hash of at most three last bytes."""
    size = np.minimum(words.ends - words.starts, 3)
    first, values = words.ends - size, _VALUES[1]
    tail = values[words.data[first]]
    for i in (1, 2):
        more = np.flatnonzero(size > i)
        tail[more] += (values * np.uint64(_BASES[1] ** i % 2**64))[words.data[first[more] + i]]
    return (mix64(tail + size.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.int32)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``h, class, c``: words (as hashes) with their class and count."""

    def count(texts):
        _, hashes, classes = _tokens(texts)
        h, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return [pa.array(h), pa.array(classes[first]), pa.array(n)]

    found = emit_texts(docs, text_col, [], _COUNTS, count, SLICE)
    return found.groupBy("h").agg(F.min("class").alias("class"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The bounded part of the counts, and totals of the rest."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray  # of those words; -1 for their class
    class_total: np.ndarray  # count + distinct + 1 of the words of each class without symbol
    shares: np.ndarray  # of all symbols
    n: int
    v: int
    ends: int

    @cached_property
    def buckets(self) -> tuple[np.ndarray, int]:
        """Where the hashes with each value of their first bits begin, and how many
        bits follow those: hashes are spread evenly, so a bucket has one or two."""
        bits = len(self.hashes).bit_length()
        half = 1 << bits - 1
        return np.searchsorted(self.hashes >> 64 - bits, np.arange(-half, half + 1)), 64 - bits

    def look_up(self, hashes: np.ndarray, classes: np.ndarray):
        """Symbol and count of each word; count -1 where it is not known here."""
        if not len(self.hashes):
            return OWN + classes, np.full(len(hashes), -1)
        first, shift = self.buckets
        bucket = (hashes >> shift) + (len(first) >> 1)
        at = first[bucket]
        todo = np.flatnonzero((at < first[bucket + 1]) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] < hashes))
        while len(todo):
            at[todo] += 1
            todo = todo[(at[todo] < first[bucket[todo] + 1]) & (self.hashes[np.minimum(at[todo], len(self.hashes) - 1)] < hashes[todo])]
        at = np.minimum(at, len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        own = np.where(known, self.symbols[at], -1)
        return np.where(own >= 0, own, OWN + classes), np.where(known, self.counts[at], -1)


def vocabulary(counts: DataFrame, ends: int, known: int = KNOWN) -> Vocabulary:
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = sorted(((r["l"], r["n"]) for r in counts.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, room = None, known
    for at, n in levels:  # the rarest words that are still kept
        if n > room:
            break
        least, room = at, room - n
    totals = counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    class_c, class_n = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in totals:
        class_c[r["class"]], class_n[r["class"]] = r["c"], r["n"]
    n, v = int(class_c.sum()) + ends, int(class_n.sum()) + (ends > 0)
    top = counts.where(level >= least if least is not None else F.lit(False)).select("h", "class", "c").toArrow()
    h, cls, c = (top.column(i).to_numpy() for i in range(3))
    order = np.argsort(h)
    h, cls, c = h[order], cls[order], c[order]
    symbols = np.full(len(h), -1, np.int32)
    own = np.lexsort((h, -c))[:OWN]
    symbols[own] = np.arange(len(own))
    np.subtract.at(class_c, cls[own], c[own])
    np.subtract.at(class_n, cls[own], 1)
    shares = np.ones(OWN + CLASSES + 1)
    shares[: len(own)] += c[own]
    shares[len(own) : OWN] = 1e-9
    shares[OWN:-1] += class_c
    shares[-1] += ends
    return Vocabulary(h, c, symbols, class_c + class_n + 1, shares / shares.sum(), n, v, ends)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # state x symbol

    @classmethod
    def random(cls, shares: np.ndarray, states: int = STATES, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        emit = shares * np.exp(rng.normal(0, 0.6, (states, len(shares))))
        stay = 0.95
        move = np.full((states, states), (1 - stay) / max(states - 1, 1))
        np.fill_diagonal(move, stay if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))

    @classmethod
    def from_counts(cls, sums: np.ndarray, shares: np.ndarray, states: int = STATES) -> Model:
        k = states
        start, move, emit = sums[:k] + 1, sums[k : k + k * k].reshape(k, k) + 0.1, sums[k + k * k :].reshape(k, -1)
        emit = emit + SMOOTHING * shares
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


class Sequences:
    """Symbol sequences of many texts, laid out step by step: longest text first, and
    at each step the texts that are still going on.  A step has a row for each of them
    and a column for each state, so that the rows that go on come first and stay in
    one piece; values are scaled every SCALED steps."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.rank_of = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.rank_of]
        starts = (np.cumsum(lengths) - lengths)[self.rank_of]
        within = np.arange(ordered.sum()) - np.repeat(np.cumsum(ordered) - ordered, ordered)
        # Short integers are sorted by counting.
        short = within.astype(np.uint16) if len(ordered) and ordered[0] <= 1 << 16 else within
        by_step = np.argsort(short, kind="stable")
        self.symbols = symbols[(np.repeat(starts, ordered) + within)[by_step]].astype(np.int64)
        self.going = np.bincount(within) if len(within) else np.zeros(0, int)

    @classmethod
    def laid_out(cls, symbols: np.ndarray, going: np.ndarray) -> Sequences:
        """Of symbols that are in order already; ``going`` are the texts at each step."""
        made = cls.__new__(cls)
        made.symbols, made.going = symbols.astype(np.int64), going
        return made

    def _bounds(self) -> list[int]:
        return np.r_[0, np.cumsum(self.going)].tolist()

    def _forward(self, model: Model, values: np.ndarray | None = None):
        """The scales of steps that were scaled; last values and log10 of the scales of
        each text.  ``values`` gets the forward values, a row for each symbol."""
        scales, emit, ones = {}, np.ascontiguousarray(model.emit.T), np.ones(len(model.start))
        bounds = self._bounds()
        texts = bounds[1] if len(bounds) > 1 else 0
        last, logs = np.ones(texts), np.zeros(texts)
        a = np.empty((texts, len(ones)))
        for t, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            if hi - lo < len(a):  # texts that ended a step before
                last[hi - lo : len(a)] = a[hi - lo :] @ ones
                a = a[: hi - lo]
            e = emit.take(self.symbols[lo:hi], axis=0)
            out = None if values is None else values[lo:hi]
            a = np.multiply(model.start if t == 0 else a @ model.move, e, out=out)
            if t % SCALED == SCALED - 1:
                s = a @ ones
                scales[t] = (1 / s)[:, None]
                a *= scales[t]
                logs[: hi - lo] += np.log10(s)
        last[: len(a)] = a @ ones
        return scales, last, logs

    def log10(self, model: Model) -> np.ndarray:
        """log10 of the probability of each text's symbols, in the order given."""
        _, last, logs = self._forward(model)
        found = np.zeros(len(self.rank_of))
        found[self.rank_of[: len(logs)]] = logs + np.log10(last)
        return found

    def counts(self, model: Model, room: np.ndarray | None = None) -> np.ndarray:
        """Expected starts, moves and emissions, flat.  ``room`` has a row for each
        symbol, or more; without it, or if it is too small, there is room for this call."""
        k, s = model.emit.shape
        if room is None or len(room) < len(self.symbols):
            room = np.empty((len(self.symbols), k))
        scales, last, _ = self._forward(model, room)
        bounds, ends = self._bounds(), (1 / last)[:, None]
        emit, turned = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
        moves, emitted, back, upto = np.zeros((k, k)), np.zeros((k, s)), np.empty((0, k)), bounds[-1]
        for t in range(len(bounds) - 2, -1, -1):
            lo, hi = bounds[t : t + 2]
            if hi - lo > len(back):  # texts that end here
                back = np.concatenate([back, np.broadcast_to(ends[len(back) : hi - lo], (hi - lo - len(back), k))])
            room[lo:hi] *= back
            if t:
                ahead = emit.take(self.symbols[lo:hi], axis=0)
                ahead *= back
                if t in scales:
                    ahead *= scales[t]
                before = bounds[t - 1]
                moves += room[before : before + hi - lo].T @ ahead
                back = ahead @ turned
            if upto - lo >= ADDED or t == 0:
                for sums, weights in zip(emitted, np.ascontiguousarray(room[lo:upto].T)):
                    sums += np.bincount(self.symbols[lo:upto], weights=weights, minlength=s)
                upto = lo
        return np.concatenate([room[: len(last)].sum(0), (moves * model.move).ravel(), emitted.ravel()])


def _with_ends(words: Words, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with the end symbol after every text, and their number in each text."""
    lengths = words.counts + 1
    ends = np.cumsum(lengths) - 1
    whole = np.full(lengths.sum(), OWN + CLASSES, np.int64)
    inside = np.ones(len(whole), bool)
    inside[ends] = False
    whole[inside] = symbols
    return whole, lengths


def symbol_table(docs: DataFrame, vocab, text_col: str = "text") -> DataFrame:
    """Symbols of all texts in slices, laid out step by step once for all rounds.  Texts of
    like length are together, since a slice takes as many steps as its longest text has
    words; ``vocab`` is a broadcast Vocabulary."""

    def lay_out(texts):
        flat, lengths = np.concatenate([x for x, _ in texts]), np.concatenate([n for _, n in texts])
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
        bounds, lo = np.r_[0, np.cumsum(lengths)], 0
        while lo < len(lengths):
            most = min(max(SLICE_SYMBOLS, int(lengths[lo]) * STEP_TEXTS), MOST_SYMBOLS)
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, "right")) - 1)
            made = Sequences(flat[ragged(starts[lo:hi], lengths[lo:hi])], lengths[lo:hi])
            raw = made.symbols.astype(np.int16).tobytes(), made.going.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in raw], names=_STEPS.names)
            lo = hi

    # All in one step: with two, each task had two Python processes, which stay.
    def run(batches):
        texts, held = [], 0
        for batch in batches:
            for lo, hi in slices(batch.column(0), SLICE):
                words, hashes, classes = _tokens(batch.column(0).slice(lo, hi - lo))
                whole, lengths = _with_ends(words, vocab.value.look_up(hashes, classes)[0])
                texts.append((whole.astype(np.int16), lengths))
                held += len(whole)
                if held >= ORDERED:
                    yield from lay_out(texts)
                    texts, held = [], 0
        if texts:
            yield from lay_out(texts)

    return docs.select(col(text_col).cast("string")).mapInArrow(run, _STEPS)


def baum_welch(symbols: DataFrame, vocab, model: Model) -> Model:
    """One round over a ``symbol_table``; ``vocab`` is a broadcast Vocabulary."""
    k = len(model.start)
    # A row for the starts, each state's moves and each symbol, with a value for each state.
    schema = StructType([StructField("row", IntegerType()), *(StructField(f"state_{i}", DoubleType()) for i in range(k))])

    def run(batches):
        total, room = None, np.empty((MOST_SYMBOLS, k))
        for batch in batches:
            for row, steps in zip(*batch.columns):
                symbols, going = np.frombuffer(row.as_buffer(), np.int16), np.frombuffer(steps.as_buffer(), np.int32)
                found = Sequences.laid_out(symbols, going).counts(model, room)
                total = found if total is None else total + found
        if total is not None:
            cut = k + k * k
            rows = np.concatenate([total[:cut].reshape(-1, k), total[cut:].reshape(k, -1).T])
            some = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *map(pa.array, rows[some].T)], names=schema.names)

    with conf_scope(symbols.sparkSession, _ROUND_CONF):
        found = symbols.mapInArrow(run, schema).groupBy("row").agg(*(F.sum(c).alias(c) for c in schema.names[1:])).toArrow()
    rows = np.zeros((1 + k + model.emit.shape[1], k))
    rows[found.column(0).to_numpy()] = np.column_stack([found.column(1 + i).to_numpy() for i in range(k)])
    return Model.from_counts(np.concatenate([rows[: 1 + k].ravel(), rows[1 + k :].T.ravel()]), vocab.value.shares, k)


@dataclass
class LanguageModel:
    counts: DataFrame
    vocab: object  # a broadcast Vocabulary
    model: Model

    def score(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col, n_tokens, n_known, train_tokens, base_score, score``: a text's
        words and end, those seen in training, the training tokens, and log10 of the
        text's probability under add-one word counts and under the model."""
        vocab, model = self.vocab, self.model

        def parts(texts, ids, ths):
            v = vocab.value
            words, hashes, classes = _tokens(texts)
            symbols, counts = v.look_up(hashes, classes)
            n, doc = len(texts), words.docs()
            gained = np.log10(np.maximum(counts, 0) + 1.0)
            in_class = symbols >= OWN
            scored = Sequences(*_with_ends(words, symbols)).log10(model)
            scored += np.bincount(doc[in_class], weights=(gained - np.log10(v.class_total[classes]))[in_class], minlength=n)
            base = np.bincount(doc, weights=gained, minlength=n) + math.log10(v.ends + 1)
            tokens = words.counts + 1
            base -= tokens * math.log10(v.n + v.v + 1)
            seen = np.bincount(doc[counts >= 0], minlength=n) + (v.ends > 0)
            # Words that are not known here: one row for each in a text.
            rare = np.flatnonzero(counts < 0)
            order = rare[np.lexsort((hashes[rare], doc[rare]))]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
            first = np.flatnonzero(new)
            tf = np.diff(np.r_[first, len(order)])
            m = len(first)
            owner = pa.array(np.r_[np.arange(n), doc[order[first]]])

            def with_rest(x, rest, kind):
                return pa.array(np.r_[x, np.full(m, rest)].astype(kind))

            id_values = ids.to_numpy(zero_copy_only=False)
            return [
                ids.take(owner),
                ths.take(owner),
                pa.array(np.r_[id_values, hashes[order[first]]]),
                pa.array(np.r_[np.zeros(n), np.ones(m)].astype(np.int32)),
                pa.array(np.r_[np.ones(n), tf].astype(np.int64)),
                with_rest(tokens, 0, np.int64),
                with_rest(seen, 0, np.int64),
                with_rest(base, 0.0, float),
                with_rest(scored, 0.0, float),
            ]

        rows = emit_texts(keyed(docs, id_col, text_col), text_col, ["__id", "__th"], _PARTS, parts, SLICE)
        # Rows of whole texts (kind 0) pass the join on a key of their own.
        counted = rows.join(self.counts.select("h", "c", F.lit(1).alias("kind")), ["h", "kind"], "left")
        more = F.when((F.col("kind") == 1) & F.col("c").isNotNull(), F.col("tf"))
        gain = F.coalesce(more * F.log10(F.col("c") + 1), F.lit(0.0))
        per_doc = counted.groupBy("id", "th").agg(
            F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).alias("m"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.coalesce(more, F.lit(0))).alias("n_known"),
            F.sum(F.col("base") + gain).alias("base"),
            F.sum(F.col("model") + gain).alias("model"),
        )
        m = F.col("m")
        # Equal rows were summed as one; each gets its part back.
        each = per_doc.withColumn("__", F.explode(F.sequence(F.lit(1), m.cast("int"))))
        return each.select(
            F.when(F.col("id") < LAST_ID, F.col("id")).alias(id_col),
            (F.col("n_tokens") / m).cast("long").alias("n_tokens"),
            (F.col("n_known") / m).cast("long").alias("n_known"),
            F.lit(self.vocab.value.n).cast("long").alias("train_tokens"),
            (F.col("base") / m).alias("base_score"),
            (F.col("model") / m).alias("score"),
        )


def train(docs: DataFrame, *, text_col: str = "text", rounds: int = ROUNDS) -> LanguageModel:
    """Learn from all of ``docs``."""
    spark = docs.sparkSession
    counts = stage_table(word_counts(docs, text_col), "counts")
    read = docs.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    ends = sum(r["count"] for r in read)
    vocab = spark.sparkContext.broadcast(vocabulary(counts, ends))
    model = Model.random(vocab.value.shares)
    if ends:
        tasks = max(spark.sparkContext.defaultParallelism, len(read) // TOGETHER)
        symbols = stage_table(symbol_table(docs.coalesce(tasks), vocab, text_col), "symbols", maxRecordsPerFile=FILE_SLICES)
        for _ in range(rounds + 1):
            model = baum_welch(symbols, vocab, model)
    return LanguageModel(counts, vocab, model)
