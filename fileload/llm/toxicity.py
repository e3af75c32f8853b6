"""Toxicity: gradient-boosted trees over dense text features, isotonic calibration.

Features are rates in a whole text: words of a lexicon, the same close to a word of
the second person or after undoing letter substitutions, capitals, punctuation and
obfuscated spellings.  The lexicon holds the words and word stems (as hashes) that
labelled training rows show to be toxic.  Lexicon and trees are fitted on one part of
a bounded sample of labelled rows, the calibration on the other part.

Cases: null and empty texts have rates of zero and get a score like any other; null
labels and labels of no document are left out; a document labelled twice counts
twice; with labels of one kind only the score is their share, without labels 0; a
document without id is never held out; input columns named like a result column are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from fileload.llm.text import ALNUM, Words, _BASES, _VALUES, col, emit_texts, lists, map_texts, range_hash, text_bytes, without
from fileload.session import stage_table

#: Labelled rows that are fitted on, the first in the order of their ids' hashes.
SAMPLE = 20_000
#: Lexicon entries at most, and documents one must be in.
LEXICON, LEAST = 512, 4
STEMS = (4, 5, 6)  # letters
NEAR = 4  # words

#: Words of the second person in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself yourselves u ur ya du dich dir dein deine deiner euch euer ihr "
    "tu te toi ton tes vous votre vos tú ti tuyo usted ustedes vosotros os"
).split()
#: Letters and what is written in their place.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

NAMES = (
    "lexicon lexicon_weight lexicon_most lexicon_count near_person person undone_lexicon "
    "capitals capital_words exclamations questions punctuation obfuscated digits symbols word_length log_words"
).split()

_TERMS = StructType([StructField("term", LongType()), StructField("toxic", LongType()), StructField("clean", LongType())])
_FEATURES = StructType([StructField("__features", ArrayType(DoubleType()))])

_PLAIN = np.arange(256, dtype=np.uint8)
_UNDONE = ALNUM.copy()
for _a, _b in SUBSTITUTES.items():
    _PLAIN[ord(_a)] = ord(_b)
    _UNDONE[ord(_a)] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SUBSTITUTE = np.zeros(256, bool)
_SUBSTITUTE[[ord(x) for x in [*SUBSTITUTES, "*", "#", "%"]]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(x) for x in ".,;:!?\"'()-"]] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(x) for x in "#*$%&|<>@^~_=+/\\"]] = True


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word and of its stems; the word each belongs to."""
    values = _VALUES[0][words.data]
    char = (words.data & 0xC0) != 0x80
    chars = np.flatnonzero(char)
    before = np.r_[0, np.cumsum(char)]
    first, last = before[words.starts], before[words.ends]
    keys, owner = [range_hash(values, words.starts, words.ends, _BASES[0])], [np.arange(len(words))]
    for size in STEMS:
        longer = np.flatnonzero(last - first > size)
        ends = chars[first[longer] + size]
        keys.append(range_hash(values, words.starts[longer], ends, _BASES[0]))
        owner.append(longer)
    return np.concatenate(keys).astype(np.int64), np.concatenate(owner)


def _word_hashes(words: list[str]) -> np.ndarray:
    one = Words(pa.array([" ".join(words)]), ALNUM, lower=True)
    return np.sort(one.hashes().astype(np.int64))


def _among(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, at


@dataclass
class Lexicon:
    """Sorted term hashes and their log odds."""

    terms: np.ndarray
    weights: np.ndarray

    def of(self, words: Words) -> np.ndarray:
        """The largest weight of a word's terms, 0 without one."""
        keys, owner = _terms(words)
        known, at = _among(keys, self.terms)
        found = np.zeros(len(words))
        np.maximum.at(found, owner[known], self.weights[at[known]])
        return found


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms whose share of toxic documents is surely higher than of clean ones.
    ``sample`` has ``text`` and ``toxic``; only counts of terms are shuffled."""

    def count(texts, toxic):
        words = Words(texts, ALNUM, lower=True)
        keys, owner = _terms(words)
        doc = words.docs()[owner] if len(words) else owner
        order = np.lexsort((keys, doc))
        keys, doc = keys[order], doc[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        is_toxic = toxic.to_numpy(zero_copy_only=False)[doc[new]] == 1
        terms, kind = np.unique(keys[new], return_inverse=True)
        hits = np.bincount(kind, weights=is_toxic, minlength=len(terms)).astype(np.int64)
        return [pa.array(terms), pa.array(hits), pa.array(np.bincount(kind, minlength=len(terms)) - hits)]

    toxic, rows = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    counts = emit_texts(sample, "text", ["toxic"], _TERMS, count).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    low = (F.greatest(F.col("t") - 1.5 * F.sqrt("t"), F.lit(0)) + 0.5) / (toxic + 1)
    high = (F.col("c") + 1.5 * F.sqrt("c") + 1) / (rows - toxic + 1)
    best = counts.where(F.col("t") >= LEAST).withColumn("w", F.log(low / high)).where("w > 1.5").orderBy(F.desc("w"), "term").limit(LEXICON)
    found = sorted((r["term"], r["w"]) for r in best.select("term", "w").collect())
    return Lexicon(np.array([t for t, _ in found], np.int64), np.array([w for _, w in found], float))


def features(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``__features``, the values of NAMES."""
    person = _word_hashes(SECOND_PERSON)

    def run(texts):
        words = Words(texts, ALNUM, lower=True)
        n = len(texts)
        doc = words.docs()
        weight = lexicon.of(words)
        hit = weight > 0
        you, _ = _among(words.hashes().astype(np.int64), person)
        # Second-person words close by, in the same text.
        seen = np.r_[0, np.cumsum(you)]
        here = np.arange(len(words))
        near = seen[np.minimum(here + NEAR + 1, words.first[1:][doc])] > seen[np.maximum(here - NEAR, words.first[:-1][doc])]
        offsets, raw = text_bytes(texts)
        plain = Words(pa.StringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_PLAIN[raw])), ALNUM, lower=True)
        undone = np.bincount(plain.docs()[lexicon.of(plain) > 0], minlength=n)

        def total(mask):
            sums = np.r_[0, np.cumsum(mask)]
            return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

        def per_doc(mask):
            return np.bincount(doc[mask], minlength=n).astype(float)

        inner = np.zeros(len(raw), bool)
        if len(raw) > 2:
            inner[1:-1] = _SUBSTITUTE[raw[1:-1]] & _LETTER[raw[:-2]] & _LETTER[raw[2:]]
        shout = np.zeros(len(words), bool)
        upper = np.r_[0, np.cumsum(_UPPER[raw])]
        shout[:] = (upper[words.ends] - upper[words.starts] == words.ends - words.starts) & (words.ends - words.starts > 2)
        n_words = np.maximum(words.counts, 1)
        letters, size = np.maximum(total(_LETTER[raw]), 1), np.maximum(np.diff(offsets), 1)
        most = np.zeros(n)
        np.maximum.at(most, doc, weight)
        hits = per_doc(hit)
        table = np.column_stack(
            [
                hits / n_words,
                np.bincount(doc, weights=weight, minlength=n) / n_words,
                most,
                np.log1p(hits),
                per_doc(hit & near) / n_words,
                per_doc(you) / n_words,
                np.maximum(undone - hits, 0) / n_words,
                total(_UPPER[raw]) / letters,
                per_doc(shout) / n_words,
                total(raw == ord("!")) / n_words,
                total(raw == ord("?")) / n_words,
                total(_MARKS[raw]) / size,
                total(inner) / n_words,
                total((raw >= 0x30) & (raw < 0x3A)) / size,
                total(_SYMBOLS[raw]) / size,
                letters / n_words,
                np.log1p(words.counts),
            ]
        )
        return [lists(pa.array(table.ravel()), np.full(n, len(NAMES)))]

    return map_texts(docs, text_col, _FEATURES, run, keep_text=keep_text)


def held_out(id_col: str):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def _margin(self, docs: DataFrame, text_col: str, keep_text: bool) -> DataFrame:
        known = features(docs, self.lexicon, text_col, keep_text).withColumn("__features", array_to_vector("__features"))
        return self.trees.transform(known).withColumn("__margin", vector_to_array("__raw")[1]).drop("__features", "__raw", "__p", "__class")

    def score(self, docs: DataFrame, *, text_col: str = "text", keep_text: bool = True) -> DataFrame:
        """``docs`` (without the text, on request) with ``score``, the calibrated share of toxic texts at the trees'
        margin (a thousandth of it the margin's own, to part equal ones), and
        ``predicted``, whether it is one half or more."""
        if self.trees is None:
            found = (docs if keep_text else docs.drop(text_col)).withColumn("score", F.lit(self.share))
        else:
            rows = docs.select(*(col(c) for c in without(docs.columns, ["score", "predicted"])))
            found = self.calibration.transform(self._margin(rows, text_col, keep_text))
            own = 1 / (1 + F.exp(-2 * F.col("__margin")))
            found = found.withColumn("score", 0.999 * F.col("__share") + 0.001 * own).drop("__share", "__margin")
        return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Learn from the labelled rows of ``docs`` that are not held out, at most ``sample``."""
    known = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull() & ~held_out(id_col))
    known = known.select(col(id_col).alias("id"), (col(label_col) > 0).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id", "toxic").limit(sample)
    # At most `sample` small rows are broadcast.
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id")
    rows = stage_table(rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5))), "labelled")
    first, second = rows.where("part < 3"), rows.where("part >= 3")
    kinds = {(r["early"], r["toxic"]): r["n"] for r in rows.groupBy((F.col("part") < 3).alias("early"), "toxic").agg(F.count("*").alias("n")).collect()}
    if min(kinds.get((True, 0), 0), kinds.get((True, 1), 0)) == 0:
        total = sum(kinds.values())
        share = sum(n for (_, toxic), n in kinds.items() if toxic) / total if total else 0.0
        return ToxicityModel(Lexicon(np.empty(0, np.int64), np.empty(0)), None, None, share)
    if min(kinds.get((False, 0), 0), kinds.get((False, 1), 0)) == 0:
        second = rows
    lexicon = learn_lexicon(first)
    table = stage_table(features(rows, lexicon).drop("text"), "features").withColumn("__features", array_to_vector("__features"))
    learner = GBTClassifier(
        featuresCol="__features", labelCol="toxic", predictionCol="__class",
        maxDepth=3, maxIter=20, stepSize=0.2, maxBins=32, minInstancesPerNode=3, seed=11,
    )
    trees = learner.setRawPredictionCol("__raw").setProbabilityCol("__p").fit(table.where("part < 3"))
    model = ToxicityModel(lexicon, trees, None, 0.0)
    margins = trees.transform(table.where("part >= 3") if second is not rows else table).select(
        vector_to_array("__raw")[1].alias("__margin"), F.col("toxic").cast("double").alias("toxic")
    )
    model.calibration = IsotonicRegression(featuresCol="__margin", labelCol="toxic", predictionCol="__share").fit(margins)
    return model


def remove_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, in their own columns, without those predicted to be toxic."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    # The text goes to the workers twice: in its row, and to be looked at.
    rows = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("row"), col(text_col).cast("string").alias("__text"))
    found = model.score(rows, text_col="__text", keep_text=False).where("predicted = 0")
    return found.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
