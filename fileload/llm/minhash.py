"""Near-duplicate documents by SuperMinHash, banding, exact checks and union-find.

A document's set is its distinct word shingles, each a 64-bit hash.  SuperMinHash
gives every element a random permutation of the signature's slots: on level j it
offers j + r to the j-th slot.  All elements of a text take a level together, and
the text stops once every slot is filled, since later levels offer only more.

Documents with equal sets form a class first (128-bit fingerprints of whole sets).
Classes that share a band meet in a bucket; pairs are checked on full sets.  A random
sample of nodes, larger in each round, is compared with all members of other components
in its buckets, and the links found merge components: most near copies of one text are
one component after a few comparisons each.  The last round compares every member that
is outside of the largest component of its bucket with all members of other components,
so every pair of a bucket that is not connected by then is compared.  Each class
carries the parities of its hashes in 512 cells: two sets differ in at least as many
elements as in parities, which rules out most pairs inside the join, without a mistake.

Cases: a null or empty text has an empty set and links with nothing; fewer words than
a shingle are one shingle; a null id counts as larger than all, and its component is
null if nothing smaller is linked; rows that share an id, or have none, are told apart
by their texts, and only rows equal in both are one document; input columns named like
a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from fileload.llm.graph import components
from fileload.llm.text import LAST_ID, Words, col, keyed, lists, map_texts, mix64, without
from fileload.session import stage_dir, stage_scope, stage_table

#: At a similarity of 0.8 a pair misses all bands with a chance of (1 - 0.8**4)**24, 3e-6.
BANDS, ROWS = 24, 4
SLOTS = BANDS * ROWS
#: 64-bit words of parities.
CELLS = 8
#: Centres wanted in the largest bucket in the first round, and their growth by round.
CENTRES, GROWTH = 2, 8

SIGNATURE = StructType(
    [
        StructField("n_shingles", LongType()),
        StructField("s1", LongType()),
        StructField("s2", LongType()),
        StructField("bands", ArrayType(LongType())),
        *(StructField(f"p{i}", LongType()) for i in range(CELLS)),
    ]
)
_U = np.uint64


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and their numbers."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    at, keys = words.windows(hashes, width)
    doc = np.searchsorted(words.first, at, "right") - 1
    for n in np.unique(words.counts[(words.counts > 0) & (words.counts < width)]).tolist():
        few, short = words.windows(hashes, n)
        of = np.searchsorted(words.first, few, "right") - 1
        fits = words.counts[of] == n
        doc, keys = np.r_[doc, of[fits]], np.r_[keys, short[fits]]
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])
    return keys[new], np.bincount(doc[new], minlength=len(texts))


def superminhash(keys: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of sets given flat; a row of (level, rank) values for each set."""
    n = len(counts)
    empty = _U(2**64 - 1)
    signature = np.full(n * slots, empty, np.uint64)
    owner = np.repeat(np.arange(n), counts)
    order: np.ndarray | None = None
    for level in range(slots):
        draw = mix64(keys + _U((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        swap = level + ((draw >> _U(33)) % _U(slots - level)).astype(np.int64)
        value = (_U(level) << _U(32)) | (draw & _U(0xFFFFFFFF))
        if order is None:
            slot = swap
        else:
            row = np.arange(len(keys))
            slot = order[row, swap].astype(np.int64)
            order[row, swap] = order[:, level]
        np.minimum.at(signature, owner * slots + slot, value)
        open_sets = (signature.reshape(n, slots) == empty).any(axis=1)
        more = open_sets[owner]
        if not more.any():
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8), (int(more.sum()), 1))
            order[np.arange(len(order)), swap[more]] = 0
        else:
            order = order[more]
        keys, owner = keys[more], owner[more]
    return signature.reshape(n, slots)


def parities(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each set, given flat, whether the number of hashes in a cell is odd: a row
    of ``CELLS`` words of 64 cells."""
    words = np.zeros(len(counts) * CELLS, np.uint64)
    cell = mix64(keys ^ _U(0xA24BAED4963EE407)) % _U(64 * CELLS)
    at = np.repeat(np.arange(len(counts)), counts) * CELLS + (cell >> _U(6)).astype(np.int64)
    np.bitwise_xor.at(words, at, _U(1) << (cell & _U(63)))
    return words.reshape(-1, CELLS)


def signatures(docs: DataFrame, width: int, text_col: str) -> DataFrame:
    """``docs`` with the size, fingerprint and parities of each set and its band keys."""

    def run(texts):
        keys, counts = shingle_sets(texts, width)
        ends = np.r_[0, np.cumsum(counts)]
        sums = []
        for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0676A9A99):
            total = np.zeros(len(keys) + 1, np.uint64)
            np.cumsum(mix64(keys ^ _U(salt)), out=total[1:])
            sums.append(mix64(total[ends[1:]] - total[ends[:-1]]).astype(np.int64))
        some = counts > 0
        marks = superminhash(keys, counts[some]).reshape(-1, BANDS, ROWS)
        bands = np.zeros(marks.shape[:2], np.uint64)
        for r in range(ROWS):
            bands = mix64(bands * _U(0xD6E8FEB86659FD93) + marks[:, :, r])
        bands = mix64(bands + np.arange(BANDS, dtype=np.uint64))
        return [
            pa.array(counts.astype(np.int64)),
            pa.array(sums[0]),
            pa.array(sums[1]),
            lists(pa.array(bands.astype(np.int64).ravel()), some * BANDS),
            *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in parities(keys, counts).T),
        ]

    return map_texts(docs, text_col, SIGNATURE, run, slice_bytes=1 << 20, keep_text=False)


def _similar(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """``pairs`` (text_a, text_b) with ``linked``: whether the full sets are similar."""

    def run(left, right):
        both = pa.concat_arrays([left, right])
        keys, counts = shingle_sets(both, width)
        n = len(left)
        pair = np.repeat(np.arange(2 * n) % max(n, 1), counts)
        order = np.lexsort((keys, pair))
        k, p = keys[order], pair[order]
        same = (k[1:] == k[:-1]) & (p[1:] == p[:-1])
        common = np.bincount(p[1:][same], minlength=n)
        union = counts[:n] + counts[n:] - common
        return [pa.array(100 * common >= percent * union)]

    return map_texts(pairs, "text_a", StructType([StructField("linked", BooleanType())]), run, ("text_b",), slice_bytes=1 << 20)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The columns of ``docs`` but its text, with ``n_shingles``, ``component_id`` (the
    smallest id reachable over links) and ``kept`` (whether that is the row's own; of
    texts with that id, one is).

    Two documents link if their shingle sets share at least ``percent`` of their union.
    """
    result = _labelled(docs, width, percent, id_col, text_col)
    root = F.col("__root.__id")
    component = F.when(root < LAST_ID, root).cast(docs.schema[id_col].dataType)
    keep = without([c for c in docs.columns if c != text_col], ["n_shingles", "component_id", "kept"])
    return result.select(*(col(c) for c in keep), "n_shingles", component.alias("component_id"), _is_root().alias("kept"))


def _is_root():
    return F.col("__root") == F.struct("__id", "__th")


def _labelled(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the text, with ``n_shingles``, ``__id``, ``__th`` and ``__root``,
    the smallest (``__id``, ``__th``) of the component."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    signed = stage_table(signatures(rows, width, text_col), "signatures")
    found = signed.where("n_shingles > 0")
    # Numbered once written: an id may stand for several classes.
    classes = found.groupBy("s1", "s2").agg(F.min(F.struct("__id", "__th")).alias("first"))
    classes = stage_table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # What is made on the way goes once the components are written.
    path = stage_dir(spark, "components")
    with stage_scope(spark):
        linked = _linked(docs, found, classes, width, percent, id_col, text_col)
        linked.write.mode("overwrite").parquet(path)
    linked = spark.read.schema("node long, comp long").parquet(path)

    # Nodes are mere numbers; a component goes by the smallest row in it.
    nodes = linked.union(linked.select("comp", "comp").distinct())
    nodes = stage_table(nodes.join(classes.select("node", "first"), "node"), "nodes")
    named = nodes.join(nodes.groupBy("comp").agg(F.min("first").alias("least")), "comp").select("node", "least")
    classes = classes.join(named, "node", "left").select("s1", "s2", F.coalesce("least", "first").alias("root"))
    result = signed.drop("bands", *_PARITIES).join(classes, ["s1", "s2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.struct("__id", "__th"))
    return result.withColumn("__root", own)


_PARITIES = [f"p{i}" for i in range(CELLS)]


def _linked(docs: DataFrame, found: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``node, comp`` of all nodes that are not the smallest of their component."""
    # All rows of a class have the same bands: its smallest row carries them.
    firsts = classes.select("s1", "s2", F.col("first.__id").alias("__id"), F.col("first.__th").alias("__th"), "node")
    each = found.join(firsts, ["s1", "s2", "__id", "__th"]).dropDuplicates(["node"])
    each = stage_table(each.select("node", "__id", "__th", F.col("n_shingles").alias("n"), *_PARITIES, "bands"), "each")
    banded = each.select("node", F.explode("bands").alias("bucket"))
    shared = stage_table(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    largest = shared.agg(F.max("size")).first()[0]
    if largest is None:
        return docs.sparkSession.createDataFrame([], "node long, comp long")
    # A node keeps its shared buckets, at most one a band, in one row.
    met = banded.join(shared, "bucket", "left_semi").groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    turn = (F.pmod(F.xxhash64("node"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("turn")
    nodes = stage_table(each.drop("bands").join(met, "node").withColumns({"turn": turn}), "members")
    # Texts come back for members of shared buckets only.
    plain = keyed(docs.select(col(id_col), col(text_col).cast("string").alias("__text")), id_col, "__text")
    texts = plain.select("__id", "__th", "__text").join(nodes.select("__id", "__th", "node"), ["__id", "__th"])
    texts = stage_table(texts.groupBy("node").agg(F.min("__text").alias("text")), "texts")
    nodes = nodes.drop("__id", "__th")

    linked = docs.sparkSession.createDataFrame([], "node long, comp long")
    low, high = 0.0, CENTRES / largest
    while True:
        last = high > 0.6
        placed = nodes.join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        placed = stage_table(placed, "placed")
        members = placed.withColumn("bucket", F.explode("buckets")).drop("buckets", "turn")
        if last:
            weighed = placed.join(placed.groupBy("comp").agg(F.count("*").alias("weight")), "comp")
            weighed = weighed.select("comp", "weight", F.explode("buckets").alias("bucket"))
            main = weighed.groupBy("bucket").agg(F.max_by("comp", "weight").alias("main"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            # Where all are one component nothing is left to find.
            main = stage_table(main.where("lo < hi").select(F.col("bucket").alias("of"), "main"), "main")
            centres = members.join(main, (F.col("bucket") == F.col("of")) & (F.col("comp") != F.col("main")))
        else:
            centres = placed.where((F.col("turn") >= low) & (F.col("turn") < high))
            centres = centres.withColumn("bucket", F.explode("buckets")).withColumn("main", F.lit(-1).cast("long"))
        centres = centres.select("main", *(F.col(c).alias(f"c_{c}") for c in ("bucket", "node", "comp", "n", *_PARITIES)))
        # Written, so that Spark knows its size before it picks the kind of join.
        centres = stage_table(centres, "centres")
        pairs = members.join(centres, (F.col("bucket") == F.col("c_bucket")) & _possible(percent))
        pairs = pairs.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()
        pairs = stage_table(pairs, "pairs")
        with_texts = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
        )
        links = stage_table(_similar(with_texts, width, percent).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        if not links.isEmpty():
            edges = links.union(linked.select(F.col("node").alias("u"), F.col("comp").alias("v")))
            linked = components(edges).withColumnRenamed("component", "comp")
        if last:
            return linked
        low, high = high, high * GROWTH


def _possible(percent: int):
    """Whether a member and a centre of its bucket are of two components and may link,
    by their sizes and parities; of two that are both outside of the main component,
    and so both centres, the larger node meets the smaller."""
    differ = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"c_{p}"))) for p in _PARITIES[1:]), F.bit_count(F.col("p0").bitwiseXOR(F.col("c_p0"))))
    differ = F.greatest(differ.cast("long"), F.abs(F.col("n") - F.col("c_n")))
    near = (100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("c_n"))
    once = (F.col("main") < 0) | (F.col("comp") == F.col("main")) | (F.col("node") < F.col("c_node"))
    return (F.col("comp") != F.col("c_comp")) & once & near


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, in their own columns, without near-duplicates: the document with the
    smallest id of each component stays; where texts share that id, one of them."""
    found = _labelled(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), width, percent, "id", "text")
    gone = found.where(~_is_root()).select("__id", "__th").distinct()
    return keyed(docs, id_col, text_col).join(gone, ["__id", "__th"], "left_anti").select(*(col(c) for c in docs.columns))
