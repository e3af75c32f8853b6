"""Operators on texts against brute force, SQL and the tokenizer's own library."""

import glob
import os

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import PASSAGE, decontamination, hard_rows, line_dedup, near, sha
from pyspark.sql import functions as F

from fileload.llm import decontam, graph, lines, minhash, pieces, queries
from fileload.llm.graph import components

SF_DIR = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    return hard_rows(spark).cache()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df, *columns) == sorted(map(repr, result.fetchall()))


def test_decontamination_by_brute_force(spark, hard):
    items = [(1, PASSAGE), (12, "ONE two, three"), (2, "one"), (None, "a b"), (3, None), (4, "..."), (5, "one two three four five six")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_hits(hard, bench)
    assert found.columns.count("n_words") == 1
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    got = rows(found, "doc_id", "n_words", n_hit, F.size("hit_items"), F.sha2(F.array_join("hit_items", ","), 256), n_hit > 0)
    assert got == sorted(map(repr, decontamination(pairs(hard), items)))


def test_decontamination_in_blocks(spark, hard, monkeypatch):
    items = [(1, PASSAGE), (2, "one"), (5, "one two three four five six")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows(decontam.find_hits(hard, bench), "doc_id", "hit_spans", "hit_items")
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 20)
    assert rows(decontam.find_hits(hard, bench), "doc_id", "hit_spans", "hit_items") == whole


def test_decontamination_removes(spark, hard):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    clean = decontam.decontaminate(hard, bench)
    assert clean.columns == hard.columns and clean.count() == hard.count()
    assert rows(clean.where("doc_id = 21"), "text") == [repr(("before  after",))]
    assert sorted(r[0] for r in decontam.decontaminate(hard, bench, remove="documents").where("doc_id between 20 and 29").collect()) == []
    nothing = bench.limit(0)
    assert rows(decontam.decontaminate(hard, nothing), "doc_id", "text") == rows(hard, "doc_id", "text")
    assert decontam.find_hits(hard.limit(0), bench).count() == 0


def test_lines_by_brute_force(hard):
    got = lines.line_dedup(hard)
    assert rows(got, "doc_id", "deduped", "n_lines", "n_removed") == sorted(map(repr, line_dedup(pairs(hard))))
    left = lines.remove_lines(hard)
    assert left.columns == hard.columns
    wanted = [(d, t) for d, t, n, r in line_dedup(pairs(hard)) if not (r and r == n)]
    assert rows(left, "doc_id", "text") == sorted(map(repr, wanted))
    assert lines.line_dedup(hard.limit(0)).count() == 0


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_by_brute_force(docs, hard, width):
    for df in (docs, hard):
        got = minhash.near_duplicates(df, width)
        assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(map(repr, near(pairs(df), width)))


def test_near_duplicates_of_a_chain_and_a_crowd(spark):
    """Neighbours in a chain link, its ends do not; a crowd around one text."""
    words = [f"c{i}" for i in range(100)]
    chain = [(100 - k, " ".join([f"r{k}x{i}" if i < 3 * k else w for i, w in enumerate(words)])) for k in range(12)]
    base = [f"b{i}" for i in range(200)]
    crowd = [(200 + k, " ".join([w if i % 40 != k % 40 else f"q{k}" for i, w in enumerate(base)])) for k in range(60)]
    df = spark.createDataFrame(chain + crowd, "doc_id long, text string").repartition(5)
    got = minhash.near_duplicates(df, 4)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(map(repr, near(chain + crowd, 4)))


def test_near_duplicates_of_copies_around_the_threshold(spark):
    """Groups in which some copies link, some only over others and some with nobody."""
    rng = np.random.default_rng(5)
    docs = []
    for group, copies in enumerate((70, 12, 3)):
        base = [f"g{group}w{i}" for i in range(150)]
        for _ in range(copies):
            words = list(base)
            for at in rng.choice(150, rng.integers(0, 7), replace=False):
                words[at] = f"x{rng.integers(10**9)}"
            docs.append((len(docs) * 3, " ".join(words)))
    want = near(docs, 4)
    of = [c for _, _, c, _ in want]
    assert 0 < sum(of.count(c) == 1 for c in of) < len(docs) / 2
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(map(repr, want))


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for size, changed in ((1, 0), (1, 1), (100, 11), (100, 60), (3000, 900)):
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = np.r_[a[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]
        p = minhash.parities(np.r_[a, b], np.array([len(a), 0, len(b)]))
        differ = int(np.bitwise_count(p[0] ^ p[2]).sum())
        assert differ <= len(set(a.tolist()) ^ set(b.tolist())) and not p[1].any()


def test_near_duplicates_of_empty_tables(hard):
    assert minhash.near_duplicates(hard.limit(0)).count() == 0
    assert minhash.near_duplicates(hard.where("doc_id = 2")).count() == 1


def test_keep_one(hard):
    left = minhash.keep_one(hard)
    gone = {d for d, _, _, kept in near(pairs(hard), 5) if not kept}
    assert rows(left, *left.columns) == rows(hard.where(~F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).isin([2**63 - 1 if d is None else d for d in gone])), *hard.columns)


def test_rows_without_or_with_a_shared_id_are_told_apart(spark):
    """Copies go, and no other text under their id; links of every text count."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    made = [(1, a), (None, a), (None, b), (None, c), (5, d), (5, e), (7, e + " more"), (8, d + " more"), (9, a + " more"), (None, None), (None, None)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    left = sorted(map(repr, map(tuple, minhash.keep_one(df).collect())))
    assert left == sorted(map(repr, [(1, a), (None, b), (None, c), (5, d), (5, e), (None, None), (None, None)]))
    got = minhash.near_duplicates(df).groupBy("doc_id", "component_id", "kept").count().collect()
    want = [(1, 1, True, 1), (None, 1, False, 1), (None, None, True, 4), (5, 5, True, 2), (7, 5, False, 1), (8, 5, False, 1), (9, 1, False, 1)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    shared = spark.createDataFrame([(3, a), (3, a + " more"), (None, b), (None, b + " more")], df.schema)
    kept = [r.doc_id for r in minhash.keep_one(shared).collect()]
    assert sorted(map(str, kept)) == ["3", "None"]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for size in (3, 40, 400):
        for _ in range(20):
            a = rng.integers(0, 2**63, size, np.uint64)
            b = np.r_[a[: size * 2 // 3], rng.integers(0, 2**63, size - size * 2 // 3, np.uint64)]
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = minhash.superminhash(np.r_[a, b], np.array([size, size]))
            errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


@pytest.mark.parametrize("task_edges", [500_000, 50])
def test_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr(graph, "TASK_EDGES", task_edges)
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long").repartition(6)
    assert {tuple(r) for r in components(df).collect()} == {(x, find(x)) for x in parent if find(x) != x}


def test_pieces_match_the_library(docs, hard):
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    extra = ["x" * 5000, "the" * 400, " " * 77 + "q", "́é ﬁ　", "�", " ", "a▁b", "▁"]
    more = docs.sparkSession.createDataFrame([(900 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    texts = docs.select("doc_id", "text").union(hard.select("doc_id", "text")).union(more)
    got = queries.pieces_digest(pieces.encode_decode(texts, queries.MODEL))
    wanted = []
    for d, t in pairs(texts):
        ids = sp.encode(t or "")
        wanted.append((d, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(map(repr, wanted))


def test_pieces_keep_other_columns(hard):
    coded = pieces.encode(hard, queries.MODEL)
    assert sorted(coded.columns) == sorted(["doc_id", "text", "n_words", "ids", "Line"])
    decoded = pieces.decode(coded, queries.MODEL)
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), "▁", " ")
    assert decoded.where(F.col("decoded") != plain).count() == 0
    assert pieces.encode(hard.limit(0), queries.MODEL).count() == 0


def test_decode_of_any_ids():
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    model = pieces.model(queries.MODEL)
    rng = np.random.default_rng(1)
    for _ in range(300):
        ids = rng.integers(0, 700, rng.integers(0, 12)).astype(np.int32)
        assert model.decode(ids, np.array([len(ids)]))[0].as_py() == sp.decode(ids.tolist())
