"""What the tasks of operators hold at a time."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from fileload.llm import align, hmm


def test_words_are_hashed_some_at_a_time(monkeypatch):
    texts = pa.array(["Ab cde  f\n" * 100_000, None, "", "x" * 300_000 + " y é zz"])
    words = hmm.Words(texts, lower=True)
    tracemalloc.start()
    _, hashes, classes = hmm._tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * words.data.size
    assert np.array_equal(hashes, words.hashes().astype(np.int64))
    tails = hmm.range_hash(hmm._VALUES[1][words.data], np.maximum(words.ends - 3, words.starts), words.ends, hmm._BASES[1])
    assert np.array_equal(classes, (tails % np.uint64(hmm.CLASSES)).astype(np.int32))


def test_symbols_are_made_in_one_python_process_of_a_task(spark, capsys):
    docs = spark.createDataFrame([(1, "a b c"), (2, "c d"), (3, None), (4, "a a b")], "doc_id long, text string")
    counts = hmm.word_counts(docs)
    vocab = spark.sparkContext.broadcast(hmm.vocabulary(counts, 4))
    table = hmm.symbol_table(docs.coalesce(1), vocab)
    table.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    (row,) = table.collect()
    assert np.frombuffer(row.going, np.int32).tolist() == [4, 3, 3, 2]
    # The longest text is first at each step, and its end is the last symbol.
    assert np.frombuffer(row.symbols, np.int16)[-1] == hmm.OWN + hmm.CLASSES


def test_words_are_found_where_sorting_has_them():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(-(2**63), 2**63 - 1, 1000))
    vocab = hmm.Vocabulary(hashes, np.arange(len(hashes)), np.full(len(hashes), -1), None, None, 1, 1, 1)
    asked = np.r_[hashes, hashes[:50] + 1, -(2**63), 2**63 - 1]
    counts = vocab.look_up(asked, np.zeros(len(asked), np.int32))[1]
    place = {h: i for i, h in enumerate(hashes.tolist())}
    assert counts.tolist() == [place.get(h, -1) for h in asked.tolist()]


def test_a_chunk_is_written_in_parts():
    pair = align._tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = pa.array(["ab cd " * 60_000, "x▁y", None, "cd other " * 40_000, "ab"])
    rows = list(align._chunk(align._Store(pair), pa.array([1, 2, 3, 4, 5]), texts))
    names = align._chunk_fields(align.StructField("id", align.LongType())).names
    parts = [dict(zip(names, (x[0].as_py() for x in row))) for row in rows]
    assert [p["ids"] for p in parts] == [[1, 2, 3], [4, 5]] and len({p["chunk"] for p in parts}) == 1
    # The first has the pairs of both, in how many documents each is.
    assert parts[0]["pairs"] and parts[1]["pairs"] == parts[1]["held"] == []
    assert max(parts[0]["held"]) == 2 and max(max(p["links"]) for p in parts) == len(parts[0]["pairs"]) - 1
    # Each part has its own units, and all of a document's links.
    for p in parts:
        sizes = np.array(p["unit_links"])[p["units"]]
        assert max(p["units"]) == len(p["unit_links"]) - 1 and sum(p["unit_links"]) == len(p["links"])
        ends = np.cumsum(p["n_units"])
        assert [int(sizes[e - n : e].sum()) for n, e in zip(p["n_units"], ends)] == p["n_links"]
    assert parts[0]["n_links"][1:] == [0, 0] and parts[0]["digests"][1:] == ["", ""]
