"""Whitening, alignment and extraction against brute force, and their odd cases."""

import html
import math
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from brute_align import rows as aligned_rows
from brute_align import tokenize

from fileload.llm import align, extract, queries, whiten

SF_DIR = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

ODD = [
    None,
    "",
    " ",
    "  ",
    "a",
    "a ",
    " a",
    "a  b   c",
    "a  b   c  d",
    "tab\t x\n y \n\n z\r\n",
    "▁ stands for a blank",
    "x▁y z",
    "café été naïve 你好 世界 \U0001f600\U0001f600 é",
    "don't we've 'twas they'll 's '’s",
    "<|endoftext|> </s> <s> <unk> <0x41> [INST]",
    "1234 56789 3.14 $$$ &&& !!!",
    "\x00 nul \x07 bell",
    "word " * 500,
    "x" * 5000,
    "你好" * 800,
    "same text here",
    "same text here",
]


def spark_rows(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", 4000)
    monkeypatch.setattr(align, "PART", 1500)
    monkeypatch.setattr(align, "MEMORY", 40)
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(3)
    got = spark_rows(align.score_links(docs, A, B, 32000))
    assert [got[i] for i in range(len(ODD))] == aligned_rows(ODD)


def test_alignment_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = spark_rows(queries.op12_alignment(spark, SF_DIR))
    assert [got[r["doc_id"]] for r in docs] == aligned_rows([r["text"] for r in docs])


def test_aligned_groups_are_spelled_alike(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, a_ids string")
    got = sorted(align.align_tokens(docs, A, B).collect(), key=lambda r: r["doc_id"])
    for row, (one, two) in zip(got, tokenize(ODD)):
        assert (row["a_ids"], row["b_ids"]) == ([i for i, _ in one], [i for i, _ in two])
        begin_a = begin_b = 0
        for end_a, end_b in zip(row["a_ends"], row["b_ends"]):
            spelled = b"".join(t for _, t in one[begin_a:end_a])
            assert spelled == b"".join(t for _, t in two[begin_b:end_b]) and spelled
            begin_a, begin_b = end_a, end_b
        assert (begin_a, begin_b) == (len(one), len(two))


def test_alignment_of_no_rows_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.score_links(empty, A, B, 32000).collect() == []
    again = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    got = [tuple(r) for r in align.score_links(again, A, B, 32000).collect()]
    assert sorted(got, key=str) == sorted([(i, *r) for i, r in zip((None, None, 1), aligned_rows(["a b", "a b", None]))], key=str)


@pytest.fixture
def given(monkeypatch):
    """The texts that the tokenizers get."""
    texts, encode = [], align._Pair.encode
    monkeypatch.setattr(align._Pair, "encode", lambda self, some: texts.extend(some) or encode(self, some))
    return texts


def test_new_units_are_encoded_many_in_a_text(given):
    store = align._Store(align._tokenizers(A, B))
    codes = store.codes(align._units(pa.array([" ".join(f"w{i}" for i in range(640)), "w7 w8"]))[0])
    assert codes.tolist() == [*range(640), 7, 8]
    assert len(given) == 10


def test_units_in_one_text_are_encoded_as_alone():
    pair = align._tokenizers(A, B)
    odd = ["a", "", "é", "\u00a0", "x\u00a0", "\u00a0 y", "b  ", "\n", "▁", "x▁y", "你好", "'s", "’s", "<|endoftext|>", "</s>", "\x00", "12", "c"]
    units = [f" {x}".encode() for _ in range(9) for x in odd] + [b" \xff", b" bad\xe4", b" good"]
    together, alone = pair.encode_units(units), [pair.encode_units([u]) for u in units]
    for values, parts in zip(together, zip(*alone)):
        assert values.tolist() == np.concatenate(parts).tolist()
    assert together[0].sum() == len(units) - 9 * 2 - 2


def test_frequent_units_are_remembered(given, monkeypatch):
    monkeypatch.setattr(align, "MEMORY", 40)
    pair = align._tokenizers(A, B)
    store = align._Store(pair)
    store.codes(align._units(pa.array(["often, x▁y unusual often, x▁y " + " ".join(f"w{i}" for i in range(60))]))[0])
    assert store.full()
    store.forget()
    del given[:]
    units = align._units(pa.array(["new x▁y often,"]))[0]
    codes = store.codes(units)
    assert given == [" new"] and not store.full()
    fresh = align._Store(pair)
    back = fresh.codes(units)

    def known(s, code):
        def of(values, n):
            end = int(n[: code + 1].sum())
            return values[end - int(n[code]) : end].tolist()

        pairs = list(s.pair_of)
        links = [pairs[i] for i in of(s.links, s.n_links)]
        return s.digest[code], bool(s.sound[code]), of(s.a_ids, s.n_a), of(s.b_ids, s.n_b), of(s.a_ends, s.n_groups), of(s.b_ends, s.n_groups), links

    assert [known(store, c) for c in codes.tolist()] == [known(fresh, c) for c in back.tolist()]


@pytest.mark.parametrize("seed", range(5))
def test_common_cuts(seed):
    rng = np.random.default_rng(seed)
    docs = [np.unique(rng.integers(1, 400, size)) for size in (3, 50, 200, 380)]
    a, b, first, stop, base = [], [], [], [], 0
    for ends in docs:
        keep_a, keep_b = rng.random(len(ends)) < 0.7, rng.random(len(ends)) < 0.5
        keep_a[-1] = keep_b[-1] = True
        first.append(sum(map(len, a)))
        a.append(ends[keep_a] + base)
        b.append(ends[keep_b] + base)
        stop.append(first[-1] + len(a[-1]))
        base += int(ends[-1])
    a, b = np.concatenate(a), np.concatenate(b)
    got = align.common_cuts(a, b, np.array(first), np.array(stop))
    assert got.tolist() == np.flatnonzero(np.isin(a, b)).tolist()


# Whitening


def brute_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    return ((n * x - total) ** 2).sum(1), centred @ turned / np.sqrt(values), values / (centred**2).sum() * n


def check_whitening(got, ids, vectors, components):
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) == len(ids) * components
    deviation, whitened, explained = brute_whitening(vectors, components)
    z = np.array([[by[i, c]["whitened"] for c in range(1, components + 1)] for i in ids])
    assert np.abs(z * np.sign((z * whitened).sum(0)) - whitened).max() < 1e-9
    assert [by[i, 1]["deviation"] for i in ids] == deviation.tolist()
    assert np.allclose([by[ids[0], c]["explained"] for c in range(1, components + 1)], explained, rtol=1e-10)
    assert {r["n"] for r in got} == {len(ids)} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9


def test_whitening_of_a_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    got = queries.op11_whitening(spark, SF_DIR).collect()
    check_whitening(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 32)


def test_whitening_leaves_unusable_vectors_out(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((40, 6)).tolist()
    bad = [None, [], [None] * 6, [1.0, None, 2.0, 3.0, 4.0, 5.0], [math.nan] * 6, [math.inf] + [0.0] * 5, [1e300] * 6, [1.0, 2.0]]
    rows = [(i, v, "k") for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").repartition(5)
    check_whitening(whiten.whiten(df).collect(), list(range(40)), good, 6)


def test_whitening_with_few_directions(spark):
    """Repeated rows, a constant dimension and equal eigenvalues."""
    corners = [[s * (i == j) * 2.0 for j in range(4)] + [7.0] for i in range(3) for s in (-1, 1)]
    rows = [(i, v) for i, v in enumerate(corners * 3)]
    got = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-9
    assert all(abs(r["explained"] - 1 / 3) < 1e-9 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_whitening_without_deviation(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whiten.whiten(df).collect() == []


def test_whitening_of_wide_integers(spark):
    """Entries whose products need more than 64 bits: exact, or null."""
    rows = [(i, [float(2**54 * i), 1.0]) for i in range(8)]
    got = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    assert {r["deviation"] for r in got} == {None}
    middle = [(i, [float(2**25 * i), float(i % 2)]) for i in range(8)]
    got = whiten.whiten(spark.createDataFrame(middle, "vec_id long, embedding array<double>"), 2).collect()
    x = [(64 * 2**25 * i + 10**6, 64 * (i % 2) + 10**6) for i in range(8)]
    total = [sum(v[d] for v in x) for d in range(2)]
    wanted = {i: sum((8 * v[d] - total[d]) ** 2 for d in range(2)) for i, v in enumerate(x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: v if v < 2**63 else None for i, v in wanted.items()}


# Extraction

LONG = "A paragraph of prose that is long enough to count as the content of its page, with words. " * 3


def test_extraction_of_a_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op13_extraction(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for row in rows:
        inner = row["html"].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1|br)>", inner)
        text = " ".join(" ".join(" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts).split())
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (text, len(text))


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("", []),
        ("just text", ["just text"]),
        ("<nav><a href=x>Home</a></nav><footer>(c)</footer>", []),
        (f"<p>{LONG}<p>Short.<div>cut <b", [LONG.strip(), "Short.", "cut"]),
        (f"<p>{LONG}</p><!-- <p>never ended</p>", [LONG.strip()]),
        ("<p>a<b>b</b>c<br>d&amp;e&nbsp;f &#233; &zzz; x<y</p>", ["abc d&e f é &zzz; x"]),
        (
            f'<body class="has-sidebar"><div id="top"><a>Site</a></div><ul><li><a>A</a><li><a>B</a><li><a>C</a></ul><div id="text">'
            f"<h1>Title</h1><p>{LONG}</p><p>Hm.</p><ul><li>one</li><li>two</li></ul></div>"
            f'<div class="side-bar sidebar">{LONG}</div><div id="cookie-notice">{LONG}</div>'
            f'<div id="comments"><p>{LONG}</p></div><div class="adSlot ad">{LONG}</div></body>',
            ["Title", LONG.strip(), "Hm.", "one", "two"],
        ),
        (
            f"<header><h1>Site</h1></header><main><article><header><h1>Head</h1></header><p>{LONG}</p>"
            "<aside>see also</aside><form>name <input></form><script>x<y</script><style>p{}</style>"
            f'<p>End.</p><footer>by me</footer></article><section class="comments"><article>{LONG}</article></section></main>',
            ["Head", LONG.strip(), "End."],
        ),
        (f"<div><h1>Title</h1><article><section><p>{LONG}</p></section><section>tiny</section></article></div>", ["Title", LONG.strip(), "tiny"]),
        ("<![odd [x]><p>kept</p><![if x]>", ["kept"]),
        (f"<p hidden>{LONG}</p><p style='display: none'>{LONG}</p><div role=navigation>{LONG}</div><p>seen</p>", ["seen"]),
    ],
)
def test_extraction_of_pages(page, blocks):
    assert extract.main_blocks(page) == blocks


def test_extraction_of_odd_rows(spark):
    long = "<p>word</p>" * 30000
    rows = [(1, None, "u"), (2, "", "u"), (None, "<p>x</p>", None), (None, "<p>x</p>", None), (5, long, "u"), (6, "<div>" * 20000 + "deep", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in extract.extract_text(df).collect()), key=str)
    wanted = [(1, "", 0), (2, "", 0), (None, "x", 1), (None, "x", 1), (5, " ".join(["word"] * 30000), 149999), (6, "deep", 4)]
    assert got == sorted(wanted, key=str)
    assert extract.extract_text(df.limit(0)).collect() == []
    broken = df.limit(1).selectExpr("page_id", "cast(unhex('3C703EFF613C2F703E') as string) as html")
    assert extract.extract_text(broken).first()["text"] == "�a"
