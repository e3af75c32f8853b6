"""Plain Python versions of the operators, and rows that are hard on them."""

import hashlib
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("n_words", StringType()),
        StructField("IDS", StringType()),
        StructField("Line", StringType()),
    ]
)

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(70))


def hard_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, equal texts,
    and columns named like results."""
    near = [f"n{i}" for i in range(120)]
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "one two three"),
        (7, LONG), (8, LONG), (8, LONG), (None, "one two three four five six"), (None, None),
        (9, "a\nb\nc\nd\n"), (10, "x\na\nb\nc\ny\n"), (11, "\n\n\n\n"), (12, "\n\n\n\n"), (13, "a\nb\nc\na\nb\nc"),
        (20, PASSAGE), (21, "before " + PASSAGE + " after"), (22, " ".join(PASSAGE.split()[10:65]) + " x"),
        (30, " ".join(near)), (31, " ".join([*near[:50], "z", *near[51:]])), (32, " ".join([*near[:20], "y", *near[21:]])),
        (33, " ".join(near[:60])), (34, "   ".join(near) + "\n"),
        (40, "é" * 3000), (41, "日本語 テスト 🙂 ▁ <s> \x00 tail"), (42, "you idiot, you MORON!!!"),
        (50, "a b c d e a b c d e " * 40), (51, "a b c d e a b c d e " * 40),
    ]
    return spark.createDataFrame([(i, t, None if k % 3 else "x", str(k), None) for k, (i, t) in enumerate(rows)], DOCS)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontamination(docs, items, n=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for item, text in items:
        w = re.findall(pattern, lower(text))
        if w and item is not None:
            for i in range(max(1, len(w) - n + 1)):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = re.findall(pattern, lower(text))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def near(docs, width, percent=80):
    sets = []
    for doc, text in docs:
        w = spaced(lower(text))
        s = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets.append(s)
    ids = [2**63 - 1 if d is None else d for d, _ in docs]
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(ids[a]), find(ids[b])
                label[max(x, y)] = min(x, y)
    out = []
    for i, s in zip(ids, sets):
        c = find(i) if s else i
        out.append((None if i == 2**63 - 1 else i, len(s), None if c == 2**63 - 1 else c, c == i))
    return out


def line_dedup(docs):
    """(id, text left, lines, removed) by windows of three lines, smallest id first."""
    first = {}
    split = [(2**63 - 1 if d is None else d, t, None if t is None else t.split("\n")) for d, t in docs]

    def windows(lines):
        for i in range(len(lines or []) - 2):
            if spaced("\n".join(lines[i : i + 3])):
                yield i, tuple(lines[i : i + 3])

    for d, _, lines in split:
        for _, key in windows(lines):
            first[key] = min(d, first.get(key, d))
    out = []
    for d, t, lines in split:
        gone, seen = set(), set()
        for i, key in windows(lines):
            if first[key] < d or key in seen:
                gone.update(range(i, i + 3))
            seen.add(key)
        left = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((None if d == 2**63 - 1 else d, left, len(lines or []), len(gone)))
    return out


def substring(docs, n=50):
    """(id, words, removed, hash of kept words)."""
    first = {}
    ids = [2**63 - 1 if d is None else d for d, _ in docs]
    for d, (_, t) in zip(ids, docs):
        w = spaced(t)
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, (doc, t) in zip(ids, docs):
        w = spaced(t)
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out
