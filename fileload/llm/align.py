"""Alignment of two tokenisations of the same texts, and how often tokens meet.

A text is cut into units before single blanks that follow a character that is no
white space: neither tokenizer merges across such a place, so both have a token end
there and equal units align alike.  Each different unit is encoded and aligned once
while a task remembers it; new units are given to the tokenizers several in one text,
joined where it would be cut again.  Within a unit the two lists of token ends are aligned
by divide and conquer: near the middle of an interval a common end is looked for, by
bisection in the other list and in widening windows, and both halves go on; an interval
without a common end inside is a leaf, one group.  All intervals of a level are handled at
once.

How many documents hold a pair of linked ids is counted in three steps.  Tasks write
their documents in chunks of bounded size, each with a dictionary of its id pairs, and
a chunk in parts, each with a dictionary of its units; pairs are added up over chunks,
so a pair that every document holds is one row per chunk; counts go back to the chunks'
parts, and from units to documents.

Cases: a text that is null or empty has no tokens, nor has one whose tokens do not
spell a blank and the text (it holds U+2581, say): all counts are 0 and the lists and the
digest's text empty.  Texts may repeat and be of any length; a text without blanks is
one unit.  Ids may be null or repeat: rows are not told apart by them.  Other columns
stay in ``align_tokens`` unless named like a result, and are left out of
``score_links``.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fileload.llm.text import col, lists, map_texts, process_cache, ragged, slices, text_bytes
from fileload.session import conf_scope, stage_table

#: Bytes of text cut into units at a time, of which a chunk's part is made, and those of one chunk.
PART, CHUNK = 1 << 19, 2 << 20
#: Parts in a stored file, some 16 MB: whoever reads them holds a file's as columns.
FILE_PARTS = 16
#: Parts that are scored as one batch: all that a task reads would be one otherwise.
_SCORE_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: Units and bytes of them that a task remembers before it forgets the rarer ones.
MEMORY, MEMORY_BYTES = 160_000, 16 << 20
#: Units in a text that a tokenizer is given, and such texts at a time; what it makes of
#: each is larger by far.
JOINED, BATCH = 64, 64

_BLANK = "▁"


class _Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        # Spark has a task for every core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        plain = _byte_characters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_raw = _table([bytes(plain[c] for c in t) if all(c in plain for c in t) else t.encode() for t in names])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_raw = _table(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        )
        self.a_size, self.b_size = size, len(pieces)
        # How an id is written inside of a group's list, and at the list's end.
        self.written = _table([f"{i}{mark}".encode() for n, end in ((size, "|"), (len(pieces), ";")) for mark in (",", end) for i in range(n)])
        self.blank = self.b.piece_to_id(_BLANK)

    def encode(self, lines: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts, each of which begins with a blank.  The second tokenizer
        puts that blank itself, but not before an empty text."""
        a, b = [], []
        for at in range(0, len(lines), BATCH):
            some = lines[at : at + BATCH]
            a += [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            b += [ids or [self.blank] for ids in self.b.encode([x[1:] for x in some], num_threads=1)]
        return a, b

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which units both lists of tokens spell, and of either tokenizer the ids of
        those units, one after the other, and how many each unit has."""
        raw = b"".join(units)
        data = np.frombuffer(raw, np.uint8)
        size = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(size)
        begins = ends - size

        def encode(first, many):
            stop = ends[first + many - 1]
            return self.encode([raw[s:e].decode("utf-8", "replace") for s, e in zip(begins[first].tolist(), stop.tolist())])

        def spelled(a, b, many):
            return _spelled_lines(*a, self.a_raw, data, size, many) & _spelled_lines(*b, self.b_raw, data, size, many)

        # A line ends where a text would not be cut before the next unit.
        graph = (data > 0x20) & (data < 0x7F)
        last, second = ends[:-1] - 1, np.minimum(begins[1:] + 1, ends[1:] - 1)
        joins = graph[last] | (data[last] >= 0x80) & graph[second]
        first = np.flatnonzero(np.r_[True, ~joins] | (np.arange(len(units)) % JOINED == 0))
        many = np.diff(np.r_[first, len(units)])
        a, b = encode(first, many)
        sound = spelled(_flat(a), _flat(b), many)
        odd = ~sound & (many > 1)
        if odd.any():
            # Units of lines that do not agree are given alone.
            alone = np.flatnonzero(np.repeat(odd, many))
            more_a, more_b = encode(alone, np.ones(len(alone), np.int64))
            first = np.r_[first[~odd], alone]
            order = np.argsort(first)
            kept = np.flatnonzero(~odd).tolist()
            a, b = ([x[i] for i in kept] + more for x, more in ((a, more_a), (b, more_b)))
            a, b = ([x[i] for i in order.tolist()] for x in (a, b))
            many = np.diff(np.r_[first[order], len(units)])
            sound = spelled(_flat(a), _flat(b), many)
        of_unit = np.repeat(sound, many)
        out = [of_unit]
        for coded, table in ((a, self.a_raw), (b, self.b_raw)):
            ids, counts = _flat(coded)
            ids = ids[np.repeat(sound, counts)]
            stop = np.searchsorted(np.cumsum(table[2][ids]), np.cumsum(size[of_unit])) + 1
            n = np.zeros(len(units), np.int64)
            n[of_unit] = np.diff(stop, prepend=0)
            out += [ids, n]
        return tuple(out)


def _byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def _table(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(x) for x in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(length) - length, length


def _tokenizers(a_path: str, b_path: str) -> _Pair:
    """Read once per Python worker."""
    known = process_cache("aligned pairs")
    if (a_path, b_path) not in known:
        known[a_path, b_path] = _Pair(a_path, b_path)
    return known[a_path, b_path]


def common_cuts(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places in ``a_ends`` of the ends that ``b_ends`` has too, by divide and conquer.

    Both lists rise; ``first`` and ``stop`` are ranges of ``a_ends`` whose last end is
    a common one.
    """
    cuts = [stop - 1]
    lo, hi = first, stop - 1  # inner ends of each interval
    while True:
        open_ = lo < hi
        lo, hi = lo[open_], hi[open_]
        if not len(lo):
            break
        middle = (lo + hi) // 2
        found = np.full(len(lo), -1)
        todo, reach = np.arange(len(lo)), 0
        while len(todo):
            start = np.maximum(lo[todo], middle[todo] - reach)
            end = np.minimum(hi[todo], middle[todo] + reach + 1)
            place = ragged(start, end - start)
            owner = np.repeat(np.arange(len(todo)), end - start)
            at = np.minimum(np.searchsorted(b_ends, a_ends[place]), len(b_ends) - 1)
            hit = np.flatnonzero(b_ends[at] == a_ends[place])
            if len(hit):
                # The nearest to the middle, of two as near the left one.
                far = np.abs(place[hit] - middle[todo[owner[hit]]])
                order = np.lexsort((far, owner[hit]))
                nearest = order[np.r_[True, np.diff(owner[hit][order]) != 0]]
                found[todo[owner[hit][nearest]]] = place[hit][nearest]
            whole = (start == lo[todo]) & (end == hi[todo])
            todo = todo[(found[todo] < 0) & ~whole]
            reach = 2 * reach + 1
        split = found >= 0
        lo, hi, at = lo[split], hi[split], found[split]
        cuts.append(at)
        lo, hi = np.concatenate([lo, at + 1]), np.concatenate([at, hi])
    return np.sort(np.concatenate(cuts))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _spelled(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of tokens end to end, and the length of each token."""
    raw, start, length = table
    return raw[ragged(start[ids], length[ids])], length[ids]


def _spelled_lines(ids, counts, table, data, size, many) -> np.ndarray:
    """Which lines, of ``many`` units of ``size`` bytes in ``data`` each, their tokens
    spell, with a token's end where a unit ends."""
    line = _sums(size, many)
    length = table[2][ids]
    fits = _sums(length, counts) == line
    text, length = _spelled(ids[np.repeat(fits, counts)], table)
    wrong = text != data[np.repeat(fits, line)]
    ends, stops = np.cumsum(length), np.cumsum(size[np.repeat(fits, many)])
    lacking = ends[np.searchsorted(ends, stops)] != stops
    fits[fits] = (_sums(wrong, line[fits]) == 0) & (_sums(lacking, many[fits]) == 0)
    return fits


class _Store:
    """What is known of different units, one after the other."""

    def __init__(self, pair: _Pair):
        self.pair = pair
        self.code: dict[bytes, int] = {}
        self.bytes = 0
        self.digest: list[bytes] = []
        self.sound, self.n_a, self.n_b, self.n_groups = (np.empty(0, t) for t in (bool, np.int64, np.int64, np.int64))
        self.a_ids, self.b_ids, self.a_ends, self.b_ends, self.links = (np.empty(0, np.int32) for _ in range(5))
        self.n_links = np.empty(0, np.int64)
        # How often each unit was met, an earlier time counting half.
        self.met = np.empty(0, np.int64)
        # Id pairs of all links, in the order they were met.
        self.pair_of: dict[int, int] = {}

    def codes(self, units: pa.Array) -> np.ndarray:
        """A number for each unit; units not seen before are encoded and aligned."""
        known = units.dictionary_encode()
        offsets, data = text_bytes(known.dictionary)
        different = _cut(data, np.diff(offsets))
        codes = np.fromiter(map(self.code.get, different, repeat(-1)), np.int64, len(different))
        lacking = np.flatnonzero(codes < 0)
        if len(lacking):
            fresh = [different[i] for i in lacking.tolist()]
            codes[lacking] = len(self.code) + np.arange(len(fresh))
            self.code.update(zip(fresh, codes[lacking].tolist()))
            self.bytes += sum(map(len, fresh))
            self._add(fresh)
        places = known.indices.to_numpy()
        self.met[codes] += np.bincount(places, minlength=len(codes))
        return codes[places]

    def full(self) -> bool:
        return len(self.code) > MEMORY or self.bytes > MEMORY_BYTES

    def forget(self) -> None:
        """Keep units that were met again, the most frequent ones, half of what is remembered at most."""
        units = list(self.code)
        keep = np.flatnonzero(self.met > 1)
        keep = keep[np.argsort(-self.met[keep], kind="stable")][: MEMORY // 2]
        size = np.fromiter((len(units[i]) for i in keep.tolist()), np.int64, len(keep))
        keep = np.sort(keep[np.cumsum(size) <= MEMORY_BYTES // 2])
        self.code = {units[i]: code for code, i in enumerate(keep.tolist())}
        self.bytes = sum(map(len, self.code))
        self.digest = [self.digest[i] for i in keep.tolist()]

        def kept(values, n):
            return values[ragged((np.cumsum(n) - n)[keep], n[keep])]

        self.a_ids, self.b_ids = kept(self.a_ids, self.n_a), kept(self.b_ids, self.n_b)
        self.a_ends, self.b_ends = kept(self.a_ends, self.n_groups), kept(self.b_ends, self.n_groups)
        there, self.links = np.unique(kept(self.links, self.n_links), return_inverse=True)
        self.links = self.links.astype(np.int32)
        pairs = list(self.pair_of)
        self.pair_of = {pairs[i]: place for place, i in enumerate(there.tolist())}
        self.sound, self.n_a, self.n_b, self.n_groups, self.n_links, self.met = (
            x[keep] for x in (self.sound, self.n_a, self.n_b, self.n_groups, self.n_links, self.met)
        )
        self.met //= 2

    def _add(self, units: list[bytes]) -> None:
        sound, a_ids, n_a, b_ids, n_b = self.pair.encode_units(units)
        a_ends, b_ends = np.cumsum(self.pair.a_raw[2][a_ids]), np.cumsum(self.pair.b_raw[2][b_ids])
        stop = np.cumsum(n_a)
        some = n_a > 0
        cuts = common_cuts(a_ends, b_ends, (stop - n_a)[some], stop[some]) if some.any() else np.empty(0, np.int64)
        a_cut = cuts + 1
        b_cut = np.searchsorted(b_ends, a_ends[cuts]) + 1
        unit_of_a = np.repeat(np.arange(len(units)), n_a)
        n_groups = np.bincount(unit_of_a[cuts], minlength=len(units))
        # A link is a stretch between ends of either list: one token of each covers it.
        stretch = _distinct(np.concatenate([a_ends, b_ends]))
        link_a, link_b = np.searchsorted(a_ends, stretch), np.searchsorted(b_ends, stretch)
        self.digest.extend(self._digests(a_ids, b_ids, a_cut, b_cut, n_a + n_b))
        pairs, of = np.unique(a_ids[link_a] * self.pair.b_size + b_ids[link_b], return_inverse=True)
        known = np.array([self.pair_of.setdefault(p, len(self.pair_of)) for p in pairs.tolist()], np.int32)
        self.links = np.concatenate([self.links, known[of]])
        self.n_links = np.concatenate([self.n_links, np.bincount(unit_of_a[link_a], minlength=len(units))])
        self.sound = np.concatenate([self.sound, sound])
        self.met = np.concatenate([self.met, np.zeros(len(units), np.int64)])
        self.n_a, self.n_b = np.concatenate([self.n_a, n_a]), np.concatenate([self.n_b, n_b])
        self.n_groups = np.concatenate([self.n_groups, n_groups])
        # Ends of groups are counted in tokens from the unit's first.
        a_cut, b_cut = a_cut - np.repeat(stop - n_a, n_groups), b_cut - np.repeat(np.cumsum(n_b) - n_b, n_groups)
        self.a_ids, self.b_ids, self.a_ends, self.b_ends = (
            np.concatenate([old, new.astype(np.int32)])
            for old, new in ((self.a_ids, a_ids), (self.b_ids, b_ids), (self.a_ends, a_cut), (self.b_ends, b_cut))
        )

    def _digests(self, a_ids, b_ids, a_cut, b_cut, n_tokens) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3;`` of each unit: every group ends in a semicolon."""
        a_n, b_n = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + np.repeat(b_cut - b_n, a_n)] = a_ids
        order[np.arange(len(b_ids)) + np.repeat(a_cut, b_n)] = b_ids + 2 * self.pair.a_size
        ends = a_cut + b_cut - 1
        order[ends - b_n] += self.pair.a_size
        order[ends] += self.pair.b_size
        text, length = _spelled(order, self.pair.written)
        # Tokens of each unit follow one another.
        return _cut(text, _sums(length, n_tokens))


def _cut(text: np.ndarray, size: np.ndarray) -> list[bytes]:
    ends = np.cumsum(size)
    whole = text.tobytes()
    return [whole[e - s : e] for s, e in zip(size.tolist(), ends.tolist())]


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units of a blank and each text, and how many each text has; none if empty."""
    offsets, data = text_bytes(texts)
    size = np.diff(offsets)
    some = size > 0
    # A blank before each text that is not empty.
    shift = np.cumsum(some)
    whole = np.full(len(data) + int(some.sum()), 0x20, np.uint8)
    starts = offsets[:-1][some] + shift[some] - 1
    body = np.ones(len(whole), bool)
    body[starts] = False
    whole[body] = data
    graph = (whole > 0x20) & (whole < 0x7F)
    before = np.r_[False, graph[:-1]]
    high = np.r_[False, whole[:-1] >= 0x80] & np.r_[graph[1:], False]
    cut = (whole == 0x20) & (before | high)
    cut[starts] = True
    at = np.flatnonzero(cut)
    units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.r_[at, len(whole)]), pa.py_buffer(whole))
    counts = np.zeros(len(texts), np.int64)
    counts[some] = np.diff(np.r_[np.searchsorted(at, starts), len(at)])
    return units, counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive ranges of the given lengths, empty ones too."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


_ALIGNED = StructType(
    [
        StructField("a_ids", ArrayType(IntegerType())),
        StructField("b_ids", ArrayType(IntegerType())),
        StructField("a_ends", ArrayType(IntegerType())),
        StructField("b_ends", ArrayType(IntegerType())),
    ]
)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with both tokenisations of a blank and the text, ``a_ids`` and
    ``b_ids``, and the groups they fall into: ``a_ends[g]`` and ``b_ends[g]`` count the
    tokens up to the end of group g.  The paths are files that every executor has."""

    def run(texts):
        store = _Store(_tokenizers(a_path, b_path))
        units, counts = _units(texts)
        codes, kept = _kept(store, units, counts)
        out = []
        for values, per_unit, step in (
            (store.a_ids, store.n_a, None),
            (store.b_ids, store.n_b, None),
            (store.a_ends, store.n_groups, store.n_a),
            (store.b_ends, store.n_groups, store.n_b),
        ):
            first = np.cumsum(per_unit) - per_unit
            flat = values[ragged(first[codes], per_unit[codes])]
            sizes = _sums(per_unit[codes], kept)
            if step is not None:
                before = np.cumsum(step[codes]) - step[codes]
                begin = np.r_[0, np.cumsum(step[codes])][np.cumsum(kept) - kept]
                before -= np.repeat(begin, kept)
                flat = flat + np.repeat(before, per_unit[codes])
            out.append(lists(pa.array(flat.astype(np.int32)), sizes))
        return out

    return map_texts(docs, text_col, _ALIGNED, run, slice_bytes=PART)


def _kept(store: _Store, units: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the units of texts whose tokens spell them, and how many per text."""
    codes = store.codes(units)
    sound = _sums(~store.sound[codes], counts) == 0
    return codes[np.repeat(sound, counts)], counts * sound


def _chunk_fields(id_field: StructField) -> StructType:
    longs, ints = ArrayType(LongType()), ArrayType(IntegerType())
    return StructType(
        [
            StructField("chunk", StringType()),
            StructField("ids", ArrayType(id_field.dataType)),
            StructField("n_a", longs),
            StructField("n_b", longs),
            StructField("n_groups", longs),
            StructField("n_links", longs),
            StructField("digests", ArrayType(StringType())),
            # For each document how many units, and which of the part's units.
            StructField("n_units", ints),
            StructField("units", ints),
            # For each unit how many links, and which of the chunk's pairs.
            StructField("unit_links", ints),
            StructField("links", ints),
            # For each pair of the chunk the two ids, and how many documents hold it; in
            # the chunk's first part.
            StructField("pairs", longs),
            StructField("held", ints),
        ]
    )


def _chunk(store: _Store, ids: pa.Array, texts: pa.Array) -> Iterator[list[pa.Array]]:
    """A row for each part of some documents: facts of each, a dictionary of its units,
    and in the first a dictionary of all parts' pairs."""
    parts, held = [], []
    for lo, hi in slices(texts, PART):
        part, many = _kept(store, *_units(texts.slice(lo, hi - lo)))
        words, ends = list(map(store.digest.__getitem__, part.tolist())), np.cumsum(many).tolist()
        digests = []
        for s, e in zip([0, *ends[:-1]], ends):
            digests.append(hashlib.sha256(b"".join(words[s:e])[:-1]).hexdigest() if e > s else "")
        parts.append((ids.slice(lo, hi - lo), part, many, digests))
        # Each unit once for a document, then each pair once.
        doc, unit = np.divmod(_distinct(np.repeat(np.arange(hi - lo), many) * len(store.code) + part), max(1, len(store.code)))
        first = np.cumsum(store.n_links) - store.n_links
        size = store.n_links[unit]
        wide = max(1, len(store.pair_of))
        pairs = _distinct(np.repeat(doc, size) * wide + store.links[ragged(first[unit], size)]) % wide
        held.append(np.bincount(pairs, minlength=len(store.pair_of)))
    n_held = np.zeros(len(store.pair_of), np.int64)
    for part in held:
        n_held[: len(part)] += part
    # The chunk's own numbers for the pairs in it.
    there = np.flatnonzero(n_held)
    place = np.zeros(len(store.pair_of), np.int64)
    place[there] = np.arange(len(there))
    pairs = np.fromiter(store.pair_of, np.int64, len(store.pair_of))[there]
    held = n_held[there]
    first = np.cumsum(store.n_links) - store.n_links
    chunk = uuid.uuid4().hex

    def one(values, kind) -> pa.Array:
        flat = pa.array(values, kind)
        return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)

    for some, codes, counts, digests in parts:
        # The part's own numbers for the units in it.
        there = np.zeros(len(store.code), bool)
        there[codes] = True
        used, units = np.flatnonzero(there), (np.cumsum(there) - 1)[codes]
        per_unit = store.n_links[used]
        links = place[store.links[ragged(first[used], per_unit)]]
        sums = [_sums(per[codes], counts) for per in (store.n_a, store.n_b, store.n_groups, store.n_links)]
        yield [
            pa.array([chunk]),
            pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some),
            *(one(s, pa.int64()) for s in sums),
            one(digests, pa.string()),
            *(one(v, pa.int32()) for v in (counts, units, per_unit, links)),
            one(pairs, pa.int64()),
            one(held, pa.int32()),
        ]
        pairs, held = pairs[:0], held[:0]


def _scored(scores: DataFrame, id_field: StructField) -> DataFrame:
    """Documents of chunks' parts whose pairs have their counts (``pair_counts``, in order;
    below zero for pairs that are their first id's most frequent)."""
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = StructType(
        [id_field, *(StructField(name, LongType()) for name in names[:-1]), StructField(names[-1], StringType())]
    )
    fields = ["ids", "n_a", "n_b", "n_groups", "n_links", "digests", "n_units", "units", "unit_links", "links", "pair_counts"]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part = {name: batch.column(i)[row].values for i, name in enumerate(fields)}
                number = {k: v.to_numpy(zero_copy_only=False) for k, v in part.items() if k not in ("ids", "digests")}
                count = np.abs(number["pair_counts"])[number["links"]]
                best = (number["pair_counts"] < 0)[number["links"]].astype(np.int64)
                per_doc = [
                    _sums(_sums(values, number["unit_links"])[number["units"]], number["n_units"]) for values in (best, count)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part["ids"], *(part[n] for n in ("n_a", "n_b", "n_groups", "n_links")), *map(pa.array, per_doc), part["digests"]],
                    names=[id_field.name, *names],
                )

    return scores.select(*fields).mapInArrow(run, schema)


def write_chunks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in parts of chunks, encoded and aligned, written once: what follows reads
    the same chunks however often a task is run again."""
    source = docs.select(col(id_col), col(text_col).cast("string").alias("__text"))
    schema = _chunk_fields(source.schema[0])

    def run(batches):
        store = _Store(_tokenizers(a_path, b_path))
        for batch in batches:
            for lo, hi in slices(batch.column(1), CHUNK):
                if store.full():
                    store.forget()
                for part in _chunk(store, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)):
                    yield pa.RecordBatch.from_arrays(part, names=schema.names)

    return stage_table(source.mapInArrow(run, schema), "aligned", maxRecordsPerFile=FILE_PARTS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair`` (first id times the second vocabulary's size plus second id), and in
    how many documents it is linked."""
    held = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    return held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n_docs"))


def score_links(docs: DataFrame, a_path: str, b_path: str, b_size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document its id, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``
    (pairs of tokens that overlap), ``n_best`` (links whose id pair is in as many
    documents as any of its first id), ``count_sum`` (documents of each link's pair,
    added up) and ``groups_sha256``.  ``b_size`` is the second vocabulary's size."""
    chunks = write_chunks(docs, a_path, b_path, id_col, text_col)
    counts = pair_counts(chunks)
    first = F.floor(F.col("pair") / b_size)
    top = counts.groupBy(first.alias("a")).agg(F.max("n_docs").alias("most"))
    signed = counts.join(top, first == F.col("a")).select(
        "pair", F.when(F.col("n_docs") == F.col("most"), -F.col("n_docs")).otherwise(F.col("n_docs")).alias("signed")
    )
    asked = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    answers = (
        asked.join(signed, "pair")
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("at", "signed"))).alias("got"))
        .select("chunk", F.col("got.signed").alias("pair_counts"))
    )
    # A chunk of texts without tokens has no pairs.
    nothing = F.array().cast("array<bigint>")
    # The small side is hashed, so that the parts need not be sorted.
    scores = chunks.drop("pairs", "held").join(answers.hint("shuffle_hash"), "chunk", "left").withColumn("pair_counts", F.coalesce("pair_counts", nothing))
    with conf_scope(docs.sparkSession, _SCORE_CONF):
        return stage_table(_scored(scores, StructField(id_col, chunks.schema["ids"].dataType.elementType)), "scored")
