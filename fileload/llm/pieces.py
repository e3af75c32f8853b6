"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A slice of texts becomes one flat array of symbols.  Words that repeat are merged
once.  Every round finds the smallest pair rank of each word, merges its leftmost
pair of that rank in all words at once, and compacts, until no pair remains: per
word that is the library's own order of merges.

Cases: a null or empty text has no ids and decodes to an empty text (the result is
empty, never null); rows may repeat; characters outside the vocabulary become byte
pieces; input columns named like a result column are replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from fileload.llm.text import lists, map_texts, mix64, process_cache, ragged, range_hash

SPACE = 0x2581  # stands for a blank in pieces
NONE = np.int32(2**31 - 1)
#: Words of more symbols are merged one by one, with a heap.
LONG_WORD = 192
_BASE = 0xC2B2AE3D27D4EB4F


class PieceModel:
    """The vocabulary of a BPE model: symbols, mergeable pairs, bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        scores = [sp.get_score(i) for i in range(n)]
        # Merges go by score, and among equal scores from the left.
        place = {x: r for r, x in enumerate(sorted({-scores[i] for i in ids.values()}))}
        self.char_id = np.full(0x110000, -1, np.int32)
        pairs = {}
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
            if any(c not in ids for c in piece) or chr(SPACE) in piece.lstrip(chr(SPACE)):
                raise ValueError(f"piece {piece!r} spans words or holds a character that is no piece")
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * n + right] = (place[-scores[i]], i)
        keys = sorted(pairs)
        self.pair_keys = np.array(keys, np.int64)
        self.pair_ranks = np.array([pairs[k][0] for k in keys], np.int32)
        self.pair_ids = np.array([pairs[k][1] for k in keys], np.int32)
        self.pairs = pairs
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        raw = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                raw.append(bytes([self.byte_of[i]]))
            elif sp.is_control(i):
                raw.append(b"")
            elif sp.is_unknown(i):
                raw.append(" ⁇ ".encode())
            else:
                raw.append(piece.replace(chr(SPACE), " ").encode())
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_length = np.array([len(x) for x in raw], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.blank_first = np.array([not special[i] and raw[i][:1] == b" " for i in range(n)])
        self.silent = self.piece_length == 0

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if they don't merge) and id of the piece that two symbols make."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE), self.pair_ids[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words at once; the symbols left, and how many per word."""
        done_words, done_symbols = [], []
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        long = np.flatnonzero(lengths > LONG_WORD)
        if len(long):
            ends = np.cumsum(lengths)
            for w in long.tolist():
                left = self._merge_one(symbols[ends[w] - lengths[w] : ends[w]].tolist())
                done_words.append(np.full(len(left), w, np.int32))
                done_symbols.append(np.array(left, np.int32))
            short = np.repeat(lengths <= LONG_WORD, lengths)
            symbols, word = symbols[short], word[short]
        rank = np.full(len(symbols), NONE, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        made = np.zeros(len(symbols), np.int32)
        rank[inside], made[inside] = self.lookup(symbols[inside], symbols[inside + 1])
        symbols = symbols.copy()
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(symbols)])
            alive = np.repeat(best < NONE, counts)
            if not alive.all():
                done_words.append(word[~alive])
                done_symbols.append(symbols[~alive])
                symbols, word, rank, made = symbols[alive], word[alive], rank[alive], made[alive]
                counts, best = counts[best < NONE], best[best < NONE]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, counts))
            place = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            symbols[place] = made[place]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            symbols, word, rank, made = symbols[stay], word[stay], rank[stay], made[stay]
            place -= np.arange(len(place))  # one symbol went from each word before
            rank[place] = NONE
            for left in (place[(place + 1 < len(word))], place[place > 0] - 1):
                left = left[word[left] == word[left + 1]]
                rank[left], made[left] = self.lookup(symbols[left], symbols[left + 1])
        if not done_words:
            return np.empty(0, np.int32), np.zeros(len(lengths), np.int64)
        words, left = np.concatenate(done_words), np.concatenate(done_symbols)
        return left[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """The same for one long word, in n log n steps."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = after[i]
            if j < n:
                found = self.pairs.get(symbols[i] * self.size + symbols[j])
                if found is not None:
                    heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, found = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = found, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each text has."""
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        flat = "".join([chr(SPACE) + t for t in texts if t]).replace(" ", chr(SPACE))
        chars = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        if not len(chars):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        symbols = self.char_id[chars]
        known, blank = symbols >= 0, chars == SPACE
        first = np.ones(len(chars), bool)
        first[1:] = blank[1:] & ~blank[:-1] | ~known[1:] | ~known[:-1]
        bounds = np.cumsum(sizes)
        first[(bounds - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(first)
        lengths = np.diff(np.r_[starts, len(chars)])
        # Each different word once: by hash, then character by character.
        hashes = range_hash(mix64(chars.astype(np.uint64)), starts, starts + lengths, _BASE)
        _, sample, kind = np.unique(hashes, return_index=True, return_inverse=True)
        same = lengths == lengths[sample][kind]
        same &= np.logical_and.reduceat(chars == chars[np.minimum(ragged(starts[sample][kind], lengths), len(chars) - 1)], starts)
        if not same.all():
            odd = np.flatnonzero(~same)
            kind[odd] = len(sample) + np.arange(len(odd))
            sample = np.r_[sample, odd]
        at, length = starts[sample], lengths[sample]
        unknown = ~known[at]
        ids, counts = self.merge(symbols[ragged(at[~unknown], length[~unknown])], length[~unknown])
        n_ids = np.zeros(len(sample), np.int64)
        n_ids[~unknown] = counts
        from_id = np.zeros(len(sample), np.int64)
        from_id[~unknown] = np.cumsum(counts) - counts
        if unknown.any():
            spelled = [chr(c).encode() for c in chars[at[unknown]].tolist()]
            n_ids[unknown] = [len(x) for x in spelled]
            from_id[unknown] = len(ids) + np.cumsum(n_ids[unknown]) - n_ids[unknown]
            ids = np.r_[ids, self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]]
        per_word = n_ids[kind]
        total = np.r_[0, np.cumsum(per_word)]
        words_before = np.searchsorted(starts, np.r_[bounds - sizes, len(chars)])
        return ids[ragged(from_id[kind], per_word)], np.diff(total[words_before])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of lists of ids, given flat with the length of each list."""
        ends = np.cumsum(counts)
        starts = ends - counts
        lengths = self.piece_length[ids]
        data = self.piece_bytes[ragged(self.piece_start[ids], lengths)]
        total = np.r_[0, np.cumsum(lengths)]
        # The blank before a text's first piece is not part of the text.
        speaks = np.flatnonzero(~self.silent[ids])
        lead = np.minimum(np.searchsorted(speaks, starts), max(len(speaks) - 1, 0))
        lead = speaks[lead] if len(speaks) else np.zeros(len(counts), np.int64)
        strip = (lead >= starts) & (lead < ends)
        strip[strip] = self.blank_first[ids[lead[strip]]]
        keep = np.ones(len(data), bool)
        keep[total[lead[strip]]] = False
        offsets = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(total[ends] - total[starts] - strip, out=offsets[1:])
        raw = data[keep].tobytes()
        try:
            raw.decode()
            return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(raw)).cast(pa.string())
        except UnicodeDecodeError:
            return pa.array([self._decode_one(ids[s:e].tolist(), bool(x)) for s, e, x in zip(starts, ends, strip)], pa.string())

    def _decode_one(self, ids: list[int], strip: bool) -> str:
        """With U+FFFD for every byte piece that is no part of a character."""
        parts, run = [], b""
        for i in [*ids, None]:
            if i in self.byte_of:
                run += bytes([self.byte_of[i]])
                continue
            while run:
                size = next((k for k in range(1, 5) if self._is_char(run[:k])), 0)
                parts.append(run[:size].decode() if size else "�")
                run = run[size or 1 :]
            if i is not None:
                s = self.piece_start[i]
                parts.append(self.piece_bytes[s : s + self.piece_length[i]].tobytes().decode())
        return "".join(parts)[strip:]

    @staticmethod
    def _is_char(raw: bytes) -> bool:
        try:
            return len(raw.decode()) == 1
        except UnicodeDecodeError:
            return False


def model(path: str) -> PieceModel:
    """The model, read once per Python worker."""
    models = process_cache("pieces")
    if path not in models:
        models[path] = PieceModel(path)
    return models[path]


IDS = StructType([StructField("ids", ArrayType(IntegerType()))])
DECODED = StructType([StructField("decoded", StringType())])


def encode(docs: DataFrame, model_path: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the piece ids of each text, without begin or end ids.
    ``model_path`` is a file that every executor has."""

    def run(texts):
        ids, counts = model(model_path).encode(texts.to_pylist())
        return [lists(pa.array(ids), counts)]

    return map_texts(docs, text_col, IDS, run)


def decode(docs: DataFrame, model_path: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of ``ids``; null ids count as none.
    ``text_col`` only bounds the slices."""

    def run(_, ids):
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        counts = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()]) if ids.null_count else np.diff(ids.offsets.to_numpy())
        return [model(model_path).decode(flat, counts)]

    return map_texts(docs, text_col, DECODED, run, (ids_col,))


def encode_decode(docs: DataFrame, model_path: str, *, text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` of the ids in one pass over the texts."""

    def run(texts):
        ids, counts = model(model_path).encode(texts.to_pylist())
        return [lists(pa.array(ids), counts), model(model_path).decode(ids, counts)]

    return map_texts(docs, text_col, StructType([*IDS, *DECODED]), run)
