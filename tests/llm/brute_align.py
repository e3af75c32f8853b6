"""The alignment of two tokenisations word for word as the contract has it."""

import hashlib
from collections import Counter

import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer


def _characters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def tokenize(texts):
    """For each text two lists of (id, bytes), or two empty lists."""
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain, out = _characters(), []
    for text in texts:
        if not text:
            out.append(([], []))
            continue
        one = [(i, bytes(plain[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            two.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(t for _, t in one) == whole == b"".join(t for _, t in two)
        out.append((one, two) if same else ([], []))
    return out


def _ends(tokens):
    end, out = 0, []
    for _, raw in tokens:
        end += len(raw)
        out.append(end)
    return out


def links_of(one, two):
    i = j = 0
    a, b, out = _ends(one), _ends(two), []
    while i < len(one) and j < len(two):
        out.append((one[i][0], two[j][0]))
        end_a, end_b = a[i], b[j]
        i += end_a <= end_b
        j += end_b <= end_a
    return out


def rows(texts):
    coded = tokenize(texts)
    links = [links_of(*c) for c in coded]
    held = Counter(p for doc in links for p in set(doc))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (one, two), doc in zip(coded, links):
        a, b = _ends(one), _ends(two)
        cuts = sorted(set(a) & set(b))
        groups, i, j = [], 0, 0
        for cut in cuts:
            k, m = a.index(cut, i) + 1, b.index(cut, j) + 1
            groups.append(",".join(str(t) for t, _ in one[i:k]) + "|" + ",".join(str(t) for t, _ in two[j:m]))
            i, j = k, m
        out.append(
            (
                len(one),
                len(two),
                len(groups),
                len(doc),
                sum(held[p] == most[p[0]] for p in doc),
                sum(held[p] for p in doc),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
        )
    return out
