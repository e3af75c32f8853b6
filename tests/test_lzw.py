"""The .Z helper against an independent decoder and hand-made bad payloads."""

import random
import shutil
import subprocess
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fileload.functions import lzw

gzip = pytest.mark.skipif(shutil.which("gzip") is None, reason="no gzip")

RANDOM = random.Random(7)
WORDS = " ".join(RANDOM.choice("load file line code table width clear group".split()) for _ in range(60000)).encode()
CASES = {
    "empty": b"",
    "one_byte": b"x",
    "pair_repeated": b"ab" * 500,
    "byte_repeated": b"a" * 5000,
    "zero_bytes": b"\0" * 4000,
    "random": RANDOM.randbytes(120_000),
    "words": WORDS,
    "multi_byte": "汉字é\n".encode() * 5000,
    # The table fills and then stops paying, so it is cleared.
    "changing": WORDS + RANDOM.randbytes(250_000) + WORDS,
}


def unpack(payload):
    status, width, block = lzw.read_header(payload)
    assert status == "ok"
    assert lzw.is_sound(payload, width, block)
    return b"".join(lzw.decode(payload, width, block))


@pytest.mark.parametrize("block", [True, False])
@pytest.mark.parametrize("width", [9, 10, 12, 13, 16])
@pytest.mark.parametrize("case", CASES)
def test_round_trip(case, width, block):
    assert unpack(lzw.encode(CASES[case], width, block)) == CASES[case]


@gzip
@pytest.mark.parametrize("block", [True, False])
@pytest.mark.parametrize("width", [9, 12, 16])
@pytest.mark.parametrize("case", CASES)
def test_other_decoder_agrees(case, width, block):
    payload = lzw.encode(CASES[case], width, block)
    assert subprocess.run(["gzip", "-dc"], input=payload, capture_output=True, check=True).stdout == CASES[case]


def test_header_only_and_clear():
    assert lzw.encode(b"") == b"\x1f\x9d\x90"
    tables = sum(fresh for _, _, fresh, _ in lzw.code_runs(lzw.encode(CASES["changing"]), 16, True))
    assert tables > 1


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(9, 16), st.booleans())
def test_round_trip_of_any_bytes(data, width, block):
    assert unpack(lzw.encode(data, width, block)) == data


def test_small_pieces_join_up():
    payload = lzw.encode(WORDS)
    pieces = list(lzw.decode(payload, 16, True, chunk=1000))
    assert len(pieces) > 100 and b"".join(pieces) == WORDS


@gzip
def test_long_phrases():
    data = b"q" * 33_000_000
    payload = lzw.encode(data)
    assert len(payload) < 20_000
    sizes = [len(piece) for piece in lzw.decode(payload, 16, True)]
    assert sum(sizes) == len(data) and max(sizes) < 5 << 20
    assert subprocess.run(["gzip", "-dc"], input=payload, capture_output=True, check=True).stdout == data


@gzip
def test_damaged_payloads_are_judged_alike():
    chance = random.Random(11)
    verdicts = set()
    for _ in range(150):
        data = chance.choice([WORDS[: chance.randrange(1, 20_000)], chance.randbytes(2000), b"a" * 2500])
        payload = bytearray(lzw.encode(data, chance.choice([9, 11, 16]), chance.random() < 0.7))
        at = chance.randrange(3, len(payload))
        damage = chance.choice(["flip", "cut", "insert"])
        if damage == "flip":
            payload[at] ^= 1 << chance.randrange(8)
        elif damage == "cut":
            del payload[at:]
        else:
            payload[at:at] = chance.randbytes(2)
        good = sound(bytes(payload))
        other = subprocess.run(["gzip", "-dc"], input=payload, capture_output=True)
        assert good == (other.returncode == 0)
        if good:
            assert unpack(bytes(payload)) == other.stdout
        verdicts.add((damage, good))
    assert {("flip", True), ("flip", False), ("cut", True), ("insert", False)} <= verdicts


def packed(codes, flags=0x90):
    bits = "".join(f"{code:09b}"[::-1] for code in codes)
    bits += "0" * (-len(bits) % 8)
    return lzw.MAGIC + bytes([flags]) + bytes(int(bits[i : i + 8][::-1], 2) for i in range(0, len(bits), 8))


def sound(payload):
    return lzw.is_sound(payload, *lzw.read_header(payload)[1:])


def test_hand_packed_codes():
    assert unpack(packed([97, 98, 257, 259])) == b"ab" + b"ab" + b"aba"
    # entry 257 used as soon as it is defined
    assert unpack(packed([97, 257])) == b"aaa"
    # without block mode 256 is an ordinary entry
    assert unpack(packed([97, 98, 256], 0x10)) == b"abab"
    # CLEAR drops the rest of its group of eight codes
    assert unpack(packed([97, 98, 256, 0, 0, 0, 0, 0, 99, 257])) == b"abccc"


@pytest.mark.parametrize(
    "codes",
    [
        [300],  # first code is no literal
        [256, 97],  # CLEAR with nothing before it
        [97, 258],  # entry not defined yet
        [97, 256, 0, 0, 0, 0, 0, 0, 256],  # CLEAR twice
        [97, 98, 256, 0, 0, 0, 0, 0, 257],  # entry of the table before
    ],
)
def test_unsound_codes(codes):
    assert not sound(packed(codes))


def test_ends_early():
    payload = lzw.encode(WORDS)
    half = payload[: len(payload) // 2]
    assert sound(half) and WORDS.startswith(unpack(half))
    assert unpack(packed([97, 98, 256])) == b"ab"


@pytest.mark.parametrize(
    "head, status",
    [
        (b"", "bad_magic"),
        (b"\x1f\x9d", "bad_magic"),
        (b"\x1f\x8b\x90", "bad_magic"),
        (b"\x1f\x9d\x88", "bad_width"),
        (b"\x1f\x9d\x91", "bad_width"),
        (b"\x1f\x9d\x10", "ok"),
        (b"\x1f\x9d\x89", "ok"),
    ],
)
def test_headers(head, status):
    assert lzw.read_header(head)[0] == status


def test_width_is_checked():
    with pytest.raises(ValueError):
        lzw.encode(b"x", 17)


class File:
    """Counts what is read of a payload, as an open file."""

    def __init__(self, raw):
        self.raw, self.most = raw, 0

    def read_at(self, count, pos):
        self.most = max(self.most, count)
        return self.raw[pos : pos + count]


def stretched(payload, least, source=None):
    found = lzw.survey(payload if source is None else source, *lzw.read_header(payload)[1:], least)
    parts = [b"".join(lzw.stretch_lines(payload, *lzw.read_header(payload)[1:], s)) for s in found.stretches]
    return found, parts


def texts_with_clears():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(3000)]
    prose = " ".join(rng.choices(words, k=60_000)).replace("a ", "\n")
    yield prose.encode()
    yield rng.randbytes(300_000)  # newlines everywhere, and a table that stops paying
    yield b"x" * 400_000 + rng.randbytes(200_000).replace(b"\n", b"") + b"\nend"  # a line over several stretches
    yield rng.randbytes(200_000).replace(b"\n", b"")  # one line
    yield b"\n" * 100_000 + rng.randbytes(150_000)
    yield b""


@pytest.mark.parametrize("max_bits", [9, 12, 16])
@pytest.mark.parametrize("number", range(6))
def test_stretches_decode_alone(number, max_bits):
    text = list(texts_with_clears())[number]
    payload = lzw.encode(text, max_bits)
    for least in (1, 30_000, 1 << 40):
        found, parts = stretched(payload, least, lzw.Opened(File(payload), len(payload), 1 << 14))
        assert found.sound and b"".join(parts) == text
        assert found.n_bytes == len(text)
        assert found.n_lines == len(text.splitlines()) if not set(text) & set(b"\r\x0b\x0c\x1c\x1d\x1e\x85") else True
        assert found.n_lines == text.count(b"\n") + (not text.endswith(b"\n") and text != b"")
        assert len(found.stretches) == 1 if least == 1 << 40 else True
        # A line's number is the newlines before it.
        done = 0
        for stretch, part in zip(found.stretches, parts):
            if part:
                first = stretch.newlines + (stretch.start > lzw.HEADER)
                assert first == text[:done].count(b"\n")
            done += len(part)
    if number == 1 and max_bits == 12:
        assert len(stretched(payload, 1)[0].stretches) > 3


def test_survey_of_a_corrupt_payload():
    assert not lzw.survey(lzw.MAGIC + b"\x90" + b"\xff" * 40, 16, True, 1).sound


def test_an_open_file_is_read_in_pieces():
    text = random.Random(5).randbytes(500_000)
    payload = lzw.encode(text)
    file = File(payload)
    assert b"".join(lzw.decode(lzw.Opened(file, len(payload), 1 << 12), 16, True)) == text
    assert file.most < 1 << 18
    with pytest.raises(EOFError):
        list(lzw.decode(lzw.Opened(File(payload[:-50]), len(payload), 1 << 12), 16, True))


def test_encoding_holds_no_text():
    # In pieces of any length the payload is that of the whole text, and while it is
    # encoded less is held than a third of the text.
    chance, text = random.Random(3), WORDS * 12
    tracemalloc.start()
    encoder, at = lzw.Encoder(), 0
    while at < len(text):
        step = chance.choice([1, 777, 10_000, 65_537])
        encoder.add(text[at : at + step])
        at += step
    payload = encoder.close()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert payload == lzw.encode(text) and unpack(payload) == text
    table = 16 << 20  # of 65,536 phrases, at any length of the text
    assert peak < table + len(text) // 3
