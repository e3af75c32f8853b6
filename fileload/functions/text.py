"""Column expressions on lines of text."""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(literal: str) -> str:
    """``literal`` as a Java regular expression that matches just itself, a single
    character in the form that Java splits on without the regex engine."""
    if len(literal) == 1:
        return literal if literal.isalnum() or literal.isspace() or ord(literal) > 127 else "\\" + literal
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def java_split(value: Column, sep: str) -> Column:
    """Split on a literal as Java's one-argument ``String.split`` does: trailing
    empty strings are dropped, ``''`` gives one empty string, and a value made
    only of separators gives an empty array."""
    if not sep:
        raise ValueError("the separator must not be empty")
    one = quoted(sep)
    kept = F.regexp_replace(value, F.lit(f"(?:{one})+\\z"), F.lit(""))
    none = F.array().cast("array<string>")
    return (
        F.when(value.isNull(), F.lit(None).cast("array<string>"))
        .when(value == "", F.array(F.lit("")))
        .when(kept == "", none)
        .otherwise(F.split(kept, one, -1))
    )


def check_charset(charset: str) -> str:
    """Canonical name of a charset whose newline is the single byte 0x0A."""
    if "\n".encode(charset) != b"\n" or "a|:".encode(charset) != b"a|:":
        raise ValueError(f"lines cannot be split on bytes in charset {charset!r}")
    return codecs.lookup(charset).name


def without_cr(line: Column) -> Column:
    """Drop one carriage return at the end of a line."""
    return F.when(line.endswith("\r"), line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)


def split_block(block: bytes, name: str) -> list[str]:
    """Decoded lines of a block of bytes: decoded as one, unless a broken character
    at a line's end takes the newline in."""
    lines = block.decode(name, "replace").split("\n")
    if len(lines) != block.count(b"\n") + 1:
        lines = [line.decode(name, "replace") for line in block.split(b"\n")]
    return lines


def decode_lines(values: pa.Array, name: str) -> pa.Array:
    """Text of binary values that hold no newline."""
    raw = values.fill_null(b"").to_pylist()
    return pa.array(split_block(b"\n".join(raw), name) if raw else [], pa.string(), mask=values.is_null().to_numpy(zero_copy_only=False))


def decoded(raw: Column, charset: str) -> Column:
    """Text of a string column that holds undecoded bytes.  Bytes that are not
    valid in the charset become U+FFFD, one bad byte never drops a row."""
    name = check_charset(charset)
    if name in ("utf-8", "ascii"):
        return F.make_valid_utf8(raw)

    @F.arrow_udf("string")
    def decode_bytes(values: pa.Array) -> pa.Array:
        return decode_lines(values, name)

    return decode_bytes(raw.cast("binary"))
