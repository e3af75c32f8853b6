"""``.Z`` files to lines, and the sorting out of files that cannot be read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileload.functions import lzw
from fileload.functions.paths import opener
from fileload.functions.text import check_charset, split_block
from fileload.session import stage_table
from fileload.sources.bypath import OPEN_BYTES, dealt

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")

OUTPUT = (
    "path string, length bigint, modificationTime timestamp, kind string, line_no bigint, "
    "line string, status string, n_lines bigint, n_bytes bigint"
)


def _checked(mode: str) -> str:
    if mode.upper() not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return mode.upper()


def _line_blocks(pieces: Iterator[bytes], charset: str) -> Iterator[pa.Array]:
    """Whole lines of a stream of byte pieces; a piece may end anywhere, even
    inside a character or between a carriage return and its newline."""
    tail: list[bytes] = []
    for piece in pieces:
        cut = piece.rfind(b"\n") + 1
        if not cut:
            tail.append(piece)
            continue
        whole = b"".join([*tail, piece[:cut]])
        tail = [piece[cut:]]
        yield _lines(whole[:-1], charset)
    rest = b"".join(tail)
    if rest:
        yield _lines(rest, charset)


def _lines(block: bytes, charset: str) -> pa.Array:
    if b"\r" not in block and charset == "utf-8" and _is_utf8(block):
        # The text is laid out as it has to be already, but for the newlines.
        raw = np.frombuffer(block, np.uint8)
        ends = np.flatnonzero(raw == 10)
        kept = raw[raw != 10]
        offsets = np.empty(len(ends) + 2, np.int32)
        offsets[0], offsets[-1] = 0, len(kept)
        offsets[1:-1] = ends - np.arange(len(ends))
        return pa.Array.from_buffers(pa.string(), len(ends) + 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    lines = split_block(block, charset)
    return pa.array([line[:-1] if line.endswith("\r") else line for line in lines], pa.string())


def _is_utf8(block: bytes) -> bool:
    try:
        return block.isascii() or bool(block.decode())
    except UnicodeDecodeError:
        return False


def z_ingest(files_df: DataFrame, charset: str = "UTF-8", mode: str = "PERMISSIVE") -> DataFrame:
    """Decode ``.Z`` payloads; input columns are ``path`` and ``content``, and
    ``length`` and ``modificationTime`` when known.

    Two kinds of row come out of the one pass: ``kind='line'`` with ``line_no``
    (from 0) and ``line``, and one ``kind='file'`` row per input with ``status``,
    ``n_lines`` and ``n_bytes``.  A payload is checked before it is decoded, so
    a file gives all of its lines or none.  DROPMALFORMED leaves bad files out,
    FAILFAST stops the job.  Lines flow out in batches, a file is never held
    decoded as a whole, and its content goes no further than this stage.
    """
    mode, name = _checked(mode), check_charset(charset)
    name = "utf-8" if name == "ascii" else name
    have = files_df.columns
    source = files_df.select(
        "path",
        (F.col("length") if "length" in have else F.octet_length("content")).cast("bigint").alias("length"),
        (F.col("modificationTime") if "modificationTime" in have else F.lit(None)).cast("timestamp").alias("modificationTime"),
        "content",
    )

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [batch.column(i) for i in range(3)]
            for row in range(batch.num_rows):
                content = batch.column(3)[row]
                payload = memoryview(content.as_buffer()) if content.is_valid else None
                yield from _payload_rows([col[row] for col in facts], payload, name, mode)

    return source.mapInArrow(decode_batches, OUTPUT)


def _payload_rows(file_cols, payload, charset: str, mode: str) -> Iterator[pa.RecordBatch]:
    """Line rows and the file row of one whole payload."""
    status, width, block = ("no_content", None, None) if payload is None else lzw.read_header(payload)
    if status == "ok" and not lzw.is_sound(payload, width, block):
        status = "corrupt"
    n_lines = n_bytes = 0
    if status == "ok":
        pieces = []

        def counted():
            for piece in lzw.decode(payload, width, block):
                pieces.append(len(piece))
                yield piece

        for batch in numbered(file_cols, counted(), charset, 0):
            yield batch
            n_lines += batch.num_rows
        n_bytes = sum(pieces)
    yield from file_row(file_cols, status, n_lines, n_bytes, mode)


def numbered(file_cols, pieces: Iterator[bytes], charset: str, first: int) -> Iterator[pa.RecordBatch]:
    """Line rows of a stream of bytes, the first of them line ``first`` of its file."""
    for lines in _line_blocks(pieces, charset):
        numbers = pa.array(np.arange(first, first + len(lines)))
        yield _rows(file_cols, "line", len(lines), numbers, lines, "ok", None, None)
        first += len(lines)


def file_row(file_cols, status: str, n_lines: int, n_bytes: int, mode: str) -> Iterator[pa.RecordBatch]:
    if status == "ok" or mode == "PERMISSIVE":
        yield _rows(file_cols, "file", 1, None, None, status, n_lines, n_bytes)
    elif mode == "FAILFAST":
        raise ValueError(f"{file_cols[0].as_py()}: {status}")


#: Bytes of a file that one task decodes; what is longer is cut where its table is cleared.
SPLIT_BYTES = 16 << 20

_PARTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
        T.StructField("newlines", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
    ]
)


def z_parts(files_df: DataFrame, split_bytes: int | None = None) -> DataFrame:
    """The parts in which tasks decode ``.Z`` files, as a table.

    ``files_df`` is a stored table of ``path``, ``uri``, ``length`` and
    ``modificationTime``.  A file of up to ``split_bytes`` is one part and is not
    opened.  Longer files are surveyed, a task for each: their codes are checked, and
    they are cut at CLEARs into parts of at least ``split_bytes`` that carry the
    number of newlines before them.  A file with no CLEAR, or one that is not in block
    mode, is one part of any length.  The first part has the file's status and counts.
    """
    split = SPLIT_BYTES if split_bytes is None else split_bytes
    names = [f.name for f in _PARTS]
    facts = files_df.select(*names[:4])
    whole = facts.where(F.col("length") <= split).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _PARTS.fields[4:]]
    )

    def run(batches):
        open_fs = opener()
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{**row, **part} for part in _surveyed(row["path"], row["length"], open_fs, split)],
                    schema=pa.schema([*batch.schema, *_PART_KINDS]),
                )

    long = dealt(facts.where(F.col("length") > split), F.col("length"), split).select(*names[:4]).mapInArrow(run, _PARTS)
    return stage_table(whole.unionByName(long), "z-parts")


_PART_KINDS = [
    *(pa.field(name, pa.int64()) for name in ("start", "stop", "newlines")),
    pa.field("status", pa.string()),
    *(pa.field(name, pa.int64()) for name in ("n_lines", "n_bytes")),
]


def _surveyed(path: str, length: int, open_fs, split: int) -> list[dict]:
    """Parts of one long file; a single one without bytes if it cannot be read."""
    fs, name = open_fs(path)
    lost = {"start": 0, "stop": 0, "newlines": 0, "n_lines": 0, "n_bytes": 0}
    try:
        file = fs.open_input_file(name)
    except FileNotFoundError:
        return [{**lost, "status": "missing"}]
    with file:
        status, width, block = lzw.read_header(file.read_at(lzw.HEADER, 0))
        if status != "ok":
            return [{**lost, "status": status}]
        found = lzw.survey(lzw.Opened(file, length), width, block, split)
    if not found.sound:
        return [{**lost, "status": "corrupt"}]
    head = {"status": "ok", "n_lines": found.n_lines, "n_bytes": found.n_bytes}
    rest = dict.fromkeys(head)
    return [
        {"start": s.start, "stop": s.stop, "newlines": s.newlines, **(rest if i else head)} for i, s in enumerate(found.stretches)
    ]


def z_ingest_files(
    files_df: DataFrame, charset: str = "UTF-8", mode: str = "PERMISSIVE", split_bytes: int | None = None
) -> DataFrame:
    """The rows of ``z_ingest`` for files that tasks open by path, of any name and size.

    ``files_df`` is as for ``z_parts``.  No file is one value: a task reads a short
    file whole, and a part of a longer one a few megabytes at a time, so that one large
    file is decoded by several tasks and none holds more than ``split_bytes`` of it.
    Line numbers are those of the whole file.  Rows carry the ``uri`` as their path; a
    path that is gone gives a file row ``missing``, in any mode.
    """
    mode, name = _checked(mode), check_charset(charset)
    name = "utf-8" if name == "ascii" else name
    split = SPLIT_BYTES if split_bytes is None else split_bytes

    def run(batches):
        open_fs = opener()
        for batch in batches:
            facts = [batch.column(i) for i in (1, 2, 3)]
            for row, part in enumerate(batch.to_pylist()):
                yield from _part_rows([col[row] for col in facts], part, open_fs, name, mode)

    parts = z_parts(files_df, split)
    size = F.coalesce(F.col("stop") - F.col("start"), F.col("length")) + OPEN_BYTES
    return dealt(parts, size, split).select(*_PARTS.names).mapInArrow(run, OUTPUT)


def _part_rows(file_cols, part: dict, open_fs, charset: str, mode: str) -> Iterator[pa.RecordBatch]:
    fs, name = open_fs(part["path"])
    if part["status"] not in (None, "ok"):
        yield from file_row(file_cols, part["status"], 0, 0, "PERMISSIVE" if part["status"] == "missing" else mode)
        return
    try:
        file = fs.open_input_file(name)
    except FileNotFoundError:
        # A part behind the first has no file row.
        if part["start"] in (None, lzw.HEADER):
            yield from file_row(file_cols, "missing", 0, 0, "PERMISSIVE")
        return
    with file:
        if file.size() != part["length"]:
            raise OSError(f"{part['path']} is not as long as it was when it was listed")
        if part["start"] is None:
            yield from _payload_rows(file_cols, memoryview(file.read()), charset, mode)
            return
        _, width, block = lzw.read_header(file.read_at(lzw.HEADER, 0))
        stretch = lzw.Stretch(part["start"], part["stop"], part["newlines"])
        inner = stretch.start > lzw.HEADER
        pieces = lzw.stretch_lines(lzw.Opened(file, part["length"]), width, block, stretch)
        yield from numbered(file_cols, pieces, charset, stretch.newlines + inner)
        if not inner:
            yield from file_row(file_cols, "ok", part["n_lines"], part["n_bytes"], mode)


def _rows(file_cols, kind, count, line_no, line, status, n_lines, n_bytes) -> pa.RecordBatch:
    def same(value, kind):
        return pa.repeat(pa.scalar(value, kind), count)

    path, length, mtime = file_cols
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(path, count),
            pa.repeat(length, count),
            pa.repeat(mtime, count),
            same(kind, pa.string()),
            same(None, pa.int64()) if line_no is None else line_no,
            same(None, pa.string()) if line is None else line,
            same(status, pa.string()),
            same(n_lines, pa.int64()),
            same(n_bytes, pa.int64()),
        ],
        ["path", "length", "modificationTime", "kind", "line_no", "line", "status", "n_lines", "n_bytes"],
    )


def z_lines(ingested: DataFrame) -> DataFrame:
    return ingested.where("kind = 'line'").drop("kind", "status", "n_lines", "n_bytes")


def z_files(ingested: DataFrame) -> DataFrame:
    return ingested.where("kind = 'file'").drop("kind", "line_no", "line")


def z_reject(files_df: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """``path, length, status, max_bits, block_mode`` of each payload without
    decoding it: the header is tested by column expressions, and payloads whose
    header is good have their codes checked against the table size."""
    mode = _checked(mode)
    content = F.col("content")
    flags = F.conv(F.hex(F.substring(content, 3, 1)), 16, 10).cast("int")
    headed = (F.octet_length(content) >= 3) & (F.substring(content, 1, 2) == F.unhex(F.lit("1F9D")))

    @F.arrow_udf("boolean")
    def sound(payloads: pa.Array) -> pa.Array:
        result = []
        for payload in payloads:
            view = memoryview(payload.as_buffer()) if payload.is_valid else None
            result.append(None if view is None else lzw.is_sound(view, *lzw.read_header(view)[1:]))
        return pa.array(result, pa.bool_())

    length = F.col("length") if "length" in files_df.columns else F.octet_length(content)
    tested = files_df.select(
        "path",
        length.cast("bigint").alias("length"),
        content.isNull().alias("__none"),
        F.when(headed, flags.bitwiseAND(lzw.WIDTH_MASK)).alias("max_bits"),
        F.when(headed, flags.bitwiseAND(lzw.BLOCK_FLAG) != 0).alias("block_mode"),
        content,
    )
    in_range = F.col("max_bits").between(lzw.MIN_WIDTH, lzw.MAX_WIDTH)
    status = (
        F.when(F.col("__none"), "no_content")
        .when(F.col("max_bits").isNull(), "bad_magic")
        .when(~in_range, "bad_width")
        .when(F.col("__sound"), "ok")
        .otherwise("corrupt")
    )
    result = tested.withColumn("__sound", sound(F.when(in_range, content))).select(
        "path", "length", status.alias("status"), "max_bits", "block_mode"
    )
    if mode == "DROPMALFORMED":
        return result.where("status = 'ok'")
    if mode == "FAILFAST":
        fail = F.raise_error(F.concat_ws(": ", "path", "status")).cast("string")
        return result.withColumn("status", F.when(F.col("status") == "ok", "ok").otherwise(fail))
    return result
