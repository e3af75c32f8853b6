"""Lines of text files that tasks open by path: names Spark's sources never read."""

from __future__ import annotations

import bz2
import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileload.functions.paths import opener
from fileload.functions.text import check_charset
from fileload.operators.unz import OUTPUT, file_row, numbered
from fileload.sources.bypath import GROUP_BYTES, OPEN_BYTES, dealt

PIECE = 4 << 20
#: Suffixes of codecs that only Spark's own scan can read.
SCAN_ONLY = (".snappy", ".lz4", ".zst")


def task_can_read(path: Column) -> Column:
    """Whether the name's codec is one that tasks can undo."""
    return ~F.greatest(*[path.endswith(suffix) for suffix in SCAN_ONLY])


def _inflated(stream) -> Iterator[bytes]:
    undo = zlib.decompressobj()
    while raw := stream.read(PIECE):
        while raw:
            yield undo.decompress(raw, PIECE)
            raw = undo.unconsumed_tail
    yield undo.flush()


def _pieces(path: str, stream) -> Iterator[bytes]:
    """Undone bytes of a file, some megabytes at a time."""
    if path.endswith(".deflate"):
        yield from _inflated(stream)
        return
    if path.endswith(".gz"):
        stream = gzip.GzipFile(fileobj=stream)
    elif path.endswith(".bz2"):
        stream = bz2.BZ2File(stream)
    while piece := stream.read(PIECE):
        yield piece


def text_ingest_files(files_df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Rows as ``z_ingest_files`` gives them, for text files, plain or ``.gz``,
    ``.bz2`` or ``.deflate``: numbered lines, and a file row with their count.
    ``files_df`` is a stored table of ``path``, ``uri``, ``length`` and
    ``modificationTime``.  A file that breaks off is ``corrupt`` and keeps the lines
    up to there."""
    name = check_charset(charset)
    name = "utf-8" if name == "ascii" else name
    names = ["path", "uri", "length", "modificationTime"]

    def run(batches):
        open_fs = opener()
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _file_rows(batch.column(0)[row].as_py(), [batch.column(i)[row] for i in (1, 2, 3)], open_fs, name)

    return dealt(files_df.select(*names), F.col("length") + OPEN_BYTES, GROUP_BYTES).select(*names).mapInArrow(run, OUTPUT)


def _file_rows(path: str, file_cols, open_fs, charset: str) -> Iterator[pa.RecordBatch]:
    fs, name = open_fs(path)
    try:
        stream = fs.open_input_stream(name, compression=None)
    except FileNotFoundError:
        yield from file_row(file_cols, "missing", 0, 0, "PERMISSIVE")
        return
    status, sizes, n_lines = "ok", [], 0

    def counted():
        nonlocal status
        try:
            for piece in _pieces(path, stream):
                sizes.append(len(piece))
                yield piece
        except (EOFError, zlib.error, gzip.BadGzipFile, OSError) as error:
            if isinstance(error, OSError) and not isinstance(error, gzip.BadGzipFile) and error.errno is not None:
                raise
            status = "corrupt"

    with stream:
        for batch in numbered(file_cols, counted(), charset, 0):
            yield batch
            n_lines += batch.num_rows
    yield from file_row(file_cols, status, n_lines, sum(sizes), "PERMISSIVE")
