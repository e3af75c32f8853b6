"""Files that only tasks can read: hidden names, large payloads, parts of one file."""

import bz2
import gzip
import random
import zlib

import pytest
from pyspark.sql import functions as F
from test_jobs import config

from fileload.functions import lzw
from fileload.operators import unz
from fileload.operators.text_files import text_ingest_files
from fileload.operators.unz import z_ingest, z_ingest_files, z_parts
from fileload.plans.load import run_load
from fileload.session import stage_table
from fileload.sources.files import list_files

RANDOM = random.Random(17)


def lines_of(count):
    """Text whose words change every thousand lines, so that encoders clear their table."""
    lines = []
    for at in range(count):
        if at % 1000 == 0:
            words = ["".join(RANDOM.choices("abcdefghijklmnopqrstuvwxyz", k=RANDOM.randrange(3, 9))) for _ in range(60)]
        lines.append(" ".join(RANDOM.choices(words, k=RANDOM.randrange(8))) + "\n")
    return "".join(lines).encode()


@pytest.fixture(scope="module")
def large():
    return lines_of(30_000)


def stored(spark, folder):
    return stage_table(list_files(spark, [str(folder)], hidden=True), "files")


def by_name(rows):
    """Rows by file name, in an order that puts nulls first."""
    found = [(r.path.rsplit("/", 1)[1], r.kind, r.line_no, r.line, r.status, r.n_lines, r.n_bytes) for r in rows.collect()]
    return sorted(found, key=lambda r: (*r[:2], r[2] or 0))


def test_one_large_file_is_decoded_by_several_tasks(spark, tmp_path, large):
    (tmp_path / "large.Z").write_bytes(lzw.encode(large, 12))
    (tmp_path / "small.Z").write_bytes(lzw.encode(b"a\nb"))
    files = stored(spark, tmp_path)
    parts = z_parts(files, 50_000)
    starts = [r.start for r in parts.where("path like '%large.Z'").collect()]
    assert len(starts) > 4 and min(starts) == lzw.HEADER
    rows = z_ingest_files(files, split_bytes=50_000)
    tasks = rows.where("kind = 'line' and path like '%large.Z'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
    # The same rows, whatever the parts, as one value gives.
    whole = z_ingest(spark.read.format("binaryFile").load(str(tmp_path)))
    want = by_name(whole)
    assert by_name(rows) == want == by_name(z_ingest_files(files))
    numbers = [n for name, kind, n, *_ in want if (name, kind) == ("large.Z", "line")]
    assert numbers == list(range(30_000))


def test_lines_longer_than_parts(spark, tmp_path):
    text = b"short\n" + RANDOM.randbytes(400_000).replace(b"\n", b" ") + b"\nend\n" + RANDOM.randbytes(100_000)
    (tmp_path / "x.Z").write_bytes(lzw.encode(text, 12))
    files = stored(spark, tmp_path)
    assert z_parts(files, 20_000).count() > 5
    assert by_name(z_ingest_files(files, "latin-1", split_bytes=20_000)) == by_name(z_ingest_files(files, "latin-1"))


def test_bad_files_by_path(spark, tmp_path, large):
    good = lzw.encode(large, 12)
    (tmp_path / "cut_codes.Z").write_bytes(good[:3] + b"\xff" * 90_000)
    (tmp_path / "magic.Z").write_bytes(b"\x1f\x9e\x90" + good)
    (tmp_path / "width.Z").write_bytes(b"\x1f\x9d\x91" + good)
    (tmp_path / "gone.Z").write_bytes(good)
    (tmp_path / "none.Z").write_bytes(b"")
    files = stored(spark, tmp_path)
    (tmp_path / "gone.Z").unlink()
    want = {"cut_codes.Z": "corrupt", "magic.Z": "bad_magic", "width.Z": "bad_width", "gone.Z": "missing", "none.Z": "bad_magic"}
    for split in (10_000, 1 << 30):
        assert {r.path.rsplit("/", 1)[1]: (r.kind, r.status) for r in z_ingest_files(files, split_bytes=split).collect()} == {
            name: ("file", status) for name, status in want.items()
        }
        dropped = z_ingest_files(files, mode="DROPMALFORMED", split_bytes=split).collect()
        assert [(r.status, r.kind) for r in dropped] == [("missing", "file")]
        with pytest.raises(Exception, match="bad_|corrupt"):
            z_ingest_files(files, mode="FAILFAST", split_bytes=split).collect()


def test_a_file_that_changed_is_an_error(spark, tmp_path, large):
    (tmp_path / "x.Z").write_bytes(lzw.encode(large, 12))
    files = stored(spark, tmp_path)
    (tmp_path / "x.Z").write_bytes(lzw.encode(large, 12)[:-9])
    for split in (10_000, 1 << 30):
        with pytest.raises(Exception, match="as long as|ends"):
            z_ingest_files(files, split_bytes=split).collect()


def test_no_file(spark):
    none = spark.createDataFrame([], "path string, uri string, length bigint, modificationTime timestamp")
    assert z_ingest_files(none).collect() == [] == text_ingest_files(none).collect()


def test_a_job_loads_large_and_hidden_files(spark, tmp_path, monkeypatch):
    """A payload beyond the limit of one value, in parts, and names scans leave out."""
    lines = b"".join(b"%s|%d\n" % (line, i) for i, line in enumerate(lines_of(20_000).splitlines()))
    place = tmp_path / "in"
    place.mkdir()
    (place / "large.Z").write_bytes(lzw.encode(lines, 12))
    (place / "_hidden.Z").write_bytes(lzw.encode(b"h|1\n"))
    (place / ".dotted.txt").write_text("d|2\n")
    (place / "_packed.gz").write_bytes(gzip.compress(b"g|3\n"))
    (place / "_broken.gz").write_bytes(gzip.compress(b"g|4\n" * 1000)[:40])
    (place / "_odd.snappy").write_bytes(b"x")
    (place / "seen.txt").write_text("s|5\n")
    (tmp_path / "manifest").write_text("".join(f"{p}:t\n" for p in sorted(place.iterdir())))
    monkeypatch.setattr(unz, "SPLIT_BYTES", 20_000)
    with_limit = spark.newSession()
    with_limit.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    result = run_load(with_limit, config(tmp_path, max_file_size=1 << 40), str(tmp_path / "manifest"))
    loaded = {r.src_path.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in result.audit().collect()}
    assert loaded == {
        "large.Z": ("ok", 20_000),
        "_hidden.Z": ("ok", 1),
        ".dotted.txt": ("ok", 1),
        "_packed.gz": ("ok", 1),
        "_broken.gz": ("corrupt", loaded["_broken.gz"][1]),
        "_odd.snappy": ("hidden", 0),
        "seen.txt": ("ok", 1),
    }
    rows = result.detail().where("src_path like '%large.Z'")
    assert rows.where("v <> line_no").count() == 0
    # Handled files are in the ledger under the names scans report.
    again = run_load(with_limit, config(tmp_path, "j2", max_file_size=1 << 40), str(tmp_path / "manifest"))
    assert again.detail().count() == 0


def test_text_codecs_by_path(spark, tmp_path):
    text = "a\r\n\n汉字\nlast".encode()
    (tmp_path / "_plain").write_bytes(text)
    (tmp_path / "_two.gz").write_bytes(gzip.compress(text[:4]) + gzip.compress(text[4:]))
    (tmp_path / "_two.bz2").write_bytes(bz2.compress(text[:4]) + bz2.compress(text[4:]))
    (tmp_path / "_z.deflate").write_bytes(zlib.compress(text))
    (tmp_path / "_none").write_bytes(b"")
    rows = by_name(text_ingest_files(stored(spark, tmp_path)))
    for name in ("_plain", "_two.gz", "_two.bz2", "_z.deflate"):
        mine = [r for r in rows if r[0] == name]
        assert [r[2:4] for r in mine if r[1] == "line"] == [(0, "a"), (1, ""), (2, "汉字"), (3, "last")]
        assert [r[4:] for r in mine if r[1] == "file"] == [("ok", 4, len(text))]
    assert [r for r in rows if r[0] == "_none"] == [("_none", "file", None, None, "ok", 0, 0)]
