import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fileload.config import LoadConfig
from fileload.functions import lzw
from fileload.operators.records import RecordSpec, fields, register_record
from fileload.plans import load
from fileload.plans.load import run_load
from fileload.sinks.keyed_table import KeyedTable
from fileload.streaming.ingest import stream_detail, stream_files, stream_ingest, stream_load

register_record("pairs", RecordSpec(fields(k="string", v="long")))
register_record("pairs_gbk", RecordSpec(fields(k="string", v="long"), charset="GBK"))


@pytest.fixture
def place(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "plain.txt").write_text("a|1\nb|2\nbroken\n")
    (src / "packed.Z").write_bytes(lzw.encode(b"c|3\nd|x\n"))
    (src / "corrupt.Z").write_bytes(b"\x1f\x9d\x90" + b"\xff" * 40)
    (src / "empty.txt").write_text("")
    (src / "empty.Z").write_bytes(b"")
    (src / "big.txt").write_text("z|9\n" * 1000)
    names = ["plain.txt", "packed.Z", "corrupt.Z", "empty.txt", "empty.Z", "big.txt", "absent.txt", "plain.txt"]
    (tmp_path / "manifest").write_text("\n".join(f"{src}/{name}:tag" for name in names) + "\n\n")
    return tmp_path


def config(place, job_id="j1", **kwargs):
    settings = dict(
        record_type="pairs",
        max_file_size=1000,
        job_id=job_id,
        detail_path=str(place / "detail"),
        ledger_path=str(place / "ledger"),
        oversize_path=str(place / "oversize"),
        layout=("path", "tag"),
    )
    return LoadConfig(**{**settings, **kwargs})


def rows(result):
    return sorted((r.src_path.rsplit("/", 1)[1], r.k, r.v, r._bad) for r in result.detail().collect())


WANT = [
    ("packed.Z", "c", 3, None),
    ("packed.Z", "d", None, "d|x"),
    ("plain.txt", "a", 1, None),
    ("plain.txt", "b", 2, None),
    ("plain.txt", "broken", None, "broken"),
]


def audit(result):
    return {
        r.src_path.rsplit("/", 1)[1]: (r.status, r.n_rows, r.n_bad) for r in result.audit().collect()
    }


STATUS = {
    "plain.txt": ("ok", 3, 1),
    "packed.Z": ("ok", 2, 1),
    "corrupt.Z": ("corrupt", 0, 0),
    "empty.txt": ("ok", 0, 0),
    "empty.Z": ("bad_magic", 0, 0),
    "big.txt": ("oversize", 0, 0),
    "absent.txt": ("missing", 0, 0),
}


@pytest.mark.parametrize("wave_files", [200_000, 4])
def test_run_load(spark, place, wave_files):
    result = run_load(spark, config(place), str(place / "manifest"), wave_files)
    assert sorted(rows(result), key=str) == sorted(WANT, key=str)
    assert audit(result) == STATUS
    files = {r.src_path.rsplit("/", 1)[1]: r for r in result.files().collect()}
    assert (files["packed.Z"].n_lines, files["packed.Z"].n_bytes) == (2, 8)
    left = [r.value for r in spark.read.text(str(place / "oversize")).collect()]
    assert left == [f"{place}/in/big.txt:tag"]
    waves = {name for name in os.listdir(place / "ledger" / "job_id=j1") if name.startswith("wave=")}
    assert len(waves) == 1 if wave_files > 4 else len(waves) > 1


def test_run_load_into_files_of_bounded_bytes(spark, place):
    """The shuffle that sizes files changes neither rows, numbers of lines nor sums."""
    most = 64 << 10
    lines = [f"{os.urandom(40).hex()}|{i}" for i in range(8000)]
    (place / "in" / "plain.txt").write_text("\n".join(lines) + "\n")
    (place / "in" / "packed.Z").write_bytes(lzw.encode(("\n".join(lines[:3000]) + "\n").encode()))
    result = run_load(spark, config(place, max_file_size=1 << 30, max_bytes_per_file=most), str(place / "manifest"))
    sizes = [p.stat().st_size for p in (place / "detail").rglob("kind=line/*.parquet")]
    assert max(sizes) <= 1.2 * most and len(sizes) < 100
    for name, n in (("plain.txt", 8000), ("packed.Z", 3000)):
        got = result.detail().where(F.col("src_path").endswith(name)).select("line_no", "k", "v").collect()
        assert sorted((r.line_no, f"{r.k}|{r.v}") for r in got) == list(enumerate(lines[:n]))
    assert result.altered().count() == 0


@pytest.mark.parametrize("what", ["value", "exchanged", "lost", "nothing"])
def test_altered_rows_are_reported(spark, place, what):
    """Counts of an altered table may be right; its content is not."""
    result = run_load(spark, config(place), str(place / "manifest"))
    assert result.altered().count() == 0
    parts = {p.parent.parent.name: p for p in (place / "detail").rglob("kind=line/*.parquet")}
    text, packed = parts["codec=text"], parts["codec=z-path"]

    def change(path, row, **values):
        table = pq.read_table(path, partitioning=None)
        rows = table.to_pylist()
        rows[row].update(values)
        rows = rows if what != "lost" else rows[1:]
        path.with_name(f".{path.name}.crc").unlink()
        pq.write_table(pa.Table.from_pylist(rows, table.schema), path)

    if what in ("value", "lost"):
        change(text, 0, v=77)
    elif what == "exchanged":
        # One row's file name and another's: every count is as it was.
        first = pq.read_table(packed, partitioning=None).to_pylist()[0]["src_path"]
        second = pq.read_table(text, partitioning=None).to_pylist()[0]["src_path"]
        change(text, 0, src_path=first)
        change(packed, 0, src_path=second)
    found = {r.codec: (r.n_rows, r.n_stored) for r in result.altered().collect()}
    assert found == {
        "value": {"text": (3, 3)},
        "exchanged": {"text": (3, 3), "z-path": (2, 2)},
        "lost": {"text": (3, 2)},
        "nothing": {},
    }[what]
    if what == "exchanged":
        assert audit(result) == STATUS


def test_same_job_again_changes_nothing(spark, place):
    first = run_load(spark, config(place), str(place / "manifest"), 4)
    before = {p: p.stat().st_mtime_ns for p in (place / "detail").rglob("*.parquet")}
    again = run_load(spark, config(place), str(place / "manifest"), 4)
    assert {p: p.stat().st_mtime_ns for p in (place / "detail").rglob("*.parquet")} == before
    assert rows(first) == rows(again) and audit(again) == STATUS


def test_crash_before_the_ledger_entry(spark, place, monkeypatch):
    calls = []

    def fails(*args):
        calls.append(args)
        raise OSError("lost")

    monkeypatch.setattr(load, "commit", fails)
    with pytest.raises(OSError):
        run_load(spark, config(place), str(place / "manifest"))
    monkeypatch.undo()
    assert calls and (place / "detail").exists()
    result = run_load(spark, config(place), str(place / "manifest"))
    assert sorted(rows(result), key=str) == sorted(WANT, key=str) and audit(result) == STATUS


def test_file_deleted_between_plan_and_load(spark, place, monkeypatch):
    plan = load.make_plan

    def plan_then_lose(*args):
        plan(*args)
        os.unlink(place / "in" / "packed.Z")

    monkeypatch.setattr(load, "make_plan", plan_then_lose)
    result = run_load(spark, config(place), str(place / "manifest"))
    assert audit(result) == {**STATUS, "packed.Z": ("missing", 0, 0)}
    monkeypatch.undo()
    # it comes back with the same times: not in the ledger, so it is loaded
    (place / "in" / "packed.Z").write_bytes(lzw.encode(b"c|3\nd|x\n"))
    again = run_load(spark, config(place, "j2"), str(place / "manifest"))
    assert {r[0] for r in rows(again)} == {"packed.Z"}


def test_later_job_loads_only_what_is_new(spark, place):
    run_load(spark, config(place), str(place / "manifest"))
    (place / "in" / "new.txt").write_text("n|5\n")
    (place / "in" / "packed.Z").write_bytes(lzw.encode(b"c|30\nlonger|31\n"))
    with open(place / "manifest", "a") as out:
        out.write(f"{place}/in/new.txt:tag\n")
    result = run_load(spark, config(place, "j2"), str(place / "manifest"))
    assert {r[1:3] for r in rows(result)} == {("n", 5), ("c", 30), ("longer", 31)}
    assert audit(result)["plain.txt"][0] == "already_loaded"
    # the oversize list is a manifest for a job with a higher limit
    big = run_load(spark, config(place, "j3", max_file_size=1 << 30), str(place / "oversize" / "job_id=j1"))
    assert big.detail().count() == 1000


def test_nothing_to_load(spark, place):
    (place / "manifest").write_text("/no/such/file:x\n")
    result = run_load(spark, config(place), str(place / "manifest"))
    assert result.detail().count() == 0 and audit(result) == {"file": ("missing", 0, 0)}


def test_modes(spark, place):
    with pytest.raises(FileNotFoundError):
        run_load(spark, config(place, mode="FAILFAST"), str(place / "manifest"))
    result = run_load(spark, config(place, "j2", mode="DROPMALFORMED"), str(place / "manifest"))
    assert audit(result)["corrupt.Z"] == ("corrupt", 0, 0) and sorted(rows(result), key=str) == sorted(WANT, key=str)


def test_gbk(spark, place):
    (place / "in" / "g.txt").write_bytes("億x|1\n".encode("gbk"))
    (place / "in" / "g.Z").write_bytes(lzw.encode("汉|2\n億x|3".encode("gbk")))
    (place / "manifest").write_text(f"{place}/in/g.txt\n{place}/in/g.Z\n")
    # 0x7C is the second byte of the first character: text is decoded before fields are split
    result = run_load(spark, config(place, record_type="pairs_gbk"), str(place / "manifest"))
    assert sorted((r.k, r.v) for r in result.detail().collect()) == sorted([("億x", 1), ("汉", 2), ("億x", 3)])


def test_config():
    settings = {"concreteRecordName": "pairs", "maxFileSize": "10", "detailOutputPath": "/d"}
    made = LoadConfig.from_settings(settings, job_id="j", ledger_path="/l")
    assert (made.max_file_size, made.detail_path, made.oversize_path, made.archive_path) == (10, "/d", None, None)
    for bad in ({"maxFileSize": "x"}, {"maxFileSize": None}, {"maxFileSize": " 1"}):
        with pytest.raises(ValueError):
            LoadConfig.from_settings({**settings, **bad}, job_id="j", ledger_path="/l")
    with pytest.raises(KeyError):
        LoadConfig.from_settings({**settings, "concreteRecordName": "nonesuch"}, job_id="j", ledger_path="/l")
    with pytest.raises(KeyError):
        LoadConfig.from_settings({"maxFileSize": "1", "detailOutputPath": "/d"}, job_id="j", ledger_path="/l")
    with pytest.raises(ValueError):
        LoadConfig.from_settings(settings, job_id="20240101", ledger_path="/l")


def test_rows_against_the_manifest(spark, place):
    whole = lzw.encode(b"key|1\n" * 500)
    (place / "in" / "whole.Z").write_bytes(whole)
    (place / "in" / "cut.Z").write_bytes(whole[: len(whole) // 2])
    lines = [f"{place}/in/{name}:{count}" for name, count in (("whole.Z", 500), ("cut.Z", 500), ("plain.txt", "?"))]
    (place / "manifest").write_text("\n".join(lines))
    result = run_load(spark, config(place), str(place / "manifest"))
    row = result.miscounted("tag").first()
    assert result.miscounted("tag").count() == 1 and row.src_path.endswith("cut.Z")
    assert 0 < row.n_rows < row.n_expected == 500 and row.status == "ok"


def test_reserved_names(place):
    register_record("clash", RecordSpec(fields(status="string")))
    with pytest.raises(ValueError, match="status"):
        config(place, record_type="clash")


def test_only_bad_files_dropped(spark, place):
    (place / "manifest").write_text(f"{place}/in/corrupt.Z\n")
    result = run_load(spark, config(place, mode="DROPMALFORMED"), str(place / "manifest"))
    assert result.detail().count() == 0 and audit(result) == {"corrupt.Z": ("corrupt", 0, 0)}


def test_failfast_on_an_empty_z(spark, place):
    (place / "manifest").write_text(f"{place}/in/empty.Z\n")
    with pytest.raises(ValueError, match="bad_magic"):
        run_load(spark, config(place, mode="FAILFAST"), str(place / "manifest"))


def test_job_id_belongs_to_one_manifest(spark, place):
    run_load(spark, config(place), str(place / "manifest"))
    with pytest.raises(ValueError, match="other settings"):
        run_load(spark, config(place, max_file_size=5), str(place / "manifest"))
    (place / "other").write_text(f"{place}/in/big.txt:tag\n")
    with pytest.raises(ValueError, match="another manifest"):
        run_load(spark, config(place), str(place / "other"))
    with pytest.raises(ValueError, match="incremental"):
        run_load(spark, config(place, "j9", archive_path="/x"), str(place / "manifest"))


def test_only_files_read_are_counted(spark, place):
    (place / "manifest").write_text(f"{place}/in/plain.txt:3\n{place}/in/absent.txt:5\n{place}/in/big.txt:1000\n")
    assert run_load(spark, config(place), str(place / "manifest")).miscounted("tag").count() == 0
    assert run_load(spark, config(place, "j2"), str(place / "manifest")).miscounted("tag").count() == 0


def stream(spark, place, **kwargs):
    query = stream_ingest(
        spark, str(place / "in"), "pairs", str(place / "detail"), str(place / "checkpoint"), "s1", **kwargs
    )
    query.awaitTermination()
    rows = stream_detail(spark, str(place / "detail"), "s1").collect()
    return sorted(((r.src_path.rsplit("/", 1)[1], r.k, r.v) for r in rows), key=str)


def test_stream_of_text(spark, place):
    os.unlink(place / "in" / "big.txt")
    want = [("plain.txt", "a", 1), ("plain.txt", "b", 2), ("plain.txt", "broken", None)]
    assert stream(spark, place, maxFilesPerTrigger=1) == want
    assert stream(spark, place) == want
    (place / "in" / "more.txt").write_text("e|5\r\n")
    assert stream(spark, place) == [("more.txt", "e", 5), *want]


def test_stream_of_z(spark, place):
    assert stream(spark, place, codec="z") == [("packed.Z", "c", 3), ("packed.Z", "d", None)]
    assert stream_status(spark, place) == {"packed.Z": "ok", "corrupt.Z": "corrupt"}


def test_stream_with_the_settings_of_a_batch_job(spark, place):
    stream_load(spark, config(place, "s1"), str(place / "in"), str(place / "checkpoint")).awaitTermination()
    assert stream_detail(spark, str(place / "detail"), "s1").count() == 3
    assert stream_status(spark, place) == {"big.txt": "oversize"}


def stream_status(spark, place):
    rows = stream_files(spark, str(place / "detail"), "s1").collect()
    assert len(rows) == len({r.src_path for r in rows})
    return {r.src_path.rsplit("/", 1)[1]: r.status for r in rows}


def test_stream_size_limit_on_z(spark, place):
    (place / "in" / "long.Z").write_bytes(lzw.encode(os.urandom(3000)))
    assert {name for name, _, _ in stream(spark, place, codec="z", max_file_size=1000)} == {"packed.Z"}
    assert stream_status(spark, place) == {"packed.Z": "ok", "corrupt.Z": "corrupt", "long.Z": "oversize"}


def test_oversize_is_not_malformed(spark, place):
    os.unlink(place / "in" / "corrupt.Z")
    os.unlink(place / "in" / "empty.Z")
    (place / "in" / "long.Z").write_bytes(lzw.encode(os.urandom(3000)))
    assert len(stream(spark, place, codec="z", max_file_size=1000, mode="FAILFAST")) == 2
    assert stream_status(spark, place) == {"packed.Z": "ok", "long.Z": "oversize"}


def test_stream_size_limit(spark, place):
    assert {name for name, _, _ in stream(spark, place, max_file_size=1000)} == {"plain.txt"}
    assert stream_status(spark, place) == {"big.txt": "oversize"}
    with pytest.raises(ValueError):
        stream(spark, place, codec="other")


def test_stream_archives_inputs(spark, place):
    os.unlink(place / "in" / "big.txt")
    archive = place / "archive"
    stream(spark, place, archive_path=str(archive))
    for n in range(2):
        (place / "in" / f"later{n}.txt").write_text(f"f|{n}\n")
        got = stream(spark, place, archive_path=str(archive))
    assert ("later1.txt", "f", 1) in got and len(got) == 5
    assert "plain.txt" in {p.name for p in archive.rglob("*.txt")}
    assert not (place / "in" / "plain.txt").exists()


def test_stream_into_a_keyed_table(spark, place):
    os.unlink(place / "in" / "big.txt")
    os.unlink(place / "in" / "plain.txt")
    table = KeyedTable(spark, str(place / "cells"))
    keyed = dict(key="k", version="src_mtime", columns=["v"], ties=["src_path"])
    for n in range(2):
        (place / "in" / f"n{n}.txt").write_text(f"a|{n}\nb{n}|{n}\n")
        os.utime(place / "in" / f"n{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
        stream(spark, place, keyed=keyed, table=table)
    assert {(r.row_key, r.value) for r in table.cells().collect()} == {("a", 1), ("b0", 0), ("b1", 1)}


def test_broken_lines_are_no_cells(spark, place):
    for name in ("big.txt", "plain.txt"):
        os.unlink(place / "in" / name)
    (place / "in" / "n.txt").write_text("a|1\noops|20|more\n|7\nc|x\n")
    table = KeyedTable(spark, str(place / "cells"))
    stream(spark, place, keyed=dict(key="k", version="src_mtime", columns=["v"]), table=table)
    assert [(r.row_key, r.value) for r in table.cells().collect()] == [("a", 1)]
