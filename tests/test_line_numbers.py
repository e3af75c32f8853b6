"""Dense line numbers of text files that scans read in several blocks."""

import bz2
import random

import pytest
from pyspark.sql import functions as F
from test_jobs import config

from fileload.operators import line_numbers
from fileload.operators.line_numbers import BLOCK
from fileload.operators.records import RecordSpec, fields, register_record
from fileload.plans.load import run_load
from fileload.streaming.ingest import stream_detail, stream_ingest

register_record("numbered", RecordSpec(fields(k="string", v="long"), charset="GBK"))

COUNT = 12_000
RANDOM = random.Random(29)


@pytest.fixture
def split_files(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    text = "".join(f"億{RANDOM.randbytes(30).hex()}|{i}\n" for i in range(COUNT)).encode("gbk")
    (place / "plain.txt").write_bytes(text)
    # Blocks of 100 kB, so that a scan can cut the file.
    (place / "packed.bz2").write_bytes(bz2.compress(text, 1))
    for i in range(5):
        (place / f"small{i}.txt").write_bytes(b"a|0\nb|1")
    (tmp_path / "manifest").write_text("".join(f"{p}:t\n" for p in sorted(place.iterdir())))
    conf = {"spark.sql.files.maxPartitionBytes": "60000", "spark.sql.files.openCostInBytes": "1000"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield tmp_path
    for key in conf:
        spark.conf.unset(key)


def check(rows):
    counts = {r.src_path.rsplit("/", 1)[1]: r["count"] for r in rows.groupBy("src_path").count().collect()}
    assert counts == {"plain.txt": COUNT, "packed.bz2": COUNT, **{f"small{i}.txt": 2 for i in range(5)}}
    # Every record holds its own line's number.
    assert rows.where("line_no <> v OR line_no IS NULL").count() == 0
    assert not {"block", "block_row"} & set(rows.columns)


@pytest.mark.parametrize("most", [500_000, 1])
def test_numbers_in_a_job(spark, split_files, monkeypatch, most):
    monkeypatch.setattr(line_numbers, "BROADCAST_BLOCKS", most)
    cfg = config(split_files, record_type="numbered", max_file_size=1 << 40)
    result = run_load(spark, cfg, str(split_files / "manifest"), wave_files=3)
    blocks = result.written().where(F.col(BLOCK).isNotNull()).groupBy("src_path").agg(F.count_distinct(BLOCK).alias("n"))
    by_name = {r.src_path.rsplit("/", 1)[1]: r.n for r in blocks.collect()}
    assert by_name["plain.txt"] > 4 and by_name["packed.bz2"] > 1
    check(result.detail())
    check(run_load(spark, cfg, str(split_files / "manifest"), wave_files=3).detail())


def test_numbers_in_a_stream(spark, split_files):
    detail, checkpoint = str(split_files / "detail"), str(split_files / "checkpoint")
    stream_ingest(
        spark, str(split_files / "in"), "numbered", detail, checkpoint, "s1", max_file_size=1 << 40, maxFilesPerTrigger=3
    ).awaitTermination()
    check(stream_detail(spark, detail, "s1"))
