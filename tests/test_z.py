import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fileload.functions import lzw
from fileload.operators import unz
from fileload.operators.unz import z_files, z_ingest, z_lines, z_reject
from fileload.operators.zpack import z_export
from fileload.sinks.zfiles import write_z_files

BAD = {
    "short": (b"\x1f\x9d", "bad_magic"),
    "zero": (b"", "bad_magic"),
    "magic": (b"\x1f\x8b\x90abc", "bad_magic"),
    "narrow": (b"\x1f\x9d\x88abc", "bad_width"),
    "wide": (b"\x1f\x9d\x91abc", "bad_width"),
    "corrupt": (b"\x1f\x9d\x90" + b"\xff" * 40, "corrupt"),
    "absent": (None, "no_content"),
}
GOOD = {"lines": b"a\r\nb\n\nc", "empty": b"", "newline": b"\n", "ended": b"x\ny\n"}


@pytest.fixture
def payloads(spark):
    rows = [(name, lzw.encode(text)) for name, text in GOOD.items()]
    rows += [(name, None if data is None else bytearray(data)) for name, (data, _) in BAD.items()]
    return spark.createDataFrame(rows, "path string, content binary")


def test_z_ingest(payloads):
    out = z_ingest(payloads).cache()
    lines = {}
    for row in z_lines(out).orderBy("path", "line_no").collect():
        lines.setdefault(row.path, []).append(row.line)
    assert lines == {"lines": ["a", "b", "", "c"], "newline": [""], "ended": ["x", "y"]}
    files = {r.path: (r.status, r.n_lines, r.n_bytes) for r in z_files(out).collect()}
    want = {name: ("ok", len(lines.get(name, [])), len(text)) for name, text in GOOD.items()}
    want |= {name: (status, 0, 0) for name, (_, status) in BAD.items()}
    assert files == want
    out.unpersist()


def test_z_reject(payloads):
    rows = {r.path: r for r in z_reject(payloads).collect()}
    assert {name: row.status for name, row in rows.items()} == {
        **{name: "ok" for name in GOOD},
        **{name: status for name, (_, status) in BAD.items()},
    }
    assert (rows["wide"].max_bits, rows["wide"].block_mode) == (17, True)
    assert (rows["lines"].max_bits, rows["lines"].block_mode) == (16, True)
    assert rows["magic"].max_bits is None


@pytest.mark.parametrize("read", [z_ingest, z_reject])
def test_modes(spark, payloads, read):
    assert {r.path for r in read(payloads, mode="DROPMALFORMED").collect()} == set(GOOD)
    with pytest.raises(Exception, match="bad_magic|bad_width|corrupt|no_content"):
        read(payloads, mode="FAILFAST").collect()
    good = payloads.where(F.col("path").isin(list(GOOD)))
    assert read(good, mode="failfast").count() > 0
    with pytest.raises(ValueError):
        read(payloads, mode="other")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("charset", ["utf-8", "gbk"])
def test_pieces_may_end_anywhere(size, charset):
    text = "汉字億|é\r\nline\n\n\r\nlast 億" if charset == "gbk" else "汉字é\r\n\U0001f600 line\n\n\r\nlast"
    raw = text.encode(charset, "replace")
    pieces = [raw[i : i + size] for i in range(0, len(raw), size)]
    lines = [line for block in unz._line_blocks(iter(pieces), charset) for line in block.to_pylist()]
    assert lines == raw.decode(charset).replace("\r\n", "\n").split("\n")


@pytest.mark.parametrize(
    "block", ["one", "a\nb", "\n", "\n\nx\n", "汉字\n\U0001f600\n", "ends in cr\r\nb", "x" * 5000 + "\n" + "y" * 5000]
)
def test_lines_of_a_block(block):
    lines = unz._lines(block.encode(), "utf-8")
    lines.validate(full=True)
    assert lines.to_pylist() == [line.removesuffix("\r") for line in block.split("\n")]


def test_bad_bytes_and_charset(spark):
    df = spark.createDataFrame([("f", lzw.encode("億|x\n".encode("gbk") + b"\xff\n"))], "path string, content binary")
    lines = [r.line for r in z_lines(z_ingest(df, "GBK")).orderBy("line_no").collect()]
    assert lines[0] == "億|x" and "\ufffd" in lines[1]


def test_file_columns_pass_through(spark, tmp_path):
    (tmp_path / "a.Z").write_bytes(lzw.encode(b"x\n"))
    os.utime(tmp_path / "a.Z", (1_600_000_000, 1_600_000_000))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Shanghai"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = z_ingest(files).where("kind = 'line'").select("length", F.unix_seconds("modificationTime").alias("t")).first()
        assert (row.length, row.t) == ((tmp_path / "a.Z").stat().st_size, 1_600_000_000)
    spark.conf.set("spark.sql.session.timeZone", before)


def read_back(packed):
    files = packed.select(F.concat_ws("/", "shard", F.format_string("%020d", "part")).alias("path"), "content")
    lines = {}
    for row in z_lines(z_ingest(files)).orderBy("path", "line_no").collect():
        lines.setdefault(row.path.rsplit("/", 1)[0], []).append(row.line)
    return lines


@pytest.fixture(scope="module")
def skewed(spark):
    # nine in ten rows are of one shard
    shard = F.when(F.col("id") % 10 == 0, F.concat(F.lit("s"), F.col("id") % 3)).otherwise("hot")
    return spark.range(5000).select("id", shard.alias("shard"), F.concat(F.lit("row "), "id").alias("line"))


def test_z_export_in_order(skewed):
    want = {}
    for row in skewed.orderBy("id").collect():
        want.setdefault(row.shard, []).append(row.line)
    packed = z_export(skewed.repartition(5), "shard", "line", "id", part_bytes=10_000)
    assert read_back(packed) == want
    parts = Counter(r.shard for r in packed.select("shard").collect())
    assert parts["hot"] >= 4
    totals = packed.groupBy("shard").agg(F.sum("n_lines").alias("lines"), F.sum("n_bytes").alias("bytes")).collect()
    assert {r.shard: (r.lines, r.bytes) for r in totals} == {
        name: (len(lines), sum(len(line) + 1 for line in lines)) for name, lines in want.items()
    }


def test_hot_shard_is_spread_over_tasks(skewed):
    packed = z_export(skewed, "shard", "line", "id", num_partitions=8)
    tasks = {r.part >> 32 for r in packed.where("shard = 'hot'").collect()}
    assert len(tasks) >= 6


def test_copies_are_spread_over_tasks(spark):
    rows = spark.range(8000, numPartitions=4).select(F.lit("s").alias("shard"), F.lit(1).alias("n"), F.lit("copy").alias("line"))
    packed = z_export(rows, "shard", "line", "n", num_partitions=8)
    assert len({r.part >> 32 for r in packed.collect()}) >= 6
    assert packed.agg(F.sum("n_lines")).first()[0] == 8000


def test_z_export_without_order_shuffles_nothing(skewed):
    packed = z_export(skewed, "shard", "line", part_bytes=5_000)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    got = read_back(packed)
    assert Counter(line for lines in got.values() for line in lines) == Counter(r.line for r in skewed.collect())


def test_z_export_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, "a", 1), ("s", None, 2)], "shard string, line string, n int")
    rows = {r.shard: (r.n_lines, r.n_bytes) for r in z_export(df, "shard", "line", ["n"]).collect()}
    assert rows == {None: (1, 2), "s": (1, 1)}
    assert z_export(df.limit(0), "shard", "line", "n").count() == 0


def test_written_files(spark, skewed, tmp_path):
    folder = str(tmp_path / "out")
    odd = skewed.withColumn("shard", F.concat("shard", F.lit("/ä =1")))
    write_z_files(z_export(odd, "shard", "line", "id", part_bytes=20_000), folder)
    assert not [name for name in os.listdir(folder) if name.startswith("_")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    assert z_lines(z_ingest(files)).count() == 5000
    with pytest.raises(FileExistsError):
        write_z_files(z_export(odd, "shard", "line"), folder)


def test_failed_export_leaves_nothing(spark, skewed, tmp_path):
    folder = str(tmp_path / "out")
    payload = z_export(skewed, "shard", "line", "id").withColumn(
        "content", F.when(F.col("shard") == "s1", F.raise_error(F.lit("stop")).cast("binary")).otherwise(F.col("content"))
    )
    with pytest.raises(Exception, match="stop"):
        write_z_files(payload, folder)
    # a task that was still being stopped may leave part of the temporary folder
    assert not os.path.exists(folder) or all(name.startswith("_temporary-") for name in os.listdir(folder))
    write_z_files(z_export(skewed, "shard", "line"), folder)
