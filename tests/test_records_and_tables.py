import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fileload.operators.audit import load_audit
from fileload.operators.keyed import keyed_load, latest, merge_cells
from fileload.operators.ledger import commit, ledger, marked, pending, shard_of
from fileload.operators.records import RecordSpec, fields, record_parse, record_spec, register_record
from fileload.sinks.detail import detail_write, read_detail
from fileload.sinks.keyed_table import KeyedTable

register_record("abc", RecordSpec(fields(a="long", b="string", c="timestamp_ntz")))

NOON = dt.datetime(2020, 1, 1, 12)
LINES = {
    "1|x|2020-01-01 12:00:00": (1, "x", NOON, False),
    "1|x|2020-01-01T12:00:00": (1, "x", NOON, False),
    "1||": (1, None, None, False),
    " 1 | sp |": (1, " sp ", None, False),
    "y|x|2020-01-01 12:00:00": (None, "x", NOON, True),
    "1|x|noon": (1, "x", None, True),
    "1|x": (1, "x", None, True),
    "1|x|2020-01-01 12:00:00|": (1, "x", NOON, True),
    "99999999999999999999|x|": (None, "x", None, True),
    "1.5|x|": (None, "x", None, True),
    "": (None, None, None, True),
    '1|"q|': (1, '"q', None, False),
    "1|b\\|": (1, "b\\", None, False),
    "1|\0x\0|": (1, "\0x\0", None, False),
    "#1|x|": (None, "x", None, True),
    "|".join(["1"] * 30000): (1, "1", None, True),
}


def test_record_parse(spark):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "n int, line string")
    rows = {row.n: row for row in record_parse(df, "abc").collect()}
    for i, (line, (a, b, c, bad)) in enumerate(LINES.items()):
        row = rows[i]
        assert (row.a, row.b, row.c) == (a, b, c), line[:40]
        assert row._bad == (line if bad else None)


def test_null_line_gives_nulls(spark):
    row = record_parse(spark.createDataFrame([(None,)], "line string"), "abc").first()
    assert tuple(row) == (None, None, None, None)


def test_record_types(spark):
    with pytest.raises(KeyError, match="nonesuch"):
        record_spec("nonesuch")
    with pytest.raises(ValueError, match="_bad"):
        RecordSpec(fields(_bad="string"))
    with pytest.raises(ValueError):
        RecordSpec(fields(a="long"), charset="utf-16")
    with pytest.raises(ValueError, match="a"):
        record_parse(spark.createDataFrame([("x", 1)], "line string, a int"), "abc")


def test_separator_is_literal(spark):
    register_record("dots", RecordSpec(fields(a="long", b="string"), sep=".*"))
    row = record_parse(spark.createDataFrame([("1.*x.y",)], "line string"), "dots").first()
    assert (row.a, row.b, row._bad) == (1, "x.y", None)


def test_parse_is_one_narrow_stage(spark, tmp_path):
    (tmp_path / "f").write_text("1|x|\n")
    parsed = record_parse(spark.read.text(str(tmp_path)).withColumnRenamed("value", "line"), "abc")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.count("split(") == 1


@pytest.mark.parametrize("tasks", [1, 3])
def test_detail_files_are_bounded_in_bytes(spark, tmp_path, tasks):
    # Half a value's rows are short, the rest up to 40 KB that no codec makes smaller;
    # one value holds nearly all rows.
    short = F.sha2(F.col("id").cast("string"), 512)
    long = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(160)])
    rows = spark.range(0, 1500, 1, tasks).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(0).alias("kind"),
        F.when(F.col("id") % 2 == 0, short).otherwise(long).alias("text"),
    )
    most = 1 << 20
    path = str(tmp_path / "detail")
    detail_write(rows, path, "j1", ["kind"], max_bytes_per_file=most)
    sizes = [f.stat().st_size for f in (tmp_path / "detail").rglob("*.parquet")]
    assert max(sizes) <= 1.2 * most
    # Nor are they crumbs: most of the bytes are in files of at least half the limit.
    assert sum(x for x in sizes if x >= most / 2) > sum(sizes) / 2
    written = read_detail(spark, path).select("kind", "text")
    assert written.exceptAll(rows).isEmpty() and rows.exceptAll(written).isEmpty()
    detail_write(rows.limit(0), path, "j2", ["kind"], max_bytes_per_file=most)
    with pytest.raises(ValueError):
        detail_write(rows, path, "j3", max_bytes_per_file=10)


def test_detail_write_replaces_its_own_job_only(spark, tmp_path):
    path = str(tmp_path / "detail")
    rows = spark.range(10).withColumn("kind", F.col("id") % 2)
    detail_write(rows, path, "j1", ["kind"])
    detail_write(rows, path, "j1", ["kind"])
    detail_write(rows, path, "j2", ["kind"], rebalance=True)
    assert {(r.job_id, r["count"]) for r in read_detail(spark, path).groupBy("job_id").count().collect()} == {("j1", 10), ("j2", 10)}
    # a retry that writes fewer partitions leaves no old ones behind
    detail_write(rows.where("kind = 0"), path, "j1", ["kind"], max_records_per_file=1)
    assert read_detail(spark, path).where("job_id = 'j1'").count() == 5
    assert len(list((tmp_path / "detail" / "job_id=j1" / "kind=0").glob("*.parquet"))) == 5
    with pytest.raises(ValueError):
        detail_write(rows, path, "2024-01-01")


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    stamp = dt.datetime(2020, 1, 1)
    files = spark.createDataFrame(
        [("a", 1, stamp), ("b", 2, stamp), ("c", None, None)], "path string, length bigint, modificationTime timestamp"
    )
    assert ledger(spark, path) is None and pending(files, None).count() == 3
    for _ in range(2):
        commit(path, files.where("path <> 'b'").withColumn("status", F.lit("ok")), "j1")
    assert ledger(spark, path).count() == 2
    assert [r.path for r in pending(files, ledger(spark, path)).collect()] == ["b"]
    assert {r.path: r.handled for r in marked(files, ledger(spark, path)).collect()} == {"a": True, "b": False, "c": True}
    assert {r.handled for r in marked(files, None).collect()} == {False}
    # Entered twice, a file is still one row.
    commit(path, files.where("path = 'a'").withColumn("status", F.lit("ok")), "j9")
    assert marked(files, ledger(spark, path)).count() == 3
    # One scan of the ledger, of the folders its files can be in.
    shard = files.where("path = 'a'").select(shard_of(F.col("path"))).first()[0]
    plan = marked(files.where("path = 'a'"), ledger(spark, path))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and f"PartitionFilters: [isnotnull(shard" in scans[0] and f"= {shard})" in scans[0]
    # a file that has changed is a new input
    changed = files.withColumn("length", F.col("length") + 1)
    assert sorted(r.path for r in pending(changed, ledger(spark, path)).collect()) == ["a", "b"]
    small = pending(files, ledger(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small


ROWS = "k string, v int, x string, y int, src_path string, line_no bigint"


def as_set(cells):
    return {tuple(r) for r in cells.select("row_key", "qualifier", "version", "value").collect()}


def test_keyed_load(spark):
    first = spark.createDataFrame([("a", 1, "a1", 1, "f", 0), ("a", 2, None, 2, "f", 1), ("b", 1, "b1", None, "f", 2)], ROWS)
    cells = keyed_load(None, first, "k", "v", ["x"], ties=["src_path", "line_no"])
    # a null is no cell: it does not hide the older value
    assert as_set(cells) == {("a", "x", 1, "a1"), ("b", "x", 1, "b1")}
    second = spark.createDataFrame([("a", 0, "old", 0, "g", 0), ("b", 1, "same", 0, "g", 1), ("c", 5, "c5", 0, "g", 2)], ROWS)
    both = keyed_load(cells, second, "k", "v", ["x"], ties=["src_path", "line_no"])
    want = {("a", "x", 1, "a1"), ("b", "x", 1, "same"), ("c", "x", 5, "c5")}
    assert as_set(both) == want
    assert as_set(keyed_load(both, second, "k", "v", ["x"])) == want
    assert both.columns == ["row_key", "family", "qualifier", "version", "value"]


def test_ties_and_mixed_types(spark):
    rows = spark.createDataFrame([("a", 1, "z", 7, "f", 9), ("a", 1, "y", 8, "f", 10), ("a", 1, "x", 9, "e", 99)], ROWS)
    cells = keyed_load(None, rows, "k", "v", ["x", "y"], "fam", ["src_path", "line_no"])
    assert as_set(cells) == {("a", "x", 1, "y"), ("a", "y", 1, "8")}
    assert latest(cells, ["x", "y", "none"], "fam").collect() == [("a", "y", "8", None)]
    assert dict(keyed_load(None, rows, "k", "v", ["y"]).dtypes)["value"] == "int"
    with pytest.raises(ValueError):
        keyed_load(None, rows, "k", "v")


def test_hot_cell_is_reduced_before_the_shuffle(spark):
    rows = spark.range(20000, numPartitions=8).select(
        F.lit("hot").alias("k"), F.col("id").alias("v"), F.col("id").cast("string").alias("x")
    )
    cells = keyed_load(None, rows, "k", "v", ["x"])
    assert as_set(cells) == {("hot", "x", 19999, "19999")}
    assert "partial_max" in cells._jdf.queryExecution().executedPlan().toString()


def brute(loads):
    best = {}
    for load, rows in enumerate(loads):
        for key, version, value in rows:
            if key not in best or (version, load, value) >= best[key]:
                best[key] = (version, load, value)
    return {(key, "x", version, value) for key, (version, _, value) in best.items()}


def test_keyed_table(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), 4)
    assert stored.cells() is None
    loads = []
    for n in range(3):
        rows = [(f"k{(i * 7 + n) % 23}", (i * 13 + n * 5) % 11, f"{n}-{i}") for i in range(40 - 15 * n)]
        loads.append(rows)
        batch = spark.createDataFrame(rows, "k string, v int, x string")
        stored.load(keyed_load(None, batch, "k", "v", ["x"]))
        assert as_set(stored.cells()) == brute(loads)
    stored.load(stored.cells().limit(0))
    cells = as_set(stored.cells())
    assert cells == brute(loads)
    # A compaction that died does not count, and goes with the next one.
    (tmp_path / "t" / "cells-2-4").mkdir()
    assert as_set(stored.cells()) == cells
    for _ in range(2):
        stored.compact()
        assert as_set(stored.cells()) == cells
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["cells-3-4"]
    stored.load(keyed_load(None, spark.createDataFrame([("k1", 99, "new")], "k string, v int, x string"), "k", "v", ["x"]))
    assert ("k1", "x", 99, "new") in as_set(stored.cells())
    # A session that knows nothing of the table reads it by its path.
    spark.sql(f"DROP TABLE {stored._name(stored._generation()[2])}")
    assert ("k1", "x", 99, "new") in as_set(KeyedTable(spark, str(tmp_path / "t"), 7).cells())


def test_cells_are_read_without_a_shuffle(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), 4)
    for n in range(3):
        rows = [("hot" if i % 3 == 0 else f"k{i}", n, f"{n}-{i}", str(i)) for i in range(600)]
        batch = spark.createDataFrame(rows, "k string, v int, x string, q string")
        stored.load(keyed_load(None, batch, "k", "v", qualifier_col="q", value_col="x"))
    plan = stored.cells()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert stored.cells().count() == 600 and stored.cells().where("version < 2").count() == 0
    # A key with a third of the cells is in every bucket, and a load adds a file to each.
    sizes = [r["count"] for r in stored.cells().groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 250
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 12


def test_a_load_writes_what_it_brings(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"))
    big = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.col("id").cast("string").alias("x"))
    stored.load(keyed_load(None, big, "k", "v", ["x"]))

    def written():
        return sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))

    before = written()
    stored.load(keyed_load(None, big.limit(20).withColumn("v", F.lit(2)), "k", "v", ["x"]))
    assert written() - before < before / 20
    assert stored.cells().where("version = 2").count() == 20 and stored.cells().count() == 50_000


def test_a_load_reads_nothing_of_earlier_loads(spark, tmp_path):
    # Equal versions: the later load wins, though its value is the smaller one.
    stored, kept = KeyedTable(spark, str(tmp_path / "t"), 4), {}
    for n in range(3):
        batch = spark.createDataFrame([("a", 1, f"v{3 - n}"), (f"b{n}", 1, "x")], "k string, v int, x string")
        if n == 2:
            kept = {p: p.read_bytes() for p in (tmp_path / "t").rglob("*.parquet")}
            for file in kept:
                file.write_bytes(b"not to be opened")
        stored.load(keyed_load(None, batch, "k", "v", ["x"]))
    for file, content in kept.items():
        file.write_bytes(content)
    for crc in (tmp_path / "t").rglob(".*.crc"):
        crc.unlink()
    assert as_set(stored.cells()) == {("a", "x", 1, "v1"), *((f"b{n}", "x", 1, "x") for n in range(3))}
    # A load that did not end is no load, also where another session reads.
    torn = next((tmp_path / "t").glob("cells-*/load=3-*")) / "_SUCCESS"
    torn.unlink()
    again = KeyedTable(spark, str(tmp_path / "t"))
    spark.sql(f"DROP TABLE {stored._name(stored._generation()[2])}")
    assert as_set(again.cells()) == {("a", "x", 1, "v2"), ("b0", "x", 1, "x"), ("b1", "x", 1, "x")}


def test_value_type_is_fixed(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([("a", 1, 5, "x"), (None, 1, 6, "y")], "k string, v int, n int, s string")
    stored.load(keyed_load(None, rows, "k", "v", ["n"]))
    with pytest.raises(ValueError, match="holds"):
        stored.load(keyed_load(None, rows, "k", "v", ["n", "s"]))
    assert as_set(stored.cells()) == {("a", "n", 1, 5)}


def test_merge_keeps_cells_of_both(spark):
    one = spark.createDataFrame([("a", "d", "x", 1, "1")], "row_key string, family string, qualifier string, version int, value string")
    two = one.replace("a", "b", ["row_key"])
    assert merge_cells(one, two).count() == 2


def test_load_audit(spark):
    detail = spark.createDataFrame(
        [("j", "f", "r", None, 10), ("j", "f", "r", "bad", 10), ("j", "g", "r", None, 5)],
        "job_id string, src_path string, record_type string, _bad string, src_length bigint",
    )
    files = spark.createDataFrame(
        [("j", "f", "r", 10, "ok"), ("j", "e", "r", 0, "ok"), ("j", "m", "r", None, "missing")],
        "job_id string, src_path string, record_type string, src_length bigint, status string",
    )
    rows = {r.src_path: (r.n_rows, r.n_bad, r.src_bytes, r.status) for r in load_audit(detail, files).collect()}
    assert rows == {"f": (2, 1, 10, "ok"), "g": (1, 0, 5, "ok"), "e": (0, 0, 0, "ok"), "m": (0, 0, None, "missing")}
    assert load_audit(detail).count() == 2
    plan = load_audit(detail, files)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert "HashAggregate" in plan and "Sort" not in plan


def test_stages_are_removed(spark, tmp_path):
    from fileload import session

    with session.stage_scope(spark):
        kept = session.stage_table(spark.range(3), "t")
        path = kept.inputFiles()[0]
        assert kept.count() == 3 and os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
