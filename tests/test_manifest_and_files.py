import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fileload.functions import paths
from fileload.functions.paths import parent, qualify, working_uri
from fileload.operators.manifest import manifest_parse
from fileload.operators.records import RecordSpec, fields, record_parse, register_record
from fileload.operators.routing import lineage_stamp, size_route, take_route
from fileload.operators.unz import z_ingest
from fileload.session import stage_dir
from fileload.sources import bypath, files
from fileload.sources.files import codec_text_scan, file_fetch, list_files, manifest_files
from fileload.sources.manifest import manifest_scan

SPLITS = {
    "a:b:c::": ["a", "b", "c"],
    ":a": ["", "a"],
    "": [""],
    ":": [],
    ":::": [],
    "a": ["a"],
    "::a::": ["", "", "a"],
    "hdfs://h:9000/x:12": ["hdfs", "//h", "9000/x", "12"],
    "a:\u2028": ["a", "\u2028"],
}


def test_manifest_parse_splits_as_java_does(spark):
    rows = manifest_parse(spark.createDataFrame([(v,) for v in SPLITS], "value string"), ["f0", "f1"]).collect()
    for row in rows:
        want = SPLITS[row.value]
        assert row.n_fields == len(want)
        assert [row.f0, row.f1] == (want + [None, None])[:2]
        assert row.extra == want[2:]
        assert row.status == ("empty" if row.value == "" else "ok")


def java_split(text):
    parts = text.split(":")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return [] if parts == [""] and text else parts


def test_manifest_parse_of_random_lines(spark):
    chance = random.Random(3)
    texts = sorted({"".join(chance.choices(":::ab |\r\u2028汉", k=chance.randrange(9))) for _ in range(3000)})
    rows = manifest_parse(spark.createDataFrame([(t,) for t in texts], "value string"), ["f0"]).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = java_split(row.value)
        assert (row.n_fields, row.f0, row.extra) == (len(want), want[0] if want else None, want[1:])


def test_manifest_parse_other_separators(spark):
    df = spark.createDataFrame([("a.b|*c|*|*",), (None,)], "value string")
    row, none = manifest_parse(df, ["x"], sep="|*").collect()
    assert (row.x, row.extra, row.n_fields) == ("a.b", ["c"], 2)
    assert none.x is None and none.status == "empty"
    with pytest.raises(ValueError):
        manifest_parse(df, ["x"], sep="")
    for layout in (["status"], ["x", "x"], ["value"]):
        with pytest.raises(ValueError, match="layout"):
            manifest_parse(df, layout)
    with pytest.raises(ValueError, match="length"):
        manifest_files(spark, manifest_parse(df, ["p", "length"]), "p")


def test_manifest_scan_keeps_every_line(spark, tmp_path):
    (tmp_path / "m1").write_text("a:1\n\nb:2")
    (tmp_path / "m2").write_text("c\n")
    rows = manifest_scan(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in rows) == ["", "a:1", "b:2", "c"]
    assert {r.manifest_file.rsplit("/", 1)[1] for r in rows} == {"m1", "m2"}


def test_qualify(spark):
    want = {
        "/a//b/": "hdfs://h:1/a/b",
        "x/y": "hdfs://h:1/u/x/y",
        "file:///a/b": "file:/a/b",
        "file:/a/b": "file:/a/b",
        "hdfs://k//a": "hdfs://k/a",
        "/": "hdfs://h:1/",
    }
    df = spark.createDataFrame([(v,) for v in want], "p string").select("p", qualify(F.col("p"), "hdfs://h:1/u").alias("q"))
    assert {r.p: r.q for r in df.collect()} == want
    folders = df.select("p", parent(F.col("q")).alias("d")).where("p in ('/a//b/', 'file:/a/b', '/')").collect()
    assert {r.p: r.d for r in folders} == {"/a//b/": "hdfs://h:1/a", "file:/a/b": "file:/a", "/": "hdfs://h:1/"}


NAMES = ["plain.txt", "with space.txt", "plus+sign.txt", "per%20cent.txt", "glob[1]{2}*?.txt", "sub/inner.txt", "汉字.txt"]


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for i, name in enumerate(NAMES):
        (tmp_path / "in" / name).write_text(f"line {i}\n" * (i + 1))
    (tmp_path / "in" / "empty.txt").write_text("")
    (tmp_path / "in" / "_hidden.txt").write_text("x")
    (tmp_path / "in" / "unlisted.txt").write_text("never opened")
    return tmp_path / "in"


def listed(spark, lines, layout=("path", "tag")):
    return manifest_parse(spark.createDataFrame([(v, "m") for v in lines], "value string, manifest_file string"), layout)


@pytest.mark.parametrize("by_tasks, max_files, folders", [(True, 20_000, 64), (True, 1, 1), (False, 20_000, 2_000), (False, 2, 1)])
def test_file_fetch(spark, inputs, monkeypatch, by_tasks, max_files, folders):
    """Files opened by tasks, in groups of one or of many, and by Spark's source."""
    if by_tasks:
        monkeypatch.setattr(bypath, "FOLDERS_AT_ONCE", folders)
        monkeypatch.setattr(bypath, "GROUP_BYTES", max_files)
    else:
        monkeypatch.setattr(files, "can_open", lambda *_: set())
        monkeypatch.setattr(files, "LIST_FOLDERS", folders)
    lines = [f"{inputs}/{name}:t{i}" for i, name in enumerate(NAMES)]
    lines += [f"{inputs}//plain.txt:again", f"{inputs}/absent.txt:a", f"{inputs}/empty.txt:e", f"{inputs}/sub:dir", "/no/such/folder/x:b", f"{inputs}/_hidden.txt:c", "", ":"]
    rows = {r.path.split("/in/")[-1]: r for r in file_fetch(spark, listed(spark, lines), "path", max_files=max_files).collect()}
    assert len(rows) == len(NAMES) + 5
    for i, name in enumerate(NAMES):
        row = rows[name]
        assert bytes(row.content).decode() == f"line {i}\n" * (i + 1)
        assert row.length == len(row.content) and row.status == "ok"
        assert row.modificationTime is not None
    assert rows["plain.txt"].n_listed == 2 and rows["sub/inner.txt"].n_listed == 1
    # "//plain.txt:again" sorts before "/plain.txt:t0"
    assert rows["plain.txt"].tag == "again" and rows["with space.txt"].tag == "t1"
    assert rows["absent.txt"].status == rows["file:/no/such/folder/x"].status == "missing"
    assert rows["_hidden.txt"].status == ("ok" if by_tasks else "hidden")
    assert rows["_hidden.txt"].content == (b"x" if by_tasks else None)
    assert rows["sub"].status == "missing"
    assert (rows["empty.txt"].status, rows["empty.txt"].length, bytes(rows["empty.txt"].content)) == ("ok", 0, b"")
    assert rows["absent.txt"].content is None and rows["absent.txt"].tag == "a"


def test_file_fetch_of_nothing_that_exists(spark):
    rows = file_fetch(spark, listed(spark, ["/no/such/place/x"]), "path").collect()
    assert [(r.status, r.content) for r in rows] == [("missing", None)]


def test_file_fetch_relative_to_a_base(spark, inputs):
    rows = file_fetch(spark, listed(spark, ["plain.txt", "sub/inner.txt"]), "path", f"file:{inputs}").collect()
    assert sorted(r.status for r in rows) == ["ok", "ok"]


def test_uri_is_what_scans_report(spark, inputs):
    lines = [f"{inputs}/{name}" for name in NAMES]
    uris = {r.uri for r in manifest_files(spark, listed(spark, lines), "path").collect()}
    seen = {r.path for r in codec_text_scan(spark, str(inputs), recursiveFileLookup="true").select("path").distinct().collect()}
    assert uris <= seen and len(uris) == len(NAMES)


def test_one_scan_and_no_content_in_the_shuffle(spark, inputs):
    lines = [f"{inputs}/{name}:t" for name in NAMES]
    few, many = (
        file_fetch(spark, listed(spark, chosen), "path")._jdf.queryExecution().executedPlan().toString()
        for chosen in (lines[:1], lines)
    )
    assert few.count("FileScan") == many.count("FileScan") == 2
    # Paths are dealt out before the stage that reads content.
    below = many[many.index("MapInArrow") :]
    assert "Exchange" in below and "content" not in below.split("Exchange", 1)[1]


def test_only_the_folders_of_listed_files_are_listed(spark, tmp_path, monkeypatch):
    """A file at the root of a deep tree costs the listing of one folder."""
    deep = tmp_path.joinpath(*"abcdefgh")
    deep.mkdir(parents=True)
    (deep / "far.txt").write_text("far")
    (tmp_path / "near.txt").write_text("near")
    seen = spark.sparkContext.accumulator(0)
    children = bypath._children

    def counted(folder, open_fs):
        seen.add(1)
        return children(folder, open_fs)

    monkeypatch.setattr(bypath, "_children", counted)
    found = manifest_files(spark, listed(spark, [f"{tmp_path}/near.txt:t"]), "path").collect()
    assert [r.status for r in found] == ["ok"] and seen.value == 1
    whole = list_files(spark, [str(tmp_path)])
    assert sorted(r.path.rsplit("/", 1)[1] for r in whole.collect()) == ["far.txt", "near.txt"]
    assert seen.value == 1 + 9


def test_walk_sees_what_a_scan_sees_and_more(spark, inputs):
    ours = {r.path: tuple(r) for r in list_files(spark, [str(inputs)], hidden=True).collect()}
    theirs = {r.path: tuple(r) for r in files._indexed(spark, [str(inputs)]).collect()}
    assert theirs.items() <= ours.items()
    assert {p.rsplit("/", 1)[1] for p in ours.keys() - theirs.keys()} == {"_hidden.txt", "empty.txt"}
    (inputs / "_temporary").mkdir()
    (inputs / "_temporary" / "x").write_text("x")
    seen = {r.path: tuple(r) for r in list_files(spark, [str(inputs)]).collect()}
    assert {p.rsplit("/", 1)[1] for p in seen.keys() - theirs.keys()} == {"empty.txt"} and theirs.keys() < seen.keys()


def test_groups_are_dense_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(bypath, "BUCKET_ROWS", 7)
    sizes = spark.createDataFrame([(f"p{i}", i * 37 % 90) for i in range(100)], "path string, length bigint")
    grouped, count = bypath.in_groups(sizes, F.col("length"), 200)
    rows = grouped.groupBy("group").agg(F.sum("length").alias("s"), F.max("length").alias("m")).collect()
    assert {r.group for r in rows} == set(range(count)) and all(r.s <= 200 + r.m for r in rows)
    assert bypath.dealt(sizes, F.col("length"), 200).rdd.getNumPartitions() == count
    large = spark.createDataFrame([(f"p{i}", 10**9 * (i % 2) + 1) for i in range(20)], "path string, length bigint")
    grouped, count = bypath.in_groups(large, F.col("length"), 200)
    assert {r.group for r in grouped.collect()} == set(range(count)) and 10 <= count <= 20
    none, one = bypath.in_groups(sizes.limit(0), F.col("length"), 200)
    assert none.collect() == [] and one == 1


def test_a_file_too_large_for_a_value(spark, inputs):
    found = list_files(spark, [str(inputs)])
    rows = {r.path.rsplit("/", 1)[1]: r for r in bypath.read_content(found, most=7).collect()}
    assert (rows["plain.txt"].status, bytes(rows["plain.txt"].content)) == ("ok", b"line 0\n")
    assert (rows["with space.txt"].status, rows["with space.txt"].content) == ("oversize", None)


def test_codec_text_scan(spark, tmp_path):
    lines = spark.createDataFrame([(f"line {i}",) for i in range(20)], "value string")
    for codec in ("none", "gzip", "bzip2", "deflate", "snappy"):
        lines.write.mode("append").option("compression", codec).text(str(tmp_path / "in"))
    (tmp_path / "in" / "raw.Z").write_bytes(b"\x1f\x9d\x90garbage")
    (tmp_path / "in" / "Z").write_text("named Z")
    (tmp_path / "in" / "fooZ").write_text("ends in Z\r\n")
    rows = codec_text_scan(spark, str(tmp_path / "in"))
    counts = {r.line: r["count"] for r in rows.groupBy("line").count().collect()}
    assert counts == {**{f"line {i}": 5 for i in range(20)}, "named Z": 1, "ends in Z": 1}
    assert all(r.length > 0 and r.modificationTime for r in rows.collect())


def test_line_ends(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"a\r\nb\n\n c\rd \r\r\nlast\r")
    assert [r.line for r in codec_text_scan(spark, str(tmp_path)).collect()] == ["a", "b", "", " c\rd \r", "last"]


def test_charsets(spark, tmp_path):
    text = "億|x\n汉字\n"
    (tmp_path / "g.txt").write_bytes(text.encode("gbk"))
    assert [r.line for r in codec_text_scan(spark, str(tmp_path), "GBK").collect()] == ["億|x", "汉字"]
    (tmp_path / "g.txt").write_bytes(b"ok\n\xff\xfebad\n")
    for charset in ("UTF-8", "GBK"):
        rows = [r.line for r in codec_text_scan(spark, str(tmp_path), charset).collect()]
        assert rows[0] == "ok" and "\ufffd" in rows[1] and rows[1].endswith("bad")
    with pytest.raises(ValueError):
        codec_text_scan(spark, str(tmp_path), "UTF-16")


def test_size_route(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 11), ("c", 0)], "path string, length bigint")
    assert {r.path: r.route for r in size_route(sizes, 10).collect()} == {"a": "normal", "b": "oversize", "c": "normal"}
    assert [r.path for r in take_route(sizes, 10, "oversize").collect()] == ["b"]
    with pytest.raises(ValueError):
        take_route(sizes, 10, "other")


def test_size_limit_reaches_the_scan(spark, inputs):
    scan = spark.read.format("binaryFile").load(str(inputs))
    plan = take_route(scan, 10, "oversize")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length,10)" in plan


def test_listing_opens_no_file(spark, inputs):
    plan = list_files(spark, [str(inputs)])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_lines_to_rows_without_a_shuffle(spark, inputs):
    register_record("narrow", RecordSpec(fields(a="string", n="long")))
    texts = record_parse(codec_text_scan(spark, str(inputs)), "narrow")
    payloads = spark.read.format("binaryFile").load(str(inputs))
    packed = record_parse(z_ingest(payloads), "narrow")
    for rows in (texts, packed):
        plan = lineage_stamp(rows, "job-1")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint,content:binary>" in scan


def test_file_systems_of_tasks(tmp_path, monkeypatch):
    made = []

    def from_uri(uri):
        made.append(uri)
        return SimpleNamespace(uri=uri), {"s3://bucket/": "bucket/", "hdfs://nn:1/": "/"}[uri]

    monkeypatch.setattr(paths.pafs, "FileSystem", SimpleNamespace(from_uri=from_uri))
    open_fs = paths.opener()
    for uri, want in {
        "file:/a b/c": "/a b/c",
        "file:///a": "/a",
        "/x": "/x",
        "hdfs://nn:1/d/e": "/d/e",
        "hdfs://nn:1/d/f": "/d/f",
        "s3a://bucket/k/l": "bucket/k/l",
    }.items():
        assert open_fs(uri)[1] == want
    assert made == ["hdfs://nn:1/", "s3://bucket/"]


def test_intermediate_tables_go_to_the_shared_folder():
    def session(master, **conf):
        get = lambda key, default: conf.get(key.replace(".", "_"), default)
        return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(master=master))

    shared = stage_dir(session("yarn", spark_checkpoint_dir="hdfs://nn/tmp/"), "t")
    assert shared.startswith("hdfs://nn/tmp/t-")
    assert shared != stage_dir(session("yarn", spark_checkpoint_dir="hdfs://nn/tmp/"), "t")
    assert stage_dir(session("local[2]"), "t").startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage_dir(session("yarn"), "t")


def test_lineage_stamp(spark, inputs):
    from_scan = lineage_stamp(spark.read.text(str(inputs / "plain.txt")), "job-1").first()
    from_columns = lineage_stamp(codec_text_scan(spark, str(inputs / "plain.txt")), "job-1").first()
    for name in ("job_id", "src_path", "src_length", "src_mtime"):
        assert from_scan[name] == from_columns[name] is not None
    with pytest.raises(ValueError):
        lineage_stamp(spark.range(1), "1234")


def test_default_base_is_the_working_folder(spark):
    assert working_uri(spark).startswith("file:") and working_uri(spark, "/x") == "file:/x"
