"""Every operator run over the driver tables, and the SQL that gives the same rows.

The tables hold no input files, so each query first has Spark write them as the
files its operator reads, all of every table, in a fresh folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileload.config import LoadConfig
from fileload.functions.paths import working_uri
from fileload.operators.audit import load_audit
from fileload.operators.keyed import keyed_load, latest
from fileload.operators.ledger import commit, ledger, pending
from fileload.operators.manifest import manifest_parse
from fileload.operators.records import BAD, RecordSpec, fields, record_parse, register_record
from fileload.operators.routing import lineage_stamp, size_route
from fileload.operators.unz import z_ingest, z_ingest_files, z_lines, z_reject
from fileload.operators.zpack import z_export
from fileload.plans.load import run_load
from fileload.session import stage_dir, stage_table
from fileload.sinks.detail import detail_write, job_folder, read_detail
from fileload.sinks.keyed_table import KeyedTable
from fileload.sinks.zfiles import write_z_files
from fileload.sources.files import codec_text_scan, file_fetch, list_files
from fileload.sources.manifest import manifest_scan
from fileload.streaming.ingest import stream_detail, stream_ingest

EVENTS = fields(
    event_id="long", ts="timestamp_ntz", user_id="long", event_type="string", value="double", props="string"
)

# Events as cells: the type is the qualifier.
EVENT_CELLS = {"qualifier_col": "event_type", "value_col": "value", "ties": ["event_id"]}

register_record("events", RecordSpec(EVENTS))
register_record("doc_facts", RecordSpec(fields(doc_id="long", lang="string", n_chars="long")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_lines(spark: SparkSession, sf_dir: str, break_some: bool = False) -> DataFrame:
    """Events as ``|`` lines; with ``break_some``, those whose id is a multiple
    of 97 have text where the number should be."""
    value = F.col("value").cast("string")
    if break_some:
        value = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("?"), value)).otherwise(value)
    texts = [value if name == "value" else F.col(name).cast("string") for name in EVENTS.names]
    return table(spark, sf_dir, "events").select(F.concat_ws("|", *texts).alias("value"), "event_type")


def doc_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "source", "doc_id", F.concat_ws("|", "doc_id", "lang", "n_chars").alias("value")
    )


def source_number(path_or_source):
    return F.regexp_extract(path_or_source, r"src(\d+)", 1).cast("int")


def source_name(path):
    return F.regexp_extract(path, r"(src\d+)", 1)


def plain(path):
    """A path as a manifest can carry it, without a scheme."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]+)?/*", "/")


def _files_by_source(lines: DataFrame) -> str:
    folder = stage_dir(lines.sparkSession, "input")
    lines.select("value", "source").write.partitionBy("source").text(folder)
    return folder


def _manifest(spark: SparkSession, names: DataFrame) -> str:
    folder = stage_dir(spark, "manifest")
    names.select("value").write.text(folder)
    return folder


def q_manifest_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = _manifest(spark, docs.select(F.concat_ws(":", "source", "lang", "doc_id", "n_chars").alias("value")))
    return manifest_scan(spark, folder).select("value")


def q_manifest_parse(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    lines = pages.select("page_id", F.concat("url", F.repeat(F.lit(":"), (F.col("page_id") % 3).cast("int"))).alias("value"))
    parsed = manifest_parse(lines, ["f0", "f1"])
    last = F.when(F.size("extra") > 0, F.element_at("extra", -1)).otherwise(F.coalesce("f1", "f0"))
    return parsed.select("page_id", "n_fields", "f0", last.alias("f_last"))


def q_file_fetch(spark, sf_dir):
    """Every file of every source, and for each source a file that is not there."""
    docs = table(spark, sf_dir, "documents")
    folder = _files_by_source(docs.select("source", F.col("text").alias("value")))
    there = list_files(spark, [folder]).select(plain(F.col("path")).alias("path"), source_name("path").alias("source"))
    gone = docs.select(F.concat(F.lit(f"{folder}/gone-"), "source").alias("path"), "source").distinct()
    manifest = _manifest(spark, there.union(gone).select(F.concat_ws(":", "path", "source").alias("value")))
    parsed = manifest_parse(manifest_scan(spark, manifest), ["path", "source"])
    fetched = file_fetch(spark, parsed, "path", working_uri(spark, folder))
    return fetched.groupBy("source", "status").agg(F.sum(F.octet_length("content").cast("bigint")).alias("length"))


def _z_by_source(spark, sf_dir) -> DataFrame:
    return z_export(doc_facts(spark, sf_dir), "source", "value", "doc_id")


def _z_scan(spark, folder) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.Z").load(folder)


def q_z_ingest(spark, sf_dir):
    folder = stage_dir(spark, "z")
    write_z_files(_z_by_source(spark, sf_dir), folder)
    lines = z_lines(z_ingest(_z_scan(spark, folder))).select(source_name("path").alias("source"), "line")
    return record_parse(lines, "doc_facts").select("source", "doc_id", "lang", "n_chars")


def q_z_split_ingest(spark, sf_dir):
    """All texts in large files, each decoded in parts by several tasks, with the
    numbers of the lines in their file."""
    folder = stage_dir(spark, "z")
    lines = table(spark, sf_dir, "documents").select("lang", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = lines.select("lang", "doc_id", "at", F.concat_ws("|", "doc_id", "at", "line").alias("value"))
    write_z_files(z_export(keyed, "lang", "value", ["doc_id", "at"]), folder)
    files = stage_table(list_files(spark, [folder]).where("path like '%.Z'"), "files")
    longest = files.agg(F.max("length")).first()[0] or 0
    found = z_lines(z_ingest_files(files, split_bytes=max(1 << 14, longest // 16)))
    part = F.regexp_extract("path", r"shard=([^/]+)/part-", 1)
    doc, at = (F.get(F.split("line", r"\|", 3), F.lit(i)).cast("bigint") for i in (0, 1))
    rows = found.select(part.alias("lang"), "path", "line_no", doc.alias("doc_id"), at.alias("at"))
    # In a file, lines in the order of their numbers are in the order of the texts.
    dense = F.count("*").over(Window.partitionBy("path").orderBy("doc_id", "at").rowsBetween(Window.unboundedPreceding, 0)) - 1
    return rows.select("lang", "doc_id", "at", (F.col("line_no") == dense).alias("in_order"))


def q_z_reject(spark, sf_dir):
    folder = stage_dir(spark, "z")
    kind = source_number("shard") % 4
    head = F.when(kind == 0, F.unhex(F.lit("1F9E90"))).when(kind == 1, F.unhex(F.lit("1F9D91")))
    body = F.when(kind == 2, F.unhex(F.lit("FF" * 40))).otherwise(F.expr("substring(content, 4)"))
    broken = F.concat(F.coalesce(head, F.unhex(F.lit("1F9D90"))), body)
    payloads = _z_by_source(spark, sf_dir).withColumn("content", broken)
    write_z_files(payloads, folder)
    absent = payloads.select(F.col("shard").alias("path"), F.lit(None).cast("binary").alias("content")).distinct()
    found = _z_scan(spark, folder).select("path", "content").union(absent)
    return z_reject(found).select(source_name("path").alias("source"), "status").distinct()


def q_codec_text_scan(spark, sf_dir):
    folder = stage_dir(spark, "codecs")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.concat_ws(":", "vec_id", "label").alias("value"), (F.col("label") % 4).alias("codec")
    )
    for number, codec in enumerate(("gzip", "bzip2", "deflate", "snappy")):
        vectors.where(F.col("codec") == number).select("value").write.mode("append").option("compression", codec).text(folder)
    return codec_text_scan(spark, folder).select(F.col("line").alias("value"))


def q_record_parse(spark, sf_dir):
    folder = _manifest(spark, event_lines(spark, sf_dir, break_some=True))
    parsed = record_parse(codec_text_scan(spark, folder).select("line"), "events")
    return parsed.select("event_id", "ts", "user_id", "event_type", "value", F.col(BAD).isNotNull().alias("is_bad"))


def q_size_route(spark, sf_dir):
    """Sources by the bytes of all of their files, against the mean of the sources; no
    content is read."""
    docs = table(spark, sf_dir, "documents").select("source", F.col("text").alias("value"))
    files = list_files(spark, [_files_by_source(docs)])
    sources = files.groupBy(source_name("path").alias("source")).agg(F.sum("length").alias("length"))
    mean = sources.agg(F.floor(F.sum("length") / F.count("*"))).first()[0]
    return size_route(sources, mean or 0)


def q_lineage_stamp(spark, sf_dir):
    folder = _files_by_source(doc_facts(spark, sf_dir))
    stamped = lineage_stamp(codec_text_scan(spark, folder), "job-1")
    return stamped.groupBy("job_id", source_name("src_path").alias("src")).agg(F.count("*").alias("n_rows"))


def q_detail_write(spark, sf_dir):
    folder = stage_dir(spark, "detail")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for _ in range(2):
        detail_write(rows, folder, "job-1", ["event_type"])
    return read_detail(spark, folder).select("job_id", "event_id", "event_type", "value")


def q_processed_ledger(spark, sf_dir):
    folder = _files_by_source(doc_facts(spark, sf_dir))
    files = list_files(spark, [folder])
    books = stage_dir(spark, "ledger")
    commit(books, files.where(source_number("path") < 10).withColumn("status", F.lit("ok")), "job-1")
    return pending(files, ledger(spark, books)).select(source_name("path").alias("source")).distinct()


def _cells_in_two_loads(spark, sf_dir) -> DataFrame:
    """All events, those of the second half of each day loaded first."""
    events = table(spark, sf_dir, "events")
    late = F.hour("ts") >= 12
    stored = KeyedTable(spark, stage_dir(spark, "keyed"))
    for part in (late, ~late):
        stored.load(keyed_load(None, events.where(part), "user_id", "ts", **EVENT_CELLS))
    return stored.cells()


def q_keyed_load(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    late = F.hour("ts") >= 12
    first = keyed_load(None, events.where(late), "user_id", "ts", **EVENT_CELLS)
    both = keyed_load(first, events.where(~late), "user_id", "ts", **EVENT_CELLS)
    return both.select("row_key", "qualifier", "version", "value")


def q_keyed_table(spark, sf_dir):
    return _cells_in_two_loads(spark, sf_dir).select("row_key", "qualifier", "version", "value")


def q_keyed_latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cells = keyed_load(
        None, orders, "o_custkey", "o_orderdate", ["o_orderstatus", "o_orderpriority"], ties=["o_orderkey"]
    )
    return latest(cells, ["o_orderstatus", "o_orderpriority"])


def q_z_export(spark, sf_dir):
    packed = z_export(table(spark, sf_dir, "documents"), "lang", "text", "doc_id")
    files = packed.select(F.concat_ws("/", "shard", F.hex("part")).alias("path"), "content")
    return z_lines(z_ingest(files)).select(F.substring_index("path", "/", 1).alias("shard"), "line")


def q_stream_ingest(spark, sf_dir):
    folder, detail = stage_dir(spark, "input"), stage_dir(spark, "detail")
    event_lines(spark, sf_dir).select("value").write.option("maxRecordsPerFile", 4000).text(folder)
    query = stream_ingest(spark, folder, "events", detail, stage_dir(spark, "checkpoint"), "job-1")
    query.awaitTermination()
    return stream_detail(spark, detail, "job-1").select("event_id", "user_id", "event_type", "value")


def q_stream_z_ingest(spark, sf_dir):
    folder, detail = stage_dir(spark, "z"), stage_dir(spark, "detail")
    write_z_files(_z_by_source(spark, sf_dir), folder)
    query = stream_ingest(
        spark, f"{folder}/*", "doc_facts", detail, stage_dir(spark, "checkpoint"), "job-1", codec="z"
    )
    query.awaitTermination()
    rows = stream_detail(spark, detail, "job-1")
    return rows.select(source_name("src_path").alias("source"), "doc_id", "lang", "n_chars")


def q_stream_keyed_load(spark, sf_dir):
    folder, stored = stage_dir(spark, "input"), KeyedTable(spark, stage_dir(spark, "keyed"))
    event_lines(spark, sf_dir).select("value").write.option("maxRecordsPerFile", 4000).text(folder)
    query = stream_ingest(
        spark,
        folder,
        "events",
        stage_dir(spark, "detail"),
        stage_dir(spark, "checkpoint"),
        "job-1",
        keyed={"key": "user_id", "version": "ts", **EVENT_CELLS},
        table=stored,
        maxFilesPerTrigger=20,
    )
    query.awaitTermination()
    return stored.cells().select("row_key", "qualifier", "version", "value")


def q_load_audit(spark, sf_dir):
    folder, detail = stage_dir(spark, "input"), stage_dir(spark, "detail")
    event_lines(spark, sf_dir, break_some=True).write.partitionBy("event_type").text(folder)
    rows = record_parse(lineage_stamp(codec_text_scan(spark, folder), "job-1").drop("job_id"), "events")
    kind = F.regexp_extract("src_path", r"event_type=([^/]+)", 1)
    detail_write(rows.withColumn("record_type", kind), detail, "job-1")
    audit = load_audit(read_detail(spark, detail))
    return audit.groupBy("record_type").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))


def _whole_job(spark, sf_dir, break_some: bool):
    """The whole job on events: even users' lines as .gz, the others' as .Z."""
    folder = stage_dir(spark, "input")
    user = F.get(F.split("value", r"\|"), F.lit(2)).cast("bigint")
    lines = event_lines(spark, sf_dir, break_some).select("value", (user % 2 == 0).alias("even"))
    lines.where("even").select("value").write.option("compression", "gzip").text(f"{folder}/plain")
    write_z_files(z_export(lines.where("not even"), "even", "value"), f"{folder}/z")
    manifest = _manifest(spark, list_files(spark, [folder]).select(plain(F.col("path")).alias("value")))
    config = LoadConfig(
        record_type="events",
        max_file_size=1 << 40,
        job_id="job-1",
        detail_path=stage_dir(spark, "detail"),
        ledger_path=stage_dir(spark, "ledger"),
        base_uri=working_uri(spark, folder),
    )
    return run_load(spark, config, manifest)


def q_bulk_load(spark, sf_dir):
    return _whole_job(spark, sf_dir, False).detail().select(*EVENTS.names)


def q_bulk_load_audit(spark, sf_dir):
    audit = _whole_job(spark, sf_dir, True).audit()
    counts = [F.sum(name).alias(name) for name in ("n_rows", "n_bad")]
    return audit.groupBy("job_id", "record_type", "status").agg(*counts)


def q_bulk_load_altered(spark, sf_dir):
    """The whole job, then some values changed behind its back: the parts that no longer
    hold what was written, though every count is right."""
    result = _whole_job(spark, sf_dir, False)
    changed = F.when(F.col("event_id") % 97 == 0, -F.col("value")).otherwise(F.col("value"))
    for wave in [row.wave for row in result.written().select("wave").distinct().collect()]:
        folder = job_folder(result.config.detail_path, "job-1", {"wave": wave, "codec": "text"})
        rows = stage_table(spark.read.parquet(folder), "changed")
        rows.withColumn("value", changed).write.mode("overwrite").partitionBy("kind").parquet(folder)
    counts = [F.sum(name).alias(name) for name in ("n_rows", "n_stored")]
    return result.altered().groupBy("codec").agg(*counts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: run for name, run in list(globals().items()) if name.startswith("q_")
}

NEWEST_CELLS = """
SELECT user_id AS row_key, event_type AS qualifier, ts AS version, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLES: dict[str, str] = {
    "manifest_scan": "SELECT source||':'||lang||':'||doc_id||':'||n_chars AS value FROM documents",
    "manifest_parse": """
WITH m AS (SELECT page_id, regexp_replace(url||repeat(':', CAST(page_id%3 AS INT)), ':+$', '') AS s FROM pages)
SELECT page_id, CAST(len(string_split(s, ':')) AS INT) AS n_fields,
       string_split(s, ':')[1] AS f0, string_split(s, ':')[-1] AS f_last FROM m
""",
    "file_fetch": """
SELECT source, 'ok' AS status, CAST(sum(octet_length(encode(text))+1) AS BIGINT) AS length FROM documents GROUP BY source
UNION ALL SELECT DISTINCT source, 'missing', CAST(NULL AS BIGINT) FROM documents
""",
    "z_ingest": "SELECT source, doc_id, lang, n_chars FROM documents",
    "z_split_ingest": """
SELECT lang, doc_id, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS BIGINT) AS at, true AS in_order FROM documents
""",
    "z_reject": """
SELECT DISTINCT source, CASE CAST(substr(source, 4) AS INT)%4
  WHEN 0 THEN 'bad_magic' WHEN 1 THEN 'bad_width' WHEN 2 THEN 'corrupt' ELSE 'ok' END AS status FROM documents
UNION ALL SELECT DISTINCT source, 'no_content' FROM documents
""",
    "codec_text_scan": "SELECT vec_id||':'||label AS value FROM embeddings",
    "record_parse": """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id%97 = 0 THEN NULL ELSE value END AS value,
       event_id%97 = 0 AS is_bad FROM events
""",
    "size_route": """
WITH sizes AS (SELECT source, CAST(sum(octet_length(encode(text))+1) AS BIGINT) AS length FROM documents GROUP BY source)
SELECT source, length, CASE WHEN length > (SELECT CAST(sum(length) AS BIGINT) // count(*) FROM sizes) THEN 'oversize' ELSE 'normal' END AS route
FROM sizes
""",
    "lineage_stamp": "SELECT 'job-1' AS job_id, source AS src, count(*) AS n_rows FROM documents GROUP BY source",
    "detail_write": "SELECT 'job-1' AS job_id, event_id, event_type, value FROM events",
    "processed_ledger": "SELECT DISTINCT source FROM documents WHERE CAST(substr(source, 4) AS INT) >= 10",
    "keyed_load": NEWEST_CELLS,
    "keyed_table": NEWEST_CELLS,
    "keyed_latest": """
SELECT o_custkey AS row_key, o_orderstatus, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""",
    "z_export": """
SELECT lang AS shard, unnest(string_split(text, chr(10))) AS line FROM documents
""",
    "stream_ingest": "SELECT event_id, user_id, event_type, value FROM events",
    "load_audit": """
SELECT event_type AS record_type, count(*) AS n_rows,
       CAST(count(*) FILTER (WHERE event_id%97 = 0) AS BIGINT) AS n_bad FROM events GROUP BY event_type
""",
    "stream_z_ingest": "SELECT source, doc_id, lang, n_chars FROM documents",
    "stream_keyed_load": NEWEST_CELLS,
    "bulk_load_audit": """
SELECT 'job-1' AS job_id, 'events' AS record_type, 'ok' AS status, count(*) AS n_rows,
       CAST(count(*) FILTER (WHERE event_id%97 = 0) AS BIGINT) AS n_bad FROM events
""",
    "bulk_load_altered": "SELECT 'text' AS codec, count(*) AS n_rows, count(*) AS n_stored FROM events WHERE user_id % 2 = 0",
    "bulk_load": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
}
