"""The load as an incremental job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fileload.config import LoadConfig, check_job_id, check_names
from fileload.functions.text import decoded, without_cr
from fileload.functions.paths import exists
from fileload.operators.keyed import keyed_load
from fileload.operators.line_numbers import BLOCK, ROW, blocks_of, with_line_numbers
from fileload.operators.records import BAD, record_parse, record_spec
from fileload.operators.routing import lineage_stamp, take_route
from fileload.operators.unz import z_ingest
from fileload.session import DECODE_CONF, TWO_FOLDERS_CONF, conf_scope
from fileload.sinks.detail import detail_write, job_folder
from fileload.sinks.keyed_table import KeyedTable
from fileload.sources.files import NOT_Z

# Files are told apart by name alone.  Spark's default passes over files more than
# a week older than the newest seen, which would lose late copies of old files.
ANY_AGE = "36500d"

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _source(spark: SparkSession, codec: str, archive_path: str | None, per_trigger: dict[str, int]):
    reader = spark.readStream.options(maxFileAge=ANY_AGE, **{name: str(value) for name, value in per_trigger.items()})
    if archive_path:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_path)
    if codec == "z":
        return reader.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.Z")
    if codec == "text":
        return reader.format("text").option("lineSep", "\n").option("pathGlobFilter", NOT_Z)
    raise ValueError(f"codec must be 'text' or 'z', not {codec!r}")


def _rows(stream: DataFrame, codec: str, charset: str) -> DataFrame:
    """Payloads of a ``.Z`` source, lines of a text source."""
    if codec == "z":
        return stream.select(F.col("_metadata.file_path").alias("path"), "length", "modificationTime", "content")
    lines = stream.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.lit("line").alias("kind"),
        F.lit(None).cast("bigint").alias("line_no"),
        decoded(F.col("value"), charset).alias("line"),
        F.lit("ok").alias("status"),
        F.lit(None).cast("bigint").alias("n_lines"),
        F.lit(None).cast("bigint").alias("n_bytes"),
    )
    return lines.withColumn("line", without_cr(F.col("line")))


def stream_lines(
    spark: SparkSession,
    input_path: str,
    charset: str = "UTF-8",
    codec: str = "text",
    archive_path: str | None = None,
    mode: str = "PERMISSIVE",
    **per_trigger: int,
) -> DataFrame:
    """A stream of the rows ``z_ingest`` or ``codec_text_scan`` give in batch.
    ``per_trigger`` takes ``maxFilesPerTrigger`` and ``maxBytesPerTrigger``."""
    rows = _rows(_source(spark, codec, archive_path, per_trigger).load(input_path), codec, charset)
    return z_ingest(rows, charset, mode) if codec == "z" else rows


def _blocks_folder(detail_path: str, job_id: str, scope: dict[str, int] | None = None) -> str:
    return job_folder(f"{detail_path.rstrip('/')}/_blocks", job_id, scope)


def _oversize(batch: DataFrame, max_file_size: int) -> DataFrame:
    """One file row for each file above the limit."""
    big = take_route(batch, max_file_size, "oversize").select("path", "length", "modificationTime").distinct()
    return big.withColumns({"kind": F.lit("file"), "status": F.lit("oversize")})


def stream_ingest(
    spark: SparkSession,
    input_path: str,
    record_type: str,
    detail_path: str,
    checkpoint: str,
    job_id: str,
    codec: str = "text",
    archive_path: str | None = None,
    max_file_size: int | None = None,
    mode: str = "PERMISSIVE",
    keyed: dict | None = None,
    table: KeyedTable | None = None,
    **per_trigger: int,
) -> StreamingQuery:
    """Load every file not loaded before, then stop.

    The checkpoint takes the place of the ledger.  A micro-batch replaces its
    own folder ``job_id=…/batch=…``, so a batch that is run again is not loaded
    twice; a job id belongs to one checkpoint.  Files above ``max_file_size`` are
    recorded (``stream_files``) and not loaded.  With ``table``, the batch's rows
    that parse are also loaded into it (``keyed`` holds the arguments of ``keyed_load``).
    Handled files move to ``archive_path``; those of the last batch follow when
    a later batch runs.
    """
    check_job_id(job_id)
    check_names(record_type)
    charset = record_spec(record_type).charset
    inputs = _rows(_source(spark, codec, archive_path, per_trigger).load(input_path), codec, charset)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        if codec == "text":
            # Numbers along a task's rows, before anything sets rows aside.
            batch = batch.withColumn(ROW, F.monotonically_increasing_id())
        rows = batch if max_file_size is None else take_route(batch, max_file_size, "normal")
        rows = z_ingest(rows, charset, mode) if codec == "z" else rows
        if max_file_size is not None:
            rows = rows.unionByName(_oversize(batch, max_file_size), allowMissingColumns=True)
        parsed = lineage_stamp(record_parse(rows, record_type), job_id)
        with conf_scope(batch.sparkSession, {**TWO_FOLDERS_CONF, **(DECODE_CONF if codec == "z" else {})}):
            folder = detail_write(parsed, detail_path, job_id, ["kind"], scope={"batch": batch_id})
        if codec == "text":
            stored = batch.sparkSession.read.schema(parsed.schema).parquet(folder).where("kind = 'line'")
            blocks_of(stored).write.mode("overwrite").parquet(_blocks_folder(detail_path, job_id, {"batch": batch_id}))
        if table is not None:
            loaded = batch.sparkSession.read.schema(parsed.schema).parquet(folder)
            good = loaded.where((F.col("kind") == "line") & F.col(BAD).isNull())
            table.load(keyed_load(None, good, **keyed))

    return (
        inputs.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_load(spark: SparkSession, config: LoadConfig, input_path: str, checkpoint: str, **options) -> StreamingQuery:
    """``stream_ingest`` with the settings of a batch job."""
    return stream_ingest(
        spark,
        input_path,
        config.record_type,
        config.detail_path,
        checkpoint,
        config.job_id,
        archive_path=config.archive_path,
        max_file_size=config.max_file_size,
        mode=config.mode,
        **options,
    )


def stream_detail(spark: SparkSession, detail_path: str, job_id: str) -> DataFrame:
    """The typed rows an incremental job has written so far, each with the number of
    its line."""
    rows = spark.read.parquet(job_folder(detail_path, job_id)).where("kind = 'line'")
    blocks = _blocks_folder(detail_path, job_id)
    if exists(spark, blocks):
        rows = with_line_numbers(rows, spark.read.parquet(blocks))
    return rows.drop("kind", "batch", "status", "n_lines", "n_bytes").withColumn("job_id", F.lit(job_id))


def stream_files(spark: SparkSession, detail_path: str, job_id: str) -> DataFrame:
    """Status of the ``.Z`` files, and of files above the size limit."""
    rows = spark.read.parquet(job_folder(detail_path, job_id)).where("kind = 'file'")
    wanted = ["src_path", "src_length", "src_mtime", "status", "n_lines", "n_bytes"]
    return rows.select(F.lit(job_id).alias("job_id"), *wanted)
