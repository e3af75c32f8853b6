"""The batch load job: manifest to detail tables, ledger and audit."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileload.config import STAMPS, LoadConfig
from fileload.functions.paths import existing, exists, is_hidden, is_z, literal_glob, remove, root_of
from fileload.operators.audit import altered, content_sum, load_audit
from fileload.operators.line_numbers import BLOCK, ROW, blocks_of, with_line_numbers
from fileload.operators.ledger import commit, ledger, marked
from fileload.operators.manifest import manifest_parse
from fileload.operators.records import BAD, record_parse, record_spec
from fileload.operators.routing import lineage_stamp, size_route
from fileload.operators.text_files import task_can_read, text_ingest_files
from fileload.operators.unz import z_ingest, z_ingest_files
from fileload.session import DECODE_CONF, TWO_FOLDERS_CONF, conf_scope, stage_scope, stage_table
from fileload.sinks.detail import detail_write, job_folder
from fileload.sources.bypath import can_open
from fileload.sources.files import codec_text_scan, manifest_files, with_waves
from fileload.sources.manifest import manifest_scan

# Files per wave: the paths of one wave are all the driver ever names at once.
LOAD_WAVE_FILES = 200_000
LOAD_WAVE_BYTES = 128 << 20

FILE_COLUMNS = ("status", "n_lines", "n_bytes")


@dataclass(frozen=True)
class LoadResult:
    """Where a finished job's tables are."""

    spark: SparkSession
    config: LoadConfig

    def written(self) -> DataFrame:
        """All rows the job has written, of lines and of files."""
        return _written(self.spark, self.config).withColumn("job_id", F.lit(self.config.job_id))

    def detail(self) -> DataFrame:
        """The typed rows, each with the number of its line."""
        rows = self.written().where("kind = 'line'").drop("kind", "codec", "wave", *FILE_COLUMNS)
        return with_line_numbers(rows, _blocks(self.spark, self.config))

    def files(self) -> DataFrame:
        """One row per manifest path with what became of it."""
        same = self.config.record_type
        read = self.written().where("kind = 'file'")
        loaded = read.select("job_id", "src_path", "src_length", "src_mtime", *FILE_COLUMNS)
        others = plan(self.spark, self.config).where("status <> 'ok'")
        others = others.select(
            F.lit(self.config.job_id).alias("job_id"),
            F.coalesce("uri", "path").alias("src_path"),
            F.col("length").alias("src_length"),
            F.col("modificationTime").alias("src_mtime"),
            "status",
        )
        return loaded.unionByName(others, allowMissingColumns=True).withColumn("record_type", F.lit(same))

    def audit(self) -> DataFrame:
        """Row, bad row and byte counts per file, from the written tables."""
        detail = self.written().where("kind = 'line'").withColumn("record_type", F.lit(self.config.record_type))
        return load_audit(detail, self.files())

    def altered(self) -> DataFrame:
        """Parts of the job (``wave, codec``) whose stored rows are not the rows that
        passed by when they were written: ``n_rows`` then, ``n_stored`` now.  Unlike
        counts, this sees a row that was changed or exchanged for another."""
        line = F.col("kind") == "line"
        stored = _written(self.spark, self.config).groupBy("wave", "codec").agg(*content_sum(_content(self.config), line))
        folder = _part_folder(self.config, "_checks")
        if not exists(self.spark, folder):
            return altered(self.spark.createDataFrame([], CHECKS), stored, ["wave", "codec"])
        return altered(self.spark.read.schema(CHECKS).parquet(folder), stored, ["wave", "codec"])

    def miscounted(self, expected_col: str) -> DataFrame:
        """Files whose rows are not as many as a manifest field says, the one way
        to see that a ``.Z`` file was cut short.  Files this job did not read, since
        an earlier one had or they are absent or too large, are not compared."""
        expected = plan(self.spark, self.config).where("status = 'ok'").select(
            F.coalesce("uri", "path").alias("src_path"), F.col(expected_col).try_cast("bigint").alias("n_expected")
        )
        return self.audit().join(expected.where("n_expected is not null"), "src_path").where("n_rows <> n_expected")


def _written(spark: SparkSession, config: LoadConfig, **scope: int) -> DataFrame:
    folder = job_folder(config.detail_path, config.job_id, scope)
    schema = T.StructType([*record_spec(config.record_type).schema.fields, *STAMPS.fields])
    return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)


CHECKS = "codec string, n_rows bigint, content decimal(38,0), wave int"


def _part_folder(config: LoadConfig, part: str, scope: dict[str, int] | None = None) -> str:
    """Where what belongs to a job's detail rows is kept beside them."""
    return job_folder(f"{config.detail_path.rstrip('/')}/{part}", config.job_id, scope)


def _content(config: LoadConfig) -> list[str]:
    """Columns that make up a row's content."""
    return [*record_spec(config.record_type).schema.names, BAD, "line_no", BLOCK, ROW, "src_path"]


def _blocks(spark: SparkSession, config: LoadConfig) -> DataFrame:
    """How many lines come before each block of the text files."""
    schema = "src_path string, block bigint, first_row bigint, lines_before bigint"
    folder = _part_folder(config, "_blocks")
    return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)


def _plan_folder(config: LoadConfig) -> str:
    return job_folder(f"{config.ledger_path.rstrip('/')}/_plan", config.job_id)


def plan(spark: SparkSession, config: LoadConfig) -> DataFrame:
    """The stored plan of a job: one row per path with its status and wave."""
    return spark.read.parquet(_plan_folder(config))


def _identity(spark: SparkSession, config: LoadConfig, manifest_path: str) -> str:
    """Tells a job's manifest (its lines, in any order) and settings from others."""
    lines = manifest_scan(spark, manifest_path).agg(F.count("*"), F.sum(F.xxhash64("value").cast("decimal(38,0)"))).first()
    settings = {**asdict(config), "layout": list(config.layout)}
    if config.max_bytes_per_file is None:
        # Jobs planned before there was this setting go on.
        del settings["max_bytes_per_file"]
    return json.dumps({"lines": str(lines[0]), "sum": str(lines[1]), **settings}, sort_keys=True)


def _check_identity(spark: SparkSession, config: LoadConfig, manifest_path: str) -> None:
    """A job id belongs to one manifest and one set of settings."""
    stored = spark.read.text(f"{_plan_folder(config)}/_identity", wholetext=True).first()
    if stored is None or stored[0].strip() != _identity(spark, config, manifest_path):
        raise ValueError(f"job {config.job_id!r} was planned with another manifest or other settings")


def make_plan(spark: SparkSession, config: LoadConfig, manifest_path: str, wave_files: int) -> None:
    """Decide once, from the manifest and file listing alone, what each listed
    path's part in the job is.  A rerun follows the stored plan."""
    lines = manifest_parse(manifest_scan(spark, manifest_path), config.layout, config.sep)
    files = manifest_files(spark, lines, config.path_col, config.base_uri)
    # Who reads a file: tasks, by its path, or a scan of Spark's.  A scan takes a whole
    # .Z payload as one value, which has a ceiling of its own, and no hidden names.
    openable = root_of(F.col("path")).isin(*can_open(spark, files))
    hidden = is_hidden(F.col("path"))
    files = files.withColumn("by_path", openable & (is_z(F.col("path")) | hidden & task_can_read(F.col("path"))))
    ceiling = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    too_large = is_z(F.col("path")) & ~F.col("by_path") & (F.col("length") > ceiling)
    files = size_route(files, config.max_file_size).withColumn(
        "status",
        F.when(F.col("status") != "ok", F.col("status"))
        .when(is_z(F.col("path")) & (F.col("length") == 0), "bad_magic")
        .when((F.col("route") == "oversize") | too_large, "oversize")
        .when(hidden & ~F.col("by_path"), "hidden")
        .otherwise("ok"),
    )
    files, _ = with_waves(files, wave_files, LOAD_WAVE_BYTES)
    done = ledger(spark, config.ledger_path)
    if done is not None:
        # The ledger knows files by the spelling scans report.
        spelled = stage_table(files.withColumns({"listed": F.col("path"), "path": F.coalesce("uri", "path")}), "spelled")
        loaded = F.col("handled") & (F.col("status") == "ok")
        files = marked(spelled, done).withColumns(
            {"path": F.col("listed"), "status": F.when(loaded, "already_loaded").otherwise(F.col("status"))}
        ).drop("listed", "handled")
    # A folder per wave, so that a wave reads its own part of the plan only.
    files.hint("rebalance", "wave").write.mode("overwrite").partitionBy("wave").parquet(_plan_folder(config))
    mark = spark.createDataFrame([(_identity(spark, config, manifest_path),)], "value string")
    mark.coalesce(1).write.mode("overwrite").text(f"{_plan_folder(config)}/_identity")


def run_load(
    spark: SparkSession, config: LoadConfig, manifest_path: str, wave_files: int = LOAD_WAVE_FILES
) -> LoadResult:
    """Load the files a manifest names.

    Files go in waves.  Each wave is one pass over its files that writes typed
    rows and per-file status together, then its ledger entry.  Running the same
    job again redoes only waves without a ledger entry, each into its own
    folder, so it ends with the same tables.
    """
    if config.archive_path:
        raise ValueError("archive_path (inputBakPath) is for the incremental job; a batch job moves no inputs")
    if exists(spark, f"{_plan_folder(config)}/_identity/_SUCCESS"):
        _check_identity(spark, config, manifest_path)
    else:
        with stage_scope(spark):
            make_plan(spark, config, manifest_path, wave_files)
    planned = plan(spark, config)
    bad = planned.where("status in ('missing', 'hidden', 'bad_magic')").select("path", "status").head()
    if bad and config.mode.upper() == "FAILFAST":
        kind = ValueError if bad.status == "bad_magic" else FileNotFoundError
        raise kind(f"{bad.path}: {bad.status}")
    if config.oversize_path:
        # In manifest form again, ready for a job with a higher limit.
        folder = job_folder(config.oversize_path, config.job_id)
        planned.where("status = 'oversize'").select("value").write.mode("overwrite").text(folder)
    waves = [r.wave for r in planned.where("status = 'ok'").select("wave").distinct().collect()]
    for wave in sorted(waves):
        done = f"{job_folder(config.ledger_path, config.job_id, {'wave': wave})}/_SUCCESS"
        if not exists(spark, done):
            part = planned.where((F.col("wave") == wave) & (F.col("status") == "ok"))
            with stage_scope(spark):
                try:
                    _load_wave(spark, config, part, wave)
                except AnalysisException as error:
                    if error.getCondition() != "PATH_NOT_FOUND":
                        raise
                    _load_wave(spark, config, _mark_gone(spark, part), wave, some_gone=True)
    return LoadResult(spark, config)


def _mark_gone(spark: SparkSession, files: DataFrame) -> DataFrame:
    """A wave's files, those deleted since the plan was made as ``missing``."""
    there = existing(spark, [row.path for row in files.select("path").collect()])
    found = spark.createDataFrame([(path,) for path in there], "path string")
    gone = files.join(found, "path", "left_anti").withColumn("status", F.lit("missing"))
    return files.join(found, "path", "left_semi").unionByName(gone)


def _load_wave(
    spark: SparkSession, config: LoadConfig, files: DataFrame, wave: int, some_gone: bool = False
) -> None:
    # What an attempt that did not get as far as its ledger entry has left.
    remove(spark, job_folder(config.detail_path, config.job_id, {"wave": wave}))
    charset = record_spec(config.record_type).charset
    usable, by_path = files.where("status = 'ok'"), F.col("by_path")
    zs, texts = [], []
    for row in usable.where(~by_path).select("path").toLocalIterator():
        (zs if row.path.endswith(".Z") else texts).append(literal_glob(row.path))

    checks = []

    def write(rows: DataFrame, codec: str, conf: dict[str, str]) -> None:
        places = {name: F.lit(None).cast("bigint") for name in (BLOCK, ROW) if name not in rows.columns}
        parsed = lineage_stamp(record_parse(rows.withColumns(places), config.record_type), config.job_id)
        scope, passing = {"wave": wave, "codec": codec}, Observation()
        observed = parsed.observe(passing, *content_sum(_content(config), F.col("kind") == "line"))
        with conf_scope(spark, {**TWO_FOLDERS_CONF, **conf}):
            detail_write(
                observed, config.detail_path, config.job_id, ["kind"], config.max_records_per_file, scope,
                max_bytes_per_file=config.max_bytes_per_file,
            )
        checks.append((codec, passing.get["n_rows"], passing.get["content"], wave))

    # A bad file has no lines to drop, and its status row stays in any mode.
    mode = "FAILFAST" if config.mode.upper() == "FAILFAST" else "PERMISSIVE"
    opened = usable.where(by_path)
    kinds = {row.z for row in opened.select(is_z(F.col("path")).alias("z")).distinct().collect()}
    if True in kinds:
        write(z_ingest_files(opened.where(is_z(F.col("path"))), charset, mode), "z-path", DECODE_CONF)
    if False in kinds:
        write(text_ingest_files(opened.where(~is_z(F.col("path"))), charset), "text-path", DECODE_CONF)
    if zs:
        scan = spark.read.format("binaryFile").load(zs)
        payloads = scan.select(F.col("_metadata.file_path").alias("path"), "length", "modificationTime", "content")
        write(z_ingest(payloads, charset, mode), "z", DECODE_CONF)
    # Text files, and whatever gets no row from the decoder, have their file rows here.
    scanned = ~is_z(F.col("path")) & ~by_path
    rows = files.where(scanned | (F.col("status") != "ok")).select(
        F.col("uri").alias("path"), "length", "modificationTime", F.lit("file").alias("kind"), "status"
    )
    if texts:
        lines = codec_text_scan(spark, texts, charset, places=True)
        rows = lines.withColumns({"kind": F.lit("line"), "status": F.lit("ok")}).unionByName(rows, allowMissingColumns=True)
    else:
        rows = rows.withColumns({"line": F.lit(None).cast("string"), BLOCK: F.lit(None).cast("bigint"), ROW: F.lit(None).cast("bigint")})
    if texts or some_gone:
        unknown = ("line_no", "n_lines", "n_bytes")
        write(rows.withColumns({name: F.lit(None).cast("bigint") for name in unknown}), "text", {})
    if texts:
        written = _written(spark, config, wave=wave).where("kind = 'line'")
        blocks_of(written).write.mode("overwrite").parquet(_part_folder(config, "_blocks", {"wave": wave}))
    status = _written(spark, config, wave=wave).where("kind = 'file' and status <> 'missing'").withColumnsRenamed(
        {"src_path": "path", "src_length": "length", "src_mtime": "modificationTime"}
    )
    kept = spark.createDataFrame(checks, CHECKS).drop("wave").coalesce(1)
    kept.write.mode("overwrite").parquet(_part_folder(config, "_checks", {"wave": wave}))
    commit(config.ledger_path, status, config.job_id, wave)
