"""Input files: listing, fetching by manifest, and text scans of any codec."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileload.functions.paths import existing, is_hidden, literal_glob, opener, parent, qualify, root_of, working_uri
from fileload.functions.text import decoded, without_cr
from fileload.operators.line_numbers import place
from fileload.session import stage_dir, stage_table
from fileload.sources.bypath import LISTING, can_open, list_folders, read_content, walk

# One wave of files is what the driver names, and what is broadcast, at a time.
WAVE_FILES = 20_000
WAVE_BYTES = 8 << 20

# Columns that tell of the file itself.
FOUND = {"path", "length", "modificationTime", "uri", "content", "n_listed", "listed_path", "route", "wave", "by_path"}

# Folders the driver lists at a time.
LIST_FOLDERS = 2_000

# Every name but *.Z, which has no Hadoop codec and would be read as raw bytes.
NOT_Z = "{*[!Z],*[!.]Z,Z}"


def list_files(spark: SparkSession, folders: list[str], hidden: bool = False) -> DataFrame:
    """``path, length, modificationTime, uri`` of all files under the folders.
    No file is opened; ``uri`` is the spelling scans report in their metadata.

    Tasks list the folders level by level, empty files included and, on request, those
    that scans never read; a file system that tasks cannot open is indexed by Spark's
    driver, which leaves both out."""
    given = spark.createDataFrame([(working_uri(spark, folder),) for folder in folders], "folder string")
    openable = root_of(F.col("folder")).isin(*can_open(spark, given, "folder"))
    result = walk(spark, given.where(openable), hidden)
    rest = [row.folder for row in given.where(~openable).collect()]
    return result.unionByName(_indexed(spark, rest)) if rest else result


def _indexed(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Spark's own recursive index of the folders."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load([literal_glob(folder) for folder in folders])
        .select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))
    )


def manifest_files(
    spark: SparkSession, manifest_df: DataFrame, path_col: str, base_uri: str | None = None
) -> DataFrame:
    """One row per listed path, found or not.

    A path listed more than once is one row: the smallest manifest line wins and
    ``n_listed`` counts them.  ``status`` is ``ok`` or ``missing``.  Tasks list the
    folders the paths are in, and nothing below them; a folder that is not listed
    costs nothing.  Of a file system tasks cannot open, names that Spark's file
    sources never read are ``hidden``.
    """
    columns = [name for name in manifest_df.columns if name not in ("status", path_col)]
    if FOUND & set(columns):
        raise ValueError(f"manifest columns {sorted(FOUND & set(columns))} would hide those of the files")
    listed = F.col(path_col)
    usable = listed.isNotNull() & (listed != "")
    if "status" in manifest_df.columns:
        usable &= F.col("status") != "empty"
    ordered = sorted(columns, key=lambda name: name != "value")
    named = (
        manifest_df.where(usable)
        .select(
            qualify(listed, working_uri(spark, base_uri)).alias("path"),
            F.struct(*ordered, listed.alias("listed_path")).alias("entry"),
        )
        .groupBy("path")
        .agg(F.min("entry").alias("entry"), F.count("*").alias("n_listed"))
    )
    named = stage_table(named, "manifest")
    openable = root_of(F.col("path")).isin(*can_open(spark, named))
    by_tasks, by_index = named.where(openable), named.where(~openable)
    files = _facts(by_tasks, list_folders(spark, by_tasks.select(parent(F.col("path")).alias("folder")).distinct()), columns)
    if by_index.isEmpty():
        return stage_table(files, "files")
    found = _listed(spark, by_index.select(parent(F.col("path")).alias("folder")).distinct())
    others = stage_table(_facts(by_index, found, columns), "files")
    absent = F.col("status") == "missing"
    return stage_table(
        files.unionByName(others.where(~absent)).unionByName(_with_empty_files(others.where(absent))), "files"
    )


def _facts(named: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    return named.join(found, "path", "left").select(
        "path",
        "length",
        "modificationTime",
        "uri",
        *[F.col(f"entry.{name}").alias(name) for name in columns],
        F.col("entry.listed_path").alias("listed_path"),
        "n_listed",
        F.when(F.col("length").isNotNull(), "ok").when(is_hidden(F.col("path")), "hidden").otherwise("missing").alias("status"),
    )


def _listed(spark: SparkSession, folders_df: DataFrame) -> DataFrame:
    """Listing of all the folders, as a table.  The driver indexes one group of
    folders at a time."""
    nothing = spark.createDataFrame([], LISTING)
    folders = stage_table(folders_df, "folders")
    groups = max(1, -(-folders.count() // LIST_FOLDERS))

    def group(folder):
        return F.pmod(F.xxhash64(folder), F.lit(groups))

    table = stage_dir(spark, "listing")
    nothing.write.parquet(table)
    for number in range(groups):
        names = existing(spark, [row.folder for row in folders.where(group("folder") == number).collect()])
        if names:
            # A folder inside another is seen with both, and counts in its own group.
            files = _indexed(spark, names).where(group(parent(F.col("path"))) == number)
            files.write.mode("append").parquet(table)
    return spark.read.schema(LISTING).parquet(table)


def _with_empty_files(absent_df: DataFrame) -> DataFrame:
    """Spark's listing leaves out files of no bytes, so paths it did not give
    are looked up one by one, by the tasks.  A file system that a task cannot open
    fails the task: whether a file is absent is not known then."""

    @F.arrow_udf("bigint")
    def empty_since(paths: pa.Array) -> pa.Array:
        found, open_fs = [], opener()
        for path in paths.to_pylist():
            fs, name = open_fs(path)
            info = fs.get_file_info(name)
            found.append(info.mtime_ns // 1000 if info.is_file and info.size == 0 else None)
        return pa.array(found, pa.int64())

    is_empty = F.col("__since").isNotNull()
    return (
        absent_df.withColumn("__since", empty_since("path"))
        .withColumns(
            {
                "status": F.when(is_empty, "ok").otherwise(F.col("status")),
                "length": F.when(is_empty, F.lit(0).cast("bigint")),
                "modificationTime": F.timestamp_micros("__since"),
                "uri": F.when(is_empty, F.col("path")),
            }
        )
        .drop("__since")
    )


def with_waves(files_df: DataFrame, max_files: int = WAVE_FILES, max_bytes: int = WAVE_BYTES) -> tuple[DataFrame, int]:
    """Spread files over waves by a hash of their path, so that a wave is about
    half of ``max_files`` files and ``max_bytes`` of descriptor text."""
    text = [F.octet_length(name) for name, kind in files_df.dtypes if kind == "string"]
    size = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(64))
    count, total = files_df.agg(F.count("*"), F.sum(size.cast("bigint"))).first()
    waves = max(1, -(-2 * count // max_files), -(-2 * (total or 0) // max_bytes))
    return files_df.withColumn("wave", F.pmod(F.xxhash64("path"), F.lit(waves)).cast("int")), waves


def file_fetch(
    spark: SparkSession,
    manifest_df: DataFrame,
    path_col: str,
    base_uri: str | None = None,
    max_files: int = WAVE_FILES,
) -> DataFrame:
    """The files a manifest names, with their content and manifest columns.

    Only the named files are opened, by tasks that each take a group of bounded
    bytes, so the plan has one scan of paths however many files there are.  Files that
    are absent come back as rows with ``status='missing'`` and no content, and so do
    those too large for one value, as ``oversize``.  Content is never shuffled.

    Files of a file system tasks cannot open are read by Spark's binary source,
    ``max_files`` of them to a scan.
    """
    files = manifest_files(spark, manifest_df, path_col, base_uri)
    openable = root_of(F.col("path")).isin(*can_open(spark, files))
    keep = [name for name in files.columns if name != "uri"]
    columns = [*keep, "content"]
    there = F.col("status") == "ok"
    mine = stage_table(files.where(openable & there).select(*keep), "fetch")
    nothing = F.lit(None).cast("binary").alias("content")
    result = files.where(openable & ~there).select(*keep, nothing).unionByName(read_content(mine).select(*columns))
    rest = files.where(~openable)
    return result if rest.isEmpty() else result.unionByName(_scanned(spark, rest, keep, max_files))


def _scanned(spark: SparkSession, files: DataFrame, keep: list[str], max_files: int) -> DataFrame:
    """Content by Spark's binary source, the files' side broadcast a bounded wave at a time."""
    files, waves = with_waves(files, max_files)
    readable = (F.col("status") == "ok") & (F.col("length") > 0)
    nothing = F.when(F.col("status") == "ok", F.lit(b"")).cast("binary").alias("content")
    result = files.where(~readable | F.col("length").isNull()).select(*keep, nothing)
    for wave in range(waves):
        part = files.where((F.col("wave") == wave) & readable)
        paths = [row.path for row in part.select("path").collect()]
        if not paths:
            continue
        scan = spark.read.format("binaryFile").load([literal_glob(p) for p in paths]).select("path", "content")
        joined = scan.join(F.broadcast(part.select(*keep)), "path").select(*keep, "content")
        result = result.unionByName(joined)
    return result


def codec_text_scan(
    spark: SparkSession, paths: str | list[str], charset: str = "UTF-8", places: bool = False, **options: str
) -> DataFrame:
    """Lines of text files, plain or compressed with a codec told by the suffix
    (.gz, .bz2, .deflate, .snappy).  ``.Z`` files are left to ``z_ingest``.

    A line ends at a newline; one carriage return before it is dropped.  With
    ``places``, rows carry what ``line_numbers`` needs once they are written.
    """
    scan = spark.read.option("lineSep", "\n").option("pathGlobFilter", NOT_Z).options(**options).text(paths)
    return scan.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        *(place() if places else []),
        decoded(F.col("value"), charset).alias("line"),
    ).withColumn("line", without_cr(F.col("line")))
