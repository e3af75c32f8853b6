"""Files listed and opened by the tasks, whatever their names and sizes.

Spark's file sources index files on the driver, leave names like ``_x`` and ``.x``
out and hold each binary file as one value.  Here folders and paths are rows: tasks
list folders, level by level, and open files themselves.  Work is dealt out in groups
of bounded bytes, one task each, and only paths are shuffled.

File systems are opened with ``pyarrow.fs``; ``can_open`` tells which of them the
executors can open.  Others are left to Spark's own sources.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileload.functions.paths import is_hidden, opener, root_of, spelled_uri
from fileload.session import stage_table

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("uri", T.StringType()),
    ]
)
#: Bytes a task reads.
GROUP_BYTES = 64 << 20
#: Folders a task lists.
FOLDERS_AT_ONCE = 64
#: Rows summed up by one task when groups are numbered.
BUCKET_ROWS = 50_000
MOST_BUCKETS = 10_000
#: What a file costs a task besides its bytes.
OPEN_BYTES = 256 << 10
#: The largest value Spark holds.
MOST_BYTES = (1 << 31) - 1 - (1 << 20)
#: Rows of a listing leave a task in batches of so many.
BATCH_ROWS = 50_000


def can_open(spark: SparkSession, paths: DataFrame, path_col: str = "path") -> set[str]:
    """The file systems among the paths that tasks can open.  There are few of them."""

    @F.arrow_udf("boolean")
    def opens(roots: pa.Array) -> pa.Array:
        found, open_fs = [], opener()
        for root in roots.to_pylist():
            try:
                open_fs(root)
                found.append(True)
            except (ValueError, OSError, ImportError, pa.ArrowException):
                found.append(False)
        return pa.array(found)

    roots = paths.select(root_of(F.col(path_col)).alias("root")).distinct()
    return {row.root for row in roots.select("root", opens("root").alias("opens")).collect() if row.opens}


def in_groups(df: DataFrame, size, bound: int) -> tuple[DataFrame, int]:
    """``df`` with ``group``, from 0 without gaps, and the number of groups.  A group
    holds at most ``bound`` of ``size`` and one row's more; a row of more than that has
    a group of its own or shares it with the last of the rows before.

    Rows are spread over buckets and summed up in each; the sums of the buckets, a
    bounded number, are all the driver sees.  ``df`` must be a stored table.
    """
    buckets = min(MOST_BUCKETS, max(1, math.ceil(df.count() / BUCKET_ROWS)))
    bucket = F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int")
    sized = df.withColumns({"__bucket": bucket, "__size": F.least(F.coalesce(size, F.lit(0)) + 1, F.lit(bound)).cast("double")})
    sums = {row["__bucket"]: row["s"] for row in sized.groupBy("__bucket").agg(F.sum("__size").alias("s")).collect()}
    base, before = 0.0, {}
    for number in sorted(sums):
        before[number], base = base, base + sums[number]
    groups = max(1, math.ceil(base / bound))
    order = "path" if "start" not in df.columns else "path, start"
    running = F.expr(f"sum(__size) OVER (PARTITION BY __bucket ORDER BY {order} ROWS UNBOUNDED PRECEDING)")
    starts = df.sparkSession.createDataFrame(list(before.items()) or [(0, 0.0)], "__bucket int, __base double")
    place = F.floor((F.col("__base") + running - F.col("__size")) / bound)
    numbered = sized.join(F.broadcast(starts), "__bucket").withColumn("group", F.least(place, F.lit(groups - 1)).cast("int"))
    return numbered.drop("__bucket", "__size", "__base"), groups


def dealt(df: DataFrame, size, bound: int) -> DataFrame:
    """``df`` with one partition for each group."""
    numbered, groups = in_groups(df, size, bound)
    return numbered.repartitionById(groups, F.col("group")).drop("group")


def _milliseconds(info: pafs.FileInfo) -> int | None:
    # Hadoop knows times to the millisecond, and the ledger compares.
    return None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1_000


def _children(folder: str, open_fs) -> Iterator[tuple[str, pafs.FileInfo]]:
    """Qualified path and facts of all a folder holds; of none if there is no folder."""
    fs, name = open_fs(folder)
    top = folder.rstrip("/")
    for info in fs.get_file_info(pafs.FileSelector(name, recursive=False, allow_not_found=True)):
        yield f"{top}/{info.base_name}", info


def list_level(folders: DataFrame) -> DataFrame:
    """What the ``folder`` rows hold, not what lies deeper: files and folders, told
    apart by ``is_folder``.  Names of every kind and files of no bytes are seen."""
    schema = T.StructType([*LISTING.fields, T.StructField("is_folder", T.BooleanType())])

    def run(batches):
        open_fs, held = opener(), []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held)) if held else [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for given in batches:
            for folder in given.column(0).to_pylist():
                for path, info in _children(folder, open_fs):
                    held.append((path, info.size, _milliseconds(info), spelled_uri(path), info.type == pafs.FileType.Directory))
                    if len(held) == BATCH_ROWS:
                        yield batch()
                        held = []
        yield batch()

    return folders.select("folder").mapInArrow(run, schema)


def list_folders(spark: SparkSession, folders: DataFrame) -> DataFrame:
    """The files right under the folders (qualified paths), as a table."""
    spread = stage_table(folders.select(F.col("folder"), F.col("folder").alias("path")), "folders")
    level = list_level(dealt(spread, F.lit(1), FOLDERS_AT_ONCE))
    return stage_table(level.where("not is_folder").drop("is_folder"), "listing")


def walk(spark: SparkSession, folders: DataFrame, hidden: bool) -> DataFrame:
    """All files under the folders, as one table: one round for each level of depth,
    in which tasks list the folders that the level before has found.  Without
    ``hidden``, neither hidden files nor what is in hidden folders."""
    found, todo = [], folders.select("folder")
    while True:
        spread = stage_table(todo.select("folder", F.col("folder").alias("path")).distinct(), "folders")
        level = list_level(dealt(spread, F.lit(1), FOLDERS_AT_ONCE))
        level = stage_table(level if hidden else level.where(~is_hidden(F.col("path"))), "level")
        found.append(level.where("not is_folder").drop("is_folder"))
        todo = level.where("is_folder").select(F.col("path").alias("folder"))
        if todo.isEmpty():
            break
    result = found[0]
    for level in found[1:]:
        result = result.unionByName(level)
    return result


def read_content(files: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """``files`` (``path``, ``length`` and any others, a stored table) with ``content``
    and ``status``: ``ok``, ``missing`` for a path that is gone, ``oversize`` for one
    too large to be a value.  One partition for each group of bytes; a file is a row,
    and rows leave a task one by one."""
    keep = [name for name in files.columns if name not in ("content", "status")]
    at = keep.index("path")
    schema = T.StructType(
        [*(files.schema[name] for name in keep), T.StructField("content", T.BinaryType()), T.StructField("status", T.StringType())]
    )

    def run(batches):
        open_fs = opener()
        for batch in batches:
            for row in range(batch.num_rows):
                status, content = _content(batch.column(at)[row].as_py(), open_fs, most)
                columns = [batch.column(i).slice(row, 1) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([content], pa.binary()), pa.array([status])], names=schema.names
                )

    return dealt(files.select(*keep), F.col("length") + OPEN_BYTES, GROUP_BYTES).select(*keep).mapInArrow(run, schema)


def _content(path: str, open_fs, most: int) -> tuple[str, bytes | None]:
    fs, name = open_fs(path)
    info = fs.get_file_info(name)
    if not info.is_file:
        return "missing", None
    if info.size > most:
        return "oversize", None
    with fs.open_input_file(name) as file:
        return "ok", file.read()
