"""Size routing and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileload.config import check_job_id


def size_route(files_df: DataFrame, max_file_size: int) -> DataFrame:
    """Add ``route``: ``oversize`` above the limit, ``normal`` up to it."""
    return files_df.withColumn("route", F.when(F.col("length") > max_file_size, "oversize").otherwise("normal"))


def take_route(files_df: DataFrame, max_file_size: int, route: str) -> DataFrame:
    """The files of one route.  The test is on ``length`` alone, so a file scan
    applies it before it opens anything."""
    if route not in ("normal", "oversize"):
        raise ValueError(f"unknown route {route!r}")
    length = F.col("length")
    return files_df.where(length > max_file_size if route == "oversize" else length <= max_file_size)


def lineage_stamp(df: DataFrame, job_id: str) -> DataFrame:
    """Add ``job_id``, ``src_path``, ``src_length`` and ``src_mtime``: from the
    file columns when the rows carry them, else from the scan's own metadata."""
    check_job_id(job_id)
    if "path" in df.columns:
        df = df.withColumnsRenamed({"path": "src_path", "length": "src_length", "modificationTime": "src_mtime"})
    else:
        df = df.select(
            "*",
            F.col("_metadata.file_path").alias("src_path"),
            F.col("_metadata.file_size").alias("src_length"),
            F.col("_metadata.file_modification_time").alias("src_mtime"),
        )
    return df.withColumn("job_id", F.lit(job_id))
