"""Manifest scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per manifest line: ``value`` and the ``manifest_file`` it is in.
    Empty lines are kept; :func:`manifest_parse` marks them."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("manifest_file"))
