"""Which inputs have been handled already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fileload.functions.paths import is_filled
from fileload.sinks.detail import detail_write

# An input is the same input while all three are the same.
IDENTITY = ("path", "length", "modificationTime")
SCHEMA = "path string, length bigint, modificationTime timestamp, status string, wave int, job_id string, shard int"
#: Folders into which each wave's entries are dealt by a hash of the path.
SHARDS = 256


def shard_of(path: Column) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(SHARDS)).cast("int")


def ledger(spark: SparkSession, ledger_path: str) -> DataFrame | None:
    """The ledger table, or None when nothing was committed yet."""
    if not is_filled(spark, ledger_path):
        return None
    return spark.read.schema(SCHEMA).parquet(ledger_path)


def _entries(files_df: DataFrame, ledger_df: DataFrame) -> DataFrame:
    """Identities in those shards of the ledger that the files can be in: a job of a
    few files reads a few of the folders, however long the ledger is."""
    shards = [row.shard for row in files_df.select(shard_of(F.col("path")).alias("shard")).distinct().collect()]
    return ledger_df.where(F.col("shard").isin(shards)).select(*[F.col(name).alias(f"__{name}") for name in IDENTITY])


def _same() -> list[Column]:
    return [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in IDENTITY]


def pending(files_df: DataFrame, ledger_df: DataFrame | None) -> DataFrame:
    """The files the ledger does not know.  Spark broadcasts the ledger's entries while
    they are small and joins on a shuffle of these few columns once they are not."""
    return files_df if ledger_df is None else files_df.join(_entries(files_df, ledger_df), _same(), "left_anti")


def marked(files_df: DataFrame, ledger_df: DataFrame | None) -> DataFrame:
    """The files with ``handled``: whether the ledger knows them.  One join with one
    scan of the ledger; a file that was entered twice is still one row."""
    if ledger_df is None:
        return files_df.withColumn("handled", F.lit(False))
    known = _entries(files_df, ledger_df).distinct().withColumn("handled", F.lit(True))
    return files_df.join(known, _same(), "left").select(*files_df.columns, F.coalesce("handled", F.lit(False)).alias("handled"))


def commit(ledger_path: str, status_df: DataFrame, job_id: str, wave: int = 0) -> None:
    """Record handled files; repeating a commit replaces it."""
    entries = status_df.select(*IDENTITY, "status", shard_of(F.col("path")).alias("shard"))
    detail_write(entries, ledger_path, job_id, ["shard"], scope={"wave": wave}, rebalance=True)
