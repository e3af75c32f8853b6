"""Detail tables, one folder per job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileload.config import check_job_id
from fileload.session import conf_scope

# Rows of a task are dealt out to this many shares, the grain in which Spark puts
# shuffled rows together to files of a wanted size.
SHARES = 1 << 16
MIN_FILE_BYTES = 64 << 10


def job_folder(path: str, job_id: str, scope: Mapping[str, int | str] | None = None) -> str:
    check_job_id(job_id)
    return "/".join([path.rstrip("/"), f"job_id={job_id}", *[f"{k}={v}" for k, v in (scope or {}).items()]])


def detail_write(
    df: DataFrame,
    path: str,
    job_id: str,
    partition_cols: Sequence[str] = (),
    max_records_per_file: int | None = None,
    scope: Mapping[str, int | str] | None = None,
    rebalance: bool = False,
    max_bytes_per_file: int | None = None,
) -> str:
    """Write a job's rows and return the folder they are in.

    The job's folder (and, below it, that of ``scope``) is replaced as a whole,
    so a retry leaves one copy even if it writes fewer partitions than before,
    and other jobs are not touched.  Rows are written where they are;
    ``rebalance`` adds a shuffle that gathers the rows of each partition value
    into files of even size, splitting values that hold most of the rows.
    ``max_bytes_per_file`` (of shuffled, compressed rows; Parquet rarely takes
    more) shuffles too: rows are dealt out evenly, whatever task or partition
    value they are of, and adaptive execution puts as many shares into a file as
    the limit allows, by the sizes it measured.  A file may pass the limit by the
    fifth that Spark allows itself, or by one row that is longer than that.
    """
    if max_bytes_per_file is not None and max_bytes_per_file < MIN_FILE_BYTES:
        raise ValueError(f"max_bytes_per_file must be {MIN_FILE_BYTES} or more, not {max_bytes_per_file}")
    folder = job_folder(path, job_id, scope)
    named = df.drop("job_id", *(scope or {}))
    conf = {}
    if max_bytes_per_file:
        conf = _sized(max_bytes_per_file)
        share = F.pmod(F.monotonically_increasing_id(), F.lit(SHARES))
        named = named.withColumn("__share", share).hint("rebalance", *partition_cols, "__share").drop("__share")
    elif rebalance:
        named = named.hint("rebalance", *partition_cols)
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with conf_scope(df.sparkSession, conf):
        writer.parquet(folder)
    return folder


def _sized(most: int) -> dict[str, str]:
    """Settings under which a rebalance fills partitions up to ``most`` bytes."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{most}b",
    }


def read_detail(spark: SparkSession, path: str) -> DataFrame:
    """All jobs' rows with their ``job_id``."""
    df = spark.read.parquet(path)
    return df.withColumn("job_id", F.col("job_id").cast("string"))
