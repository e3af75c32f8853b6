"""Session settings for load jobs and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from fileload.functions.paths import remove

# A .Z file is decoded by one task at a cost that dwarfs opening it, so tasks get
# fewer bytes than a text scan's, but enough to write files of a useful size.
# Arrow batches are bounded by bytes, not rows.
DECODE_CONF = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.files.openCostInBytes": "256k",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}

# Line rows and file rows go to two folders: with both open, a task's rows need
# not be sorted first to be written one folder after the other.
TWO_FOLDERS_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "2"}

LOAD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**LOAD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def conf_scope(spark: SparkSession, conf: dict[str, str]):
    """Apply runtime settings while an action of ours runs, then put them back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Folders made by stage_dir: in this process, and in the innermost stage_scope.
_made: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("stage_scope", default=None)


@contextmanager
def stage_scope(spark: SparkSession):
    """Remove the intermediate tables made inside once the work that reads them
    is done.  Not for tables a returned DataFrame still reads."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            remove(spark, path)


def drop_stages(spark: SparkSession) -> None:
    """Remove all intermediate tables this process has made, when no DataFrame
    that reads them (of ``file_fetch`` or ``z_export``) is needed any more."""
    while _made:
        remove(spark, _made.pop())


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix=f"{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    inner = _scope.get()
    (_made if inner is None else inner).append(path)
    return path


def stage_table(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut lineage by writing ``df`` (with writer ``options``) to a fresh folder and reading it back."""
    path = stage_dir(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
