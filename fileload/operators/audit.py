"""Counts per job, file and record type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileload.operators.records import BAD

GROUP = ("job_id", "src_path", "record_type")

# What becomes of a file; the later in this order, the more it says of one.
STATUSES = ("ok", "already_loaded", "oversize", "hidden", "missing", "no_content", "bad_magic", "bad_width", "corrupt")


def load_audit(detail_df: DataFrame, files_df: DataFrame | None = None) -> DataFrame:
    """``n_rows, n_bad, src_bytes, status`` per ``job_id, src_path, record_type``.

    Both inputs are tables already written.  ``files_df`` adds files that gave
    no rows.  File rows go through the same aggregation as the detail rows, so
    there is no join, and rows are counted before they are shuffled.  Statuses
    are numbers while they are aggregated, so that rows are hashed, never sorted.
    """
    names = F.array(*(F.lit(name) for name in STATUSES))
    parts = detail_df.select(
        *GROUP,
        F.lit(1).cast("bigint").alias("row"),
        F.col(BAD).isNotNull().cast("bigint").alias("bad"),
        "src_length",
        F.lit(None).cast("int").alias("status"),
    )
    if files_df is not None:
        none = F.lit(0).cast("bigint")
        place = F.array_position(names, F.col("status")).cast("int")
        known = F.when(place != 0, place).when(F.col("status").isNotNull(), F.raise_error(F.concat(F.lit("unknown status "), "status")).cast("int"))
        parts = parts.unionByName(files_df.select(*GROUP, none.alias("row"), none.alias("bad"), "src_length", known.alias("status")))
    return parts.groupBy(*GROUP).agg(
        F.sum("row").alias("n_rows"),
        F.sum("bad").alias("n_bad"),
        F.max("src_length").alias("src_bytes"),
        F.element_at(names, F.coalesce(F.max("status"), F.lit(1))).alias("status"),
    )


def content_sum(columns: Sequence[str], where: Column) -> tuple[Column, Column]:
    """``n_rows`` and ``content`` of the rows that ``where`` picks.  ``content`` adds up
    a hash of each row, so the order of rows does not matter, and a row that was
    changed, lost, doubled or given to another file does."""
    row = F.xxhash64(*columns).cast("decimal(38,0)")
    none = F.lit(0).cast("decimal(38,0)")
    return F.count_if(where).alias("n_rows"), F.coalesce(F.sum(F.when(where, row)), none).alias("content")


def altered(kept: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What of ``kept`` (``keys, n_rows, content`` as written down when rows passed by)
    the ``stored`` rows do not give again."""
    again = stored.select(*keys, F.col("n_rows").alias("n_stored"), F.col("content").alias("__content"))
    both = kept.join(again, list(keys), "full")
    same = (F.coalesce("n_rows", F.lit(0)) == F.coalesce("n_stored", F.lit(0))) & F.coalesce(F.col("content") == F.col("__content"), F.lit(False))
    nothing = (F.coalesce("n_rows", F.lit(0)) == 0) & (F.coalesce("n_stored", F.lit(0)) == 0)
    return both.where(~(same | nothing)).select(*keys, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_stored", F.lit(0)).alias("n_stored"))
