"""Line numbers of text files that a scan reads in several blocks.

A scan gives its rows no number, but each row can carry where its block begins and a
number that rises along the rows of a task, so along those of a block.  Once rows are
written with both, a small table tells how many lines come before each block, and a
line's number is that and its place in the block.  Nothing is read twice but those
columns, and no line is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The two columns written rows carry.
BLOCK, ROW = "block", "block_row"
PLACE = f"{BLOCK} bigint, {ROW} bigint"
#: Rows of the table of blocks up to which it may be broadcast, some 100 bytes each.
BROADCAST_BLOCKS = 500_000


def place() -> list[Column]:
    """Where a scan's row is.  Both are taken in one job: another one may cut its tasks
    elsewhere."""
    return [F.col("_metadata.file_block_start").alias(BLOCK), F.monotonically_increasing_id().alias(ROW)]


def blocks_of(rows: DataFrame) -> DataFrame:
    """``src_path, block, first_row, lines_before`` of stored rows."""
    counted = (
        rows.where(f"{BLOCK} IS NOT NULL")
        .groupBy("src_path", BLOCK)
        .agg(F.count("*").alias("n"), F.min(ROW).alias("first_row"))
    )
    before = F.expr(f"sum(n) OVER (PARTITION BY src_path ORDER BY {BLOCK} ROWS UNBOUNDED PRECEDING) - n")
    return counted.select("src_path", BLOCK, "first_row", before.alias("lines_before"))


def with_line_numbers(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with ``line_no`` (from 0) where it was null, and without their places."""
    blocks = blocks.select("src_path", BLOCK, "first_row", "lines_before")
    few = blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    side = F.broadcast(blocks) if few else blocks
    number = F.col("lines_before") + F.col(ROW) - F.col("first_row")
    joined = rows.join(side, ["src_path", BLOCK], "left")
    return joined.withColumn("line_no", F.coalesce("line_no", number)).select(
        *[name for name in rows.columns if name not in (BLOCK, ROW)]
    )
