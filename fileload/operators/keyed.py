"""Keyed cells where the newest version wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ("row_key", "family", "qualifier")


def to_cells(
    batch_df: DataFrame,
    key: str,
    version: str,
    columns: Sequence[str] = (),
    family: str = "d",
    ties: Sequence[str] = (),
    qualifier_col: str | None = None,
    value_col: str | None = None,
) -> DataFrame:
    """One row per non-null cell.  Either each of ``columns`` is a qualifier, or
    the rows already are (qualifier, value) pairs.  Columns of one type keep it,
    mixed ones become strings.  A null is no cell, so it hides nothing, and a row
    without a key has none."""
    if bool(columns) == bool(qualifier_col and value_col):
        raise ValueError("give either columns or qualifier_col and value_col")
    fixed = [
        F.col(key).alias("row_key"),
        F.lit(family).alias("family"),
        F.col(version).alias("version"),
        F.struct(F.lit(1).alias("batch"), *[F.col(name) for name in ties]).alias("tie"),
    ]
    if qualifier_col:
        cells = batch_df.select(*fixed, F.col(qualifier_col).alias("qualifier"), F.col(value_col).alias("value"))
    else:
        kinds = {kind for name, kind in batch_df.dtypes if name in columns}
        pairs = [
            F.struct(
                F.lit(name).alias("qualifier"),
                (F.col(name) if len(kinds) == 1 else F.col(name).cast("string")).alias("value"),
            )
            for name in columns
        ]
        cells = batch_df.select(*fixed, F.inline(F.array(*pairs)))
    return cells.where("value IS NOT NULL AND row_key IS NOT NULL")


def newest(cells: DataFrame) -> DataFrame:
    """The newest version of each cell; equal versions go by ``tie``, then by
    value.  Every task first sorts and reduces its own rows to one per cell (a struct
    cannot be a hash aggregate's buffer), so a cell with most of the versions sends
    one row per task over the shuffle."""
    top = F.max(F.struct("version", "tie", "value")).alias("top")
    return cells.groupBy(*CELL).agg(top).select(*CELL, "top.version", "top.value")


def keyed_load(
    current_df: DataFrame | None,
    batch_df: DataFrame,
    key: str,
    version: str,
    columns: Sequence[str] = (),
    family: str = "d",
    ties: Sequence[str] = (),
    qualifier_col: str | None = None,
    value_col: str | None = None,
) -> DataFrame:
    """``row_key, family, qualifier, version, value`` after loading a batch.

    A cell changes only if the batch has its version or a newer one; among
    equal versions in a batch the greatest ``ties`` (say ``src_path, line_no``)
    wins.  Loading a batch again changes nothing.
    """
    cells = newest(to_cells(batch_df, key, version, columns, family, ties, qualifier_col, value_col))
    return cells if current_df is None else merge_cells(current_df, cells)


def merge_cells(current_df: DataFrame, batch_cells: DataFrame) -> DataFrame:
    """Merge two tables that hold one row per cell; the batch wins equal versions."""
    columns = [*CELL, "version", "value"]
    old = current_df.select(*columns, F.lit(0).alias("tie"))
    return newest(old.unionByName(batch_cells.select(*columns, F.lit(1).alias("tie"))))


def latest(cells: DataFrame, qualifiers: Sequence[str], family: str = "d") -> DataFrame:
    """One row per key with a column per qualifier; cells are one row each."""
    return (
        cells.where(F.col("family") == family)
        .groupBy("row_key")
        .agg(*[F.max(F.when(F.col("qualifier") == name, F.col("value"))).alias(name) for name in qualifiers])
    )
