"""Manifest lines to file descriptors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileload.functions.text import java_split


# Columns the parse adds to those of the layout.
MADE = ("n_fields", "extra", "status")


def manifest_parse(df: DataFrame, layout: Sequence[str], sep: str = ":", value_col: str = "value") -> DataFrame:
    """Split each line into the columns of ``layout``.

    Missing trailing fields are null and surplus ones go to ``extra``.  Empty
    lines stay as rows with ``status='empty'`` so that they can be reported;
    ``n_fields`` counts what the split gave (one for an empty line).  With the
    default separator a URI that has a scheme falls apart at its colon; such
    manifests need another ``sep``.
    """
    clash = {value_col, *MADE} & set(layout)
    if clash or len(set(layout)) < len(layout):
        raise ValueError(f"layout {list(layout)} repeats a name or uses one of {sorted({value_col, *MADE})}")
    fields = F.col("__fields")
    width = len(layout)
    return (
        df.withColumn("__fields", java_split(F.col(value_col), sep))
        .withColumns({name: F.get(fields, F.lit(i)) for i, name in enumerate(layout)})
        .withColumns(
            {
                "n_fields": F.size(fields),
                "extra": F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0))),
                "status": F.when(F.coalesce(F.col(value_col), F.lit("")) == "", "empty").otherwise("ok"),
            }
        )
        .drop("__fields")
    )
