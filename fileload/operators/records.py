"""Record types by name, and lines to typed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileload.functions.text import check_charset, quoted

BAD = "_bad"


@dataclass(frozen=True)
class RecordSpec:
    """How one record type's lines are read: columns in field order, all of
    atomic types.  There is no quoting, so a field cannot hold the separator."""

    schema: T.StructType
    sep: str = "|"
    charset: str = "UTF-8"

    def __post_init__(self):
        check_charset(self.charset)
        if not self.sep:
            raise ValueError("the separator must not be empty")
        if BAD in self.schema.names:
            raise ValueError(f"{BAD} is reserved for the text of lines that do not parse")
        nested = [f.name for f in self.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
        if nested:
            raise ValueError(f"fields {nested} are not of atomic types")


def fields(**kinds: str) -> T.StructType:
    """A schema from type names (``long``, ``string``, ``double``, …); unlike
    DDL text it can be built before there is a session."""
    schema = T.StructType()
    for name, kind in kinds.items():
        schema.add(name, kind)
    return schema


RECORDS: dict[str, RecordSpec] = {}


def register_record(name: str, spec: RecordSpec) -> None:
    RECORDS[name] = spec


def record_spec(name: str) -> RecordSpec:
    """The spec of a record type; an unknown name fails here, on the driver."""
    try:
        return RECORDS[name]
    except KeyError:
        raise KeyError(f"unknown record type {name!r}; registered: {sorted(RECORDS)}") from None


def record_parse(lines_df: DataFrame, record_type: str, line_col: str = "line") -> DataFrame:
    """Replace the line by the record's typed columns and ``_bad``.

    ``_bad`` holds the whole line when a field has the wrong type or the number
    of fields is wrong; fields that did parse keep their value.  An empty field
    is null, blanks around a number are allowed, and a null line gives nulls.
    Columns other than the line pass through.  Each step below is a projection
    of its own so that the line is split, and each field cast, only once.
    """
    spec = record_spec(record_type)
    columns = spec.schema.fields
    rest = [name for name in lines_df.columns if name != line_col]
    clash = {*spec.schema.names, BAD} & set(rest)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both the input and record type {record_type!r}")
    raw = [f"__field{i}" for i in range(len(columns))]
    line = F.col(line_col)
    split = lines_df.select(*rest, line, F.split(line, quoted(spec.sep), -1).alias("__fields"))
    named = split.select(
        *rest,
        line,
        F.size("__fields").alias("__count"),
        *[F.nullif(F.get("__fields", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(raw)],
    )
    typed = named.select(
        *rest,
        line,
        "__count",
        *raw,
        *[F.col(name).try_cast(f.dataType).alias(f.name) for name, f in zip(raw, columns)],
    )
    bad = F.col("__count") != len(columns)
    for name, f in zip(raw, columns):
        if not isinstance(f.dataType, T.StringType):
            bad |= F.col(name).isNotNull() & F.col(f.name).isNull()
    return typed.select(*rest, *spec.schema.names, F.when(bad, line).alias(BAD))
