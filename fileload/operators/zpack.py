"""Tables to ``.Z`` payloads."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileload.functions import lzw
from fileload.session import stage_table

OUTPUT = "shard string, part bigint, content binary, n_lines bigint, n_bytes bigint"
PART_BYTES = 32 << 20
#: Lines of a part that are held as text at a time.
HELD_LINES = 512


def z_export(
    df: DataFrame,
    shard_col: str,
    line_col: str,
    order_cols: Sequence[str] | str = (),
    part_bytes: int = PART_BYTES,
    num_partitions: int | None = None,
) -> DataFrame:
    """Encode lines into ``.Z`` payloads, each holding lines of one shard only.

    A shard is cut into parts of about ``part_bytes`` of text, so a shard that
    holds most of the rows is spread over many tasks and no task holds more than
    a part.  With ``order_cols``, a shard's parts read in ``part`` order give
    its lines in that order.  The rows are then kept as a table, numbered as
    they lie in it and range-partitioned on shard, order and number: the only
    shuffle, and one that also splits rows that are copies of each other.
    Without ``order_cols`` nothing is shuffled and each input partition writes
    its own parts.  A null line is written as an empty one.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    line = F.coalesce(F.col(line_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(shard_col).cast("string").alias("shard"),
        line.alias("line"),
        *[F.col(name).alias(f"__order{i}") for i, name in enumerate(order)],
    )
    if order:
        # The number must not change when a task runs again, so it is taken from
        # files, whose rows keep their places.
        rows = stage_table(rows.withColumn("__size", F.octet_length("line") + 1), "rows")
        if num_partitions is None:
            total = rows.agg(F.sum(F.col("__size").cast("bigint"))).first()[0] or 0
            num_partitions = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-total // part_bytes))
        keys = ["shard", *[f"__order{i}" for i in range(len(order))], "__number"]
        rows = rows.drop("__size").withColumn("__number", F.monotonically_increasing_id())
        rows = rows.repartitionByRange(num_partitions, *keys).sortWithinPartitions(*keys)
    else:
        rows = rows.sortWithinPartitions("shard")

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        shard, encoder, held, n_lines, size = None, None, [], 0, 0

        def payload():
            encoder.add(b"".join(held))
            values = [[shard], [part], [encoder.close()], [n_lines], [size]]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["shard", "part", "content", "n_lines", "n_bytes"]
            )

        for batch in batches:
            for start in range(0, batch.num_rows, HELD_LINES):
                rows = batch.slice(start, HELD_LINES)
                for name, raw in zip(rows.column(0).to_pylist(), rows.column(1).cast(pa.binary()).to_pylist()):
                    if encoder and (name != shard or size >= part_bytes):
                        yield payload()
                        part, encoder, held = part + 1, None, []
                    if encoder is None:
                        shard, encoder, n_lines, size = name, lzw.Encoder(), 0, 0
                    held += (raw, b"\n")
                    n_lines += 1
                    size += len(raw) + 1
                # The text goes as it is encoded; a part is held as codes only.
                if encoder:
                    encoder.add(b"".join(held))
                    held = []
        if encoder:
            yield payload()

    return rows.select("shard", "line").mapInArrow(encode_batches, OUTPUT)
