"""Payload tables to ``.Z`` files."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fileload.functions.paths import CALLS_AT_ONCE, is_filled, opener, working_uri

FORMAT = "z_payload_files"


@dataclass
class Written(WriterCommitMessage):
    """Files one task left in the temporary folder, by their final names."""

    names: list[tuple[str, str]]


class PayloadWriter(DataSourceArrowWriter):
    """Tasks write under a temporary folder; the driver moves the files of the
    attempts that count into place, so retries leave nothing behind."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.temp = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, temp = opener()(self.temp)
        attempt, names = uuid.uuid4().hex, []
        fs.create_dir(f"{temp}/{attempt}", recursive=True)
        for batch in iterator:
            for row in batch.select(["shard", "part", "content"]).to_pylist():
                shard = "__HIVE_DEFAULT_PARTITION__" if row["shard"] is None else quote(row["shard"], safe="")
                name = f"{attempt}/{len(names)}"
                with fs.open_output_stream(f"{temp}/{name}") as out:
                    out.write(row["content"])
                names.append((name, f"shard={shard}/part-{row['part']:016x}.Z"))
        return Written(names)

    def commit(self, messages):
        open_fs = opener()
        (fs, root), (_, temp) = open_fs(self.path), open_fs(self.temp)
        moves = [move for message in messages if message for move in message.names]
        with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
            folders = {final.rsplit("/", 1)[0] for _, final in moves}
            list(pool.map(lambda folder: fs.create_dir(f"{root}/{folder}", recursive=True), folders))
            list(pool.map(lambda move: fs.move(f"{temp}/{move[0]}", f"{root}/{move[1]}"), moves))
        self._drop_temp(fs, temp)

    def abort(self, messages):
        self._drop_temp(*opener()(self.temp))

    @staticmethod
    def _drop_temp(fs, temp):
        if fs.get_file_info(temp).type == pafs.FileType.Directory:
            fs.delete_dir(temp)


class PayloadFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return PayloadWriter(self.options["path"])


def write_z_files(payload_df: DataFrame, path: str) -> None:
    """Write ``shard, part, content`` rows as ``shard=<shard>/part-<part>.Z``
    under a folder that must be new or empty."""
    spark = payload_df.sparkSession
    if is_filled(spark, path):
        raise FileExistsError(path)
    spark.dataSource.register(PayloadFiles)
    payload_df.select("shard", "part", "content").write.format(FORMAT).mode("append").save(working_uri(spark, path))
