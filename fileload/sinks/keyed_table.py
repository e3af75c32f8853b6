"""Stored keyed cells: a bucketed Spark table that loads append to."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileload.functions.paths import child_names, existing, remove, working_uri
from fileload.operators.keyed import CELL, newest

COLUMNS = [*CELL, "version", "value"]
BUCKETS = 64
#: Folder names of loads, before the number.
LOAD = "load="


class KeyedTable:
    """Cells under a path, bucketed by the cell: equal cells of all loads lie in files
    of one bucket, so the newest of each is found without a shuffle, and a row key
    with most of the cells is spread over all buckets.

    A load appends what it brings, as a partition whose name begins with its number; it neither
    reads nor lists what earlier loads wrote.  The first one fixes the columns' types
    and the number of buckets.  Of equal versions the later load wins; of two loads at
    once neither is the later one, and the greater value wins.  Readers see a load once
    Spark has committed it.  ``compact`` puts the loads so far together as a new
    generation; it is not for times when a load runs.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, working_uri(spark, path), buckets
        # Committed loads by folder, and those of them that the session's table knows.
        self._committed: dict[str, set[int]] = {}
        self._listed: dict[str, set[int]] = {}

    def _generation(self) -> tuple[int, int, str] | None:
        """Number, buckets and folder of the last complete generation."""
        found = [name.split("-") for name in child_names(self.spark, self.path) if name.startswith("cells-")]
        for number, buckets in sorted(((int(n), int(b)) for _, n, b in found), reverse=True):
            folder = f"{self.path}/cells-{number}-{buckets}"
            if self._loads(folder):
                return number, buckets, folder
        return None

    def _loads(self, folder: str) -> set[str]:
        """Names of a generation's committed loads."""
        names = child_names(self.spark, folder)
        if "_SUCCESS" in names:
            raise ValueError(f"{folder} was written before loads had folders of their own; load it anew")
        there = {name[len(LOAD) :] for name in names if name.startswith(LOAD)}
        done = self._committed.setdefault(folder, set())
        marks = {f"{folder}/{LOAD}{load}/_SUCCESS": load for load in there - done}
        done.update(marks[mark] for mark in existing(self.spark, list(marks)))
        return done & there

    def _name(self, folder: str) -> str:
        return f"keyed_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def _table(self, buckets: int, folder: str) -> str:
        """The session's table of a generation, by name."""
        name = self._name(folder)
        if not self.spark.catalog.tableExists(name):
            # A session that did not make the table learns of it from its files.
            first = min(self._loads(folder))
            held = self.spark.read.parquet(f"{folder}/{LOAD}{first}").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, load STRING) USING parquet PARTITIONED BY (load) "
                f"CLUSTERED BY ({', '.join(CELL)}) INTO {buckets} BUCKETS LOCATION '{folder}'"
            )
            self._listed.pop(folder, None)
        return name

    def _rows(self) -> DataFrame | None:
        """All cells of all loads, ``tie`` being the number of the load."""
        last = self._generation()
        if last is None:
            return None
        _, buckets, folder = last
        name = self._table(buckets, folder)
        listed = self._listed.setdefault(folder, set())
        fresh = sorted(self._loads(folder) - listed)
        if fresh:
            parts = " ".join(f"PARTITION (load='{load}')" for load in fresh)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            listed.update(fresh)
        self.spark.catalog.refreshTable(name)
        number = F.substring_index("load", "-", 1).cast("int")
        return self.spark.table(name).select(*COLUMNS, number.alias("tie"))

    def _append(self, cells: DataFrame, generation: int, buckets: int, number: int) -> None:
        # Two loads at once may have one number, but never one folder.
        own = uuid.uuid4().hex
        folder = f"{self.path}/cells-{generation}-{buckets}/{LOAD}{number}-{own}"
        # A task for each bucket, so that a load adds one file to it.
        dealt = cells.repartition(buckets, *CELL)
        dealt.write.mode("append").bucketBy(buckets, *CELL).option("path", folder).saveAsTable(f"keyed_{own}")
        # Only the name goes; the files are a partition of the generation's table.
        self.spark.sql(f"DROP TABLE keyed_{own}")

    def cells(self) -> DataFrame | None:
        """All current cells, or None before the first load."""
        rows = self._rows()
        return None if rows is None else newest(rows)

    def load(self, batch_cells: DataFrame) -> None:
        """Append cells (one row per cell, as ``keyed_load(None, …)`` gives them)."""
        last = self._generation()
        batch = batch_cells.select(*COLUMNS)
        if last is None:
            self._append(batch, 1, self.buckets, 1)
            return
        generation, buckets, folder = last
        held = self.spark.table(self._table(buckets, folder)).select(*COLUMNS).schema
        if [f.dataType for f in batch.schema] != [f.dataType for f in held]:
            raise ValueError(f"{self.path} holds {held.simpleString()}, not {batch.schema.simpleString()}")
        number = max(int(load.split("-")[0]) for load in self._loads(folder)) + 1
        self._append(batch, generation, buckets, number)

    def compact(self) -> None:
        """Put all loads together as one, and remove what they were."""
        rows, last = self._rows(), self._generation()
        if rows is None:
            return
        self._append(newest(rows).select(*COLUMNS), last[0] + 1, last[1], 1)
        for name in child_names(self.spark, self.path):
            if name.startswith("cells-") and int(name.split("-")[1]) <= last[0]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(f'{self.path}/{name}')}")
                remove(self.spark, f"{self.path}/{name}")
