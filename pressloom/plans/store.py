"""Published tables on plain files.

A table is a list of Parquet folders, oldest first. A load appends one folder with the rows
it changed and then publishes all its tables by writing one small pointer file, so readers
see a load whole or not at all, and the large tables are never rewritten by a small load.
The current row of a key is the one in its newest folder. ``compact`` folds a table back
into one folder. Pointer files are numbered and never overwritten. A load works on a ``pinned``
store: all it reads is of one version, and it publishes the next one. If another load has
published since, the file of that version is there already; the later load fails and can be run
again, so no update is lost. File systems that create a file only if it is not there (HDFS, local
ones) keep that promise; on object stores one writer at a time has to be arranged for outside.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators.merge import dedupe_last
from pressloom.schemas import BRIDGES, LOGS, TABLE_KEYS, TABLES, TOMBSTONES
from pressloom.sinks.artifacts import write_text_file

_POINTERS = "_published"
_PLACE = ("_part", "_file", "_row")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._at: tuple[int, dict[str, list[str]]] | None = None

    def pinned(self) -> TableStore:
        """A view of the current version; what it publishes follows on that version or fails."""
        view = TableStore(self.spark, self.root)
        view._at = self._pointer()
        return view

    # --- pointer -----------------------------------------------------------------

    def _pointer(self) -> tuple[int, dict[str, list[str]]]:
        if self._at is not None:
            return self._at[0], dict(self._at[1])
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{_POINTERS}")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0, {}
        numbers = [int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(folder)
                   if s.getPath().getName().endswith(".json")]
        if not numbers:
            return 0, {}
        newest = max(numbers)
        return newest, self._tables_at(newest)

    def _tables_at(self, number: int) -> dict[str, list[str]]:
        """The folders of each table as published by one version."""
        if number < 1:
            return {}
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{_POINTERS}/{number:09d}.json")
        stream = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(path)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def version(self) -> int:
        return self._pointer()[0]

    def publish(self, changes: dict[str, DataFrame], replace: bool = False) -> dict[str, str]:
        """Write each table's changed rows, then make all of them visible at once."""
        number, tables = self._pointer()
        written = {}
        for name, rows in changes.items():
            path = f"{self.root}/{name}/part-{uuid.uuid4().hex}"
            rows.write.mode("errorifexists").parquet(path)
            written[name] = path
            tables[name] = [path] if replace else tables.get(name, []) + [path]
        write_text_file(self.spark, f"{self.root}/{_POINTERS}/{number + 1:09d}.json", json.dumps(tables))
        if self._at is not None:
            self._at = number + 1, tables
        return written

    # --- reading -----------------------------------------------------------------

    def _parts(self, name: str) -> tuple[DataFrame, int]:
        _, tables = self._pointer()
        schema = f"{TABLES[name]}"
        parts = [
            self.spark.read.schema(schema).parquet(path).select(
                "*", F.lit(i).alias("_part"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
            for i, path in enumerate(tables.get(name, []))
        ]
        if not parts:
            return self.spark.createDataFrame([], f"{schema}, _part int, _file string, _row bigint"), 0
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows, len(parts)

    def changes(self, name: str, since: int) -> DataFrame | None:
        """Rows published after version ``since``, as they were published; None if there are none. A folder
        that ``compact`` wrote holds no change, the folders it took the place of are still there."""
        number, tables = self._pointer()
        before, added = self._tables_at(since).get(name, []), []
        for one in range(since + 1, number + 1):
            after = tables.get(name, []) if one == number else self._tables_at(one).get(name, [])
            if after[:len(before)] == before:
                added += after[len(before):]
            before = after
        return self.spark.read.schema(TABLES[name]).parquet(*added) if added else None

    def versions(self, name: str) -> DataFrame:
        """All rows ever published, also those that newer ones of their key have replaced."""
        return self._parts(name)[0].drop(*_PLACE)

    def read(self, name: str, only: DataFrame | None = None) -> DataFrame:
        """Current rows, or those of the keys in ``only``: the key filter is applied before
        the newest row is picked, so a small batch picks among few rows. A read of all keys compares keys
        and places of rows only, and takes replaced rows out where they are read."""
        rows, parts = self._parts(name)
        key = TABLE_KEYS.get(name) or ([BRIDGES[name]] if name in BRIDGES else None)
        if only is not None and key:
            rows = rows.join(only.select(*key).distinct(), key, "left_semi")
        if name in LOGS or (parts < 2 and name not in BRIDGES):
            return _alive(rows.drop(*_PLACE), name)
        if name in BRIDGES:
            newest = rows.groupBy(*key).agg(F.max("_part").alias("_part"))
            value = [c for c in rows.columns if c not in (*key, *_PLACE)][0]
            return rows.join(newest, [*key, "_part"], "left_semi").where(f"{value} IS NOT NULL").drop(*_PLACE)
        current = dedupe_last(rows, key, ["_part"], ["_file", "_row"] if only is None else None).drop(*_PLACE)
        return _alive(current, name)

    def compact(self, name: str) -> None:
        """One folder with the current rows; the old folders stay for running readers."""
        view = self.pinned()
        view.publish({name: view.read(name)}, replace=True)


def _alive(rows: DataFrame, name: str) -> DataFrame:
    """Without the keys that were taken out, and without the flag."""
    flag = TOMBSTONES.get(name)
    return rows if flag is None else rows.where(~F.coalesce(flag, F.lit(False))).drop(flag)
