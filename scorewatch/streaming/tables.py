"""Tables that a stream keeps up to date, in a bounded number of folders.

A batch writes its own folder and then a commit, a small file that lists the folders which make up
the table after it. Once FAN_IN folders of one level are there, they are merged into one folder of
the next level, so that B batches leave about FAN_IN * log(B) folders and a row is rewritten
log(B) times. ``merge`` says what becomes of rows that meet: they stay as they are, or the newest
n of each key are kept, or counts are added up.

A batch that is run again starts from the commit of the batch before it and writes the same
folders, so that nothing is doubled. What neither the last commit nor the one before it lists is
removed after a commit; a reader that takes longer than two batches should copy or read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Folders of a level that are merged into one of the next.
FAN_IN = 8


def _folder(level: int, batch_id: int) -> str:
    return f"table_level={level}/table_batch={batch_id}"


class Files:
    """Small files and folders below a path, in whatever store Spark reads it from."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file is whole or not there: it gets its name when it is written."""
        draft = self._path(f"_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        self._jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
        stream.close()
        self._fs.mkdirs(self._path(name).getParent())
        self._fs.delete(self._path(name), False)
        if not self._fs.rename(draft, self._path(name)):
            raise OSError(f"could not write {self.root}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@dataclass
class Commit:
    """What a table consists of after a batch: (level, folder) pairs, and notes of its writer."""

    batch_id: int = -1
    folders: list[tuple[int, str]] = field(default_factory=list)
    schema: str | None = None
    notes: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class BatchTable:
    """A table at ``path``; ``merge`` is applied to folders that are merged.

    ``levels`` is the level from which folders are left alone: a history grows without end and is
    not rewritten for ever. ``files`` is the number of files of a batch, where many tasks would
    leave a small one each.
    """

    path: str
    merge: Callable[[DataFrame], DataFrame] = lambda df: df
    partition_by: tuple[str, ...] = ()
    levels: int | None = None
    fan_in: int = FAN_IN
    files: int | None = None

    def _commits(self, files: Files) -> list[int]:
        return sorted(int(n) for n in files.names("commits"))

    def last_commit(self, spark: SparkSession, before: int | None = None) -> Commit:
        """The newest commit, or the newest one of a batch before the given one."""
        files = Files(spark, self.path)
        there = [n for n in self._commits(files) if before is None or n < before]
        if not there:
            return Commit()
        read = json.loads(files.read(f"commits/{there[-1]}"))
        return Commit(there[-1], [(level, name) for level, name in read["folders"]], read["schema"], read["notes"])

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/{name}")

    def _read(self, spark: SparkSession, schema: str, folders: Sequence[str]) -> DataFrame:
        columns = T.StructType.fromJson(json.loads(schema))
        # Folders have the form of partitions, which is how Spark reads several that are partitioned.
        read = spark.read.schema(columns).option("basePath", self.path)
        return read.parquet(*[f"{self.path}/{f}" for f in folders]).select(*columns.names)

    def commit(
        self, rows: DataFrame, batch_id: int, notes: Mapping[str, Any] | None = None, replace: bool = False
    ) -> None:
        """Add the rows of a batch, or put them in place of all there was."""
        spark = rows.sparkSession
        base = self.last_commit(spark, before=batch_id)
        name = _folder(0, batch_id)
        self._write(rows if self.files is None else rows.coalesce(self.files), name)
        live = [*([] if replace else base.folders), (0, name)]
        # Read from the schema written, so that a merge gives the columns in the same order.
        schema = rows.schema.json()
        level = 0
        while self.levels is None or level < self.levels:
            same = [n for k, n in live if k == level]
            if len(same) < self.fan_in:
                break
            merged = self.merge(self._read(spark, schema, same)).select(*rows.columns)
            if self.partition_by:
                merged = merged.hint("rebalance", *self.partition_by)
            elif self.files is not None:
                merged = merged.coalesce(self.files)
            level += 1
            name = _folder(level, batch_id)
            self._write(merged, name)
            live = [(k, n) for k, n in live if n not in same] + [(level, name)]
        files = Files(spark, self.path)
        body = {"folders": live, "schema": schema, "notes": {**base.notes, **(notes or {})}}
        files.write(f"commits/{batch_id}", json.dumps(body))
        self._clean(files, {n for _, n in live} | {n for _, n in base.folders}, base.batch_id)

    def _clean(self, files: Files, wanted: set[str], oldest: int) -> None:
        for level in (n for n in files.names() if n.startswith("table_level=")):
            for name in files.names(level):
                if f"{level}/{name}" not in wanted:
                    files.remove(f"{level}/{name}")
        for n in self._commits(files):
            if n < oldest:
                files.remove(f"commits/{n}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the last commit; folders that met are merged, the others not yet."""
        last = self.last_commit(spark)
        if last.schema is None:
            raise FileNotFoundError(f"no batch is committed at {self.path}")
        return self._read(spark, last.schema, [n for _, n in last.folders])
