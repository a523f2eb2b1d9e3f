"""Results of micro-batches in folders of growing size.

Each batch writes one folder; every ``FAN`` folders of a size are merged into one of the next. So what is written
follows the batches (a row is written again once per size), and a reader opens a number of folders that grows
with the logarithm of the number of batches. Folder ``<size>-<batch>`` covers ``FAN ** size`` batches, the last of
which is ``batch``. Names and contents follow from batch numbers alone: a batch that is run again overwrites its own
folders, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import discard

FAN = 8


class Tiers:
    """Batches of rows under one folder that every executor can reach.

    ``merge`` turns the rows of several batches into those of their union, and must give the same whichever
    neighbouring batches are merged first. Batches are numbered from 0 without gaps, as a stream numbers them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.schema, self.merge, self.fan = spark, path.rstrip("/"), schema, merge, fan

    def _folder(self, size: int, batch: int) -> str:
        return f"{self.path}/{size}-{batch}"

    def _open(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _finished(self, name: str) -> list[str]:
        """Names of folders like ``name`` that were written to the end."""
        marks = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        files = marks.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [entry.getPath().getParent().getName() for entry in files.globStatus(marks) or []]

    def add(self, rows: DataFrame, batch: int) -> None:
        """Writes a batch, and merges the folders that it completes."""
        rows.write.mode("overwrite").parquet(self._folder(0, batch))
        size = 1
        while (batch + 1) % self.fan**size == 0:
            # Finished before if the batch is run again; its parts may be gone by now.
            if not self._finished(f"{size}-{batch}"):
                part = self.fan ** (size - 1)
                parts = self._open([self._folder(size - 1, batch - i * part) for i in range(self.fan)])
                self.merge(parts).write.mode("overwrite").parquet(self._folder(size, batch))
            if size > 1:  # readers may still hold the folders merged just now, but not those merged before
                part = self.fan ** (size - 2)
                for old in range(batch - self.fan**size + part, batch + 1, part):
                    discard(self.spark, self._folder(size - 2, old))
            size += 1

    def folders(self) -> list[str]:
        """The fewest finished folders that cover the batches from the first on."""
        largest: dict[int, int] = {}
        for folder in self._finished("*"):
            size, batch = map(int, folder.split("-"))
            begin = batch + 1 - self.fan**size
            largest[begin] = max(size, largest.get(begin, 0))
        found, begin = [], 0
        while begin in largest:
            size = largest[begin]
            begin += self.fan**size
            found.append(self._folder(size, begin - 1))
        return found

    def read(self) -> DataFrame:
        """The rows of all batches, merged; empty before the first batch."""
        return self.merge(self._open(self.folders()))
